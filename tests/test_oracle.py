"""Registered queries against their DuckDB oracles.

A few of each family by default; LAKELOOM_ALL=1 runs every query.
"""

import os

import oracle
import pytest

import __spark_entry__ as contract

RUNS, SQLS = contract.queries(), contract.oracle_sql()
SLOW = ("str_", "fea_11", "fea_14", "txt_18", "txt_08")


def chosen():
    if os.environ.get("LAKELOOM_ALL"):
        return list(RUNS)
    seen, out = {}, []
    for name in RUNS:
        family = name.split("_")[0]
        if name.startswith(SLOW):
            continue
        seen[family] = seen.get(family, 0) + 1
        if seen[family] % 4 == 1:
            out.append(name)
    return [*out, "str_01_tumbling_window", "str_09_dedup_within_watermark", "str_15_state_per_key"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", chosen())
def test_matches_oracle(name, spark, sf_dir, con):
    df = RUNS[name](spark, sf_dir)
    if name in SQLS:
        problem = oracle.compare(df, con, SQLS[name])
        # the smallest tables leave some filters without rows on either side
        assert problem in (None, "both empty")
    else:
        assert df.count() > 0


def test_oracles_have_a_query():
    assert set(SQLS) <= set(RUNS)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_inventory_is_covered():
    import importlib.util

    path = os.path.join(os.path.dirname(os.path.abspath(contract.__file__)), "tools", "coverage.py")
    spec = importlib.util.spec_from_file_location("coverage_tool", path)
    tool = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(tool)
    assert tool.missing() == []
