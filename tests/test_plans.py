import importlib.util
import os

import pytest

import __spark_entry__ as contract

ROOT = os.path.dirname(os.path.abspath(contract.__file__))
spec = importlib.util.spec_from_file_location("plan_tool", os.path.join(ROOT, "tools", "plans.py"))
tool = importlib.util.module_from_spec(spec)
spec.loader.exec_module(tool)


def plan(spark, sf_dir, name):
    return contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    p = plan(spark, sf_dir, "src_01_table_scan")
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in p


@pytest.mark.parametrize("name", ["win_02_top_n_per_key", "win_16_dedup_latest", "txt_11_vector_top_k", "jn_15_top_lookup"])
def test_ranking_is_cut_before_the_shuffle(spark, sf_dir, name):
    assert "Partial" in [line for line in plan(spark, sf_dir, name).splitlines() if "WindowGroupLimit" in line][-1]


@pytest.mark.parametrize("prefix", ["jn_", "win_1", "cdc_0", "met_0", "slv_0", "gld_0"])
def test_no_all_pairs_joins(spark, sf_dir, prefix):
    for name, run in contract.queries().items():
        if name.startswith(prefix):
            assert not tool.findings(run(spark, sf_dir)), name


def test_big_side_is_shuffled_once(spark, sf_dir, monkeypatch):
    """One exchange and one scan where no key has many rows; with cut keys the rows are still exchanged once, and what else is
    exchanged has been aggregated to a row per bucket."""
    from lakeloom.plans import ordered

    for sampled, cut in ((64, False), (2, True)):
        monkeypatch.setattr(ordered, "SAMPLED", sampled)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            lines = plan(spark, sf_dir, "win_14_sequence_check").splitlines()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        exchanges = [i for i, line in enumerate(lines) if "Exchange" in line and "Broadcast" not in line]
        raw = [i for i in exchanges if not any("Aggregate" in line or "Window" in line for line in lines[i + 1 : i + 3])]
        assert len(raw) == 1 and (len(exchanges) > 1) == cut


@pytest.mark.parametrize("name", ["mon_02_psi", "mon_05_jensen_shannon", "mon_10_retraining_decision"])
def test_histograms_exchange_counts_only(spark, sf_dir, name):
    """With broadcasts off every exchange is above an aggregate, so no raw row is sent by its feature's name."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf_dir, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    assert "Join" not in text
    for i, line in enumerate(lines):
        if "Exchange" in line:
            assert "Aggregate" in lines[i + 1], lines[i + 1]


def test_metrics_are_grouped_in_parts_that_follow_the_rows(t, monkeypatch):
    """Repeats and slots are found after one exchange, whose parts hold a bounded number of rows."""
    from lakeloom.catalog import telemetry
    from lakeloom.operators import silver

    want = telemetry.everything(t, "system_metrics")
    rows = want.collect()
    monkeypatch.setattr(silver, "ROWS_PER_PART", 50)
    small = telemetry.everything(t, "system_metrics")
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(device_id" in x and "slot" in x]) == 1
    assert small.rdd.getNumPartitions() >= t.events.count() // 50
    assert sorted(map(str, small.collect())) == sorted(map(str, rows))
