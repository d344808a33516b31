"""Copy a table folder with one hot key holding a third of the rows: python tools/skewed_copy.py SRC DST."""

from __future__ import annotations

import os
import sys

import duckdb

EDITS = {
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM src",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM src",
    "lineitem": "SELECT * REPLACE (CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 9 ELSE l_suppkey END AS l_suppkey,"
                " CASE WHEN (l_orderkey * 7 + l_suppkey) % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey) FROM src",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END AS c_nationkey) FROM src",
    "supplier": "SELECT * REPLACE (CASE WHEN s_suppkey % 3 = 0 THEN 4 ELSE s_nationkey END AS s_nationkey,"
                " CASE WHEN s_suppkey % 6 = 0 THEN 100.0 ELSE s_acctbal END AS s_acctbal) FROM src",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM src WHERE doc_id = 1) ||"
                 " CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' copy' || doc_id END ELSE text END AS text) FROM src",
    "embeddings": "SELECT * REPLACE (CASE WHEN vec_id % 3 = 0 THEN 2 ELSE label END AS label) FROM src",
    "conversations": "SELECT * REPLACE (CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS conv_id,"
                     " CASE WHEN conv_id % 3 = 0 THEN conv_id * 100 + turn ELSE turn END AS turn) FROM src",
}


def main() -> None:
    src, dst = sys.argv[1:3]
    os.makedirs(dst, exist_ok=True)
    for f in sorted(os.listdir(src)):
        name = f.removesuffix(".parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW src AS SELECT * FROM '{src}/{f}'")
        con.execute(f"COPY ({EDITS.get(name, 'SELECT * FROM src')}) TO '{dst}/{f}' (FORMAT parquet)")


if __name__ == "__main__":
    main()
