"""Queries stay right when one key, date, customer or value holds a third of all rows."""

import glob
import os

import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SOURCE = "/root/testdata/sf0.001"
CHANGES = {
    "lineitem": "CASE WHEN (l_partkey * 7 + l_suppkey) % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, CASE WHEN l_partkey % 3 = 0 THEN TIMESTAMP '1999-01-01' ELSE l_shipdate END AS l_shipdate",
    "orders": "CASE WHEN o_orderkey % 3 = 1 THEN 7 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1998-01-01' ELSE o_orderdate END AS o_orderdate, CASE WHEN o_orderkey % 3 = 0 THEN 1000.0 * (500 - (o_orderkey % 1000) / 2.0) ELSE o_totalprice END AS o_totalprice",
    "events": "CASE WHEN event_id % 3 = 0 THEN 11 ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 1 THEN 5.5 ELSE value END AS value",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for path in glob.glob(f"{SOURCE}/*.parquet"):
        name = os.path.basename(path)
        change = CHANGES.get(name.split(".")[0])
        columns = f"* REPLACE ({change})" if change else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{path}') TO '{folder}/{name}' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "claim_rows", "decile_lift", "score_deciles", "score_rank", "time_split", "score_quantiles", "exact_curve_areas", "drift_table",
        "event_value_drift", "latest_scores", "alias_state", "quarantine_reasons", "duplicate_claim_keys", "baseline_claim_rows", "scoring_flow_scores",
    ],
)
def test_skewed(spark, skewed, name):
    assert compare(entry.queries()[name](spark, skewed), entry.oracle_sql()[name], connect(skewed)) == []
