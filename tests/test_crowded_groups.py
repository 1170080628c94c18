"""Queries whose SQL wants an exact median, on groups with more distinct values than a sketch holds."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks import verify


@pytest.fixture(scope="module")
def crowded(tmp_path_factory):
    out = tmp_path_factory.mktemp("crowded")
    db = duckdb.connect()
    tables = {
        "nation": "SELECT CAST(0 AS INTEGER) AS n_nationkey, 'HERE' AS n_name",
        "customer": "SELECT CAST(0 AS BIGINT) AS c_custkey, CAST(0 AS INTEGER) AS c_nationkey, 'HOME' AS c_mktsegment",
        # 60,000 distinct prices in two months, shuffled
        "orders": """SELECT i AS o_orderkey, CAST(0 AS BIGINT) AS o_custkey, 'F' AS o_orderstatus, i * 7919 % 60013 + 0.25E0 AS o_totalprice,
         TIMESTAMP '1999-01-01' + INTERVAL 1 DAY * (i % 50) AS o_orderdate, 'LOW' AS o_orderpriority FROM range(60000) r(i)"""}
    for name, sql in tables.items():
        db.execute(f"COPY ({sql}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", ["top_02_sorted_by_key", "agg_08_group_profile_known_keys", "agg_15_source_by_split"])
def test_medians_of_crowded_groups(spark, crowded, name):
    verdict, _ = verify.compare(spark, verify.connect(crowded), name, crowded)
    assert verdict == "ok"


def test_sorted_by_key(spark, crowded):
    rows = contract.queries()["top_02_sorted_by_key"](spark, crowded).collect()
    assert [r["permit_creation_month"] for r in rows] == [1, 2]
