"""Dated copies: the latest is found without opening another."""

from pathlib import Path

from costlake.sources import reports


def test_the_latest_copy_alone_is_opened(spark, tmp_path):
    path = str(tmp_path / "copies")
    for date, n in (("2024-02-01", 5), ("2023-12-31", 7), ("2024-02-01", 3), ("2024-01-15", 4)):
        reports.write_snapshot(spark.range(n), path, date)
    assert reports.latest_snapshot(spark, path).isoformat() == "2024-02-01"
    assert {p.name for p in (tmp_path / "copies").glob("snapshot_date=*")} == {"snapshot_date=2023-12-31", "snapshot_date=2024-01-15", "snapshot_date=2024-02-01"}
    assert reports.read_snapshot(spark, path, "2024-01-15").count() == 4
    assert reports.read_snapshot(spark, path, "1999-01-01").count() == 0
    for old in (tmp_path / "copies").glob("snapshot_date=202[34]-[01][12]-*5/*.parquet"):
        old.write_bytes(b"broken")
    for old in (tmp_path / "copies" / "snapshot_date=2023-12-31").glob("*.parquet"):
        old.write_bytes(b"broken")
    found = reports.read_snapshot(spark, path)
    assert found.count() == 3 and found.select("snapshot_date").distinct().first()[0].isoformat() == "2024-02-01"
    assert "snapshot_date=2023" not in str(found.inputFiles()) and len({Path(f).parent for f in found.inputFiles()}) == 1


def test_tables_without_a_list_of_dates_are_read_as_before(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.sql("SELECT 1 AS id, DATE '2020-01-01' AS snapshot_date UNION ALL SELECT 2, DATE '2021-01-01'").write.partitionBy("snapshot_date").parquet(path)
    assert reports.latest_snapshot(spark, path) is None
    assert [r["id"] for r in reports.read_snapshot(spark, path).collect()] == [2]
