"""Cleaning a table stays within the code size up to which the JVM compiles a row loop."""

import re
from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.q_flows import RAW_TABLE
from costlake.functions import cleaning as fc
from costlake.operators import cleaning
from costlake.sources import tables

COMPILED = 8000


def test_cleaned_rows_are_compiled(spark, capsys, tmp_path):
    raw = tables.write_verified(tables.stamp_ingest(fx.raw_jobs(spark, "/root/testdata/sf0.001"), "order book", "ob-1"), f"{tmp_path}/raw")
    typed = cleaning.apply_types(cleaning.null_tokens(cleaning.snake_case_columns(raw)), RAW_TABLE.types)
    cleaning.quality_flags(typed, RAW_TABLE.quality).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= COMPILED, sizes


def test_dates_of_every_row_and_of_none(rows):
    df = rows("t string", ("2024/02/03",), (None,), ("02/03/2024 01:02:03 PM",), ("soon",), ("2024-02-03T00:00:00.000",), ("2024-02-30",))
    got = [r["d"] for r in df.select(fc.parse_date(F.col("t")).alias("d")).collect()]
    assert got == [date(2024, 2, 3), None, date(2024, 2, 3), None, date(2024, 2, 3), None]
    assert dict(df.select(fc.parse_date(F.col("t")).alias("d"), fc.parse_timestamp(F.col("t")).alias("s")).dtypes) == {"d": "date", "s": "timestamp"}
