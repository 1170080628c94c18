"""Cleaning (CLN). The SQL side computes the typed value the messy text was rendered from."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions import cleaning as fc
from costlake.operators import cleaning
from costlake.sources.tables import stamp_processed


@check("cln_01_snake_case_columns", f"""WITH {fx.JOBS} SELECT CAST(record_id AS VARCHAR) AS record_id,
 coalesce(permit_number, ' N/A ') AS permit_number FROM jobs""")
def _(spark, sf):
    return cleaning.snake_case_columns(fx.raw_jobs(spark, sf)).select("record_id", "permit_number")


@check("cln_02_null_tokens", f"""WITH {fx.JOBS} SELECT CAST(record_id AS VARCHAR) AS record_id, permit_number,
 trim(adu) AS adu, CAST(CAST(estimated_cost AS BIGINT) AS VARCHAR) AS estimated_cost FROM jobs""")
def _(spark, sf):
    return fx.clean_text_jobs(spark, sf).select("record_id", "permit_number", "adu", "estimated_cost")


@check("cln_03_parse_date", f"""WITH {fx.JOBS} SELECT record_id,
 CASE WHEN record_id % 17 <> 0 AND record_id % 23 <> 0 THEN created END AS created FROM jobs""")
def _(spark, sf):
    return fx.clean_text_jobs(spark, sf).select(
        F.col("record_id").cast("bigint").alias("record_id"),
        fc.parse_date(F.col("permit_creation_date")).alias("created"))


@check("cln_04_parse_int", f"""WITH {fx.JOBS} SELECT record_id, CAST(CASE WHEN record_id % 2 = 0
 THEN existing_units * 1000 ELSE existing_units END AS INTEGER) AS existing_units FROM jobs""")
def _(spark, sf):
    return fx.clean_text_jobs(spark, sf).select(
        F.col("record_id").cast("bigint").alias("record_id"),
        fc.parse_int(F.col("existing_units")).alias("existing_units"))


@check("cln_05_parse_money", f"WITH {fx.JOBS} SELECT record_id, revised_cost, estimated_cost FROM jobs")
def _(spark, sf):
    return fx.clean_text_jobs(spark, sf).select(
        F.col("record_id").cast("bigint").alias("record_id"),
        fc.parse_money(F.col("revised_cost")).alias("revised_cost"),
        fc.parse_money(F.col("estimated_cost")).alias("estimated_cost"))


@check("cln_06_extract_zip", f"""WITH {fx.JOBS} SELECT record_id, CASE WHEN record_id % 13 <> 0
 THEN '94' || lpad(CAST(record_id % 158 AS VARCHAR), 3, '0') END AS zipcode FROM jobs""")
def _(spark, sf):
    return fx.clean_text_jobs(spark, sf).select(
        F.col("record_id").cast("bigint").alias("record_id"), fc.extract_zip(F.col("zipcode")).alias("zipcode"))


@check("cln_07_quality_flags", f"""WITH {fx.JOBS} SELECT record_id, record_id IS NOT NULL AS dq_has_record_id,
 permit_number IS NOT NULL AS dq_has_permit_number,
 coalesce(estimated_cost > 0, false) AS dq_valid_estimated_cost,
 coalesce(revised_cost > 0, false) AS dq_valid_revised_cost FROM jobs""")
def _(spark, sf):
    return fx.flagged_jobs(spark, sf).select(
        "record_id", "dq_has_record_id", "dq_has_permit_number", "dq_valid_estimated_cost",
        "dq_valid_revised_cost")


@check("cln_08_calendar_parts", """SELECT o_orderkey, CAST(date_part('year', o_orderdate) AS INTEGER) AS year,
 CAST(date_part('month', o_orderdate) AS INTEGER) AS month FROM orders""")
def _(spark, sf):
    dated = cleaning.calendar_parts(fx.table(spark, sf, "orders"), "o_orderdate", "year", "month")
    return dated.select("o_orderkey", "year", "month")


@check("cln_09_stamp_processed", "SELECT o_orderkey, true AS stamped FROM orders")
def _(spark, sf):
    stamped = stamp_processed(fx.table(spark, sf, "orders"))
    return stamped.select("o_orderkey", F.col("_processed_at").isNotNull().alias("stamped"))


@check("cln_10_coerce_named_dates", f"""WITH {fx.JOBS} SELECT record_id, CAST(CASE WHEN record_id % 17 = 0
 OR record_id % 23 = 0 THEN NULL WHEN record_id % 4 = 0 THEN created + INTERVAL '15 hours 31 minutes 40 seconds'
 ELSE created END AS TIMESTAMP) AS permit_creation_date FROM jobs""")
def _(spark, sf):
    coerced = cleaning.coerce_named_dates(fx.clean_text_jobs(spark, sf))
    return coerced.select(F.col("record_id").cast("bigint").alias("record_id"),
                          F.col("permit_creation_date").cast("timestamp_ntz").alias("permit_creation_date"))


@check("cln_11_legacy_zip", f"""WITH {fx.PLACES} SELECT place_id, CASE WHEN place_id % 8 = 0 THEN ''
 ELSE CAST(94100 + place_id % 59 AS VARCHAR) END AS zipcode FROM places""")
def _(spark, sf):
    return fx.places(spark, sf).select("place_id", fc.legacy_zip(F.col("zip_float")).alias("zipcode"))


@check("cln_12_street_name", f"""WITH {fx.PLACES} SELECT place_id, CASE WHEN left(street, 1) = '0'
 THEN substr(street, 2) ELSE street END AS street FROM places""")
def _(spark, sf):
    return fx.places(spark, sf).select("place_id", fc.street_name(F.col("street")).alias("street"))


_SUFFIX = """CASE WHEN street = 'La Playa' THEN 'Street' WHEN suffix = 'Bl' THEN 'Blvd'
 WHEN suffix = 'Tr' THEN 'Terrace' WHEN suffix = 'Cr' THEN 'Circle' WHEN suffix IS NULL THEN ' '
 ELSE suffix END"""


@check("cln_13_street_suffix", f"WITH {fx.PLACES} SELECT place_id, {_SUFFIX} AS suffix FROM places")
def _(spark, sf):
    return fx.places(spark, sf).select(
        "place_id", fc.street_suffix(F.col("suffix"), F.col("street")).alias("suffix"))


@check("cln_14_full_address", f"""WITH {fx.PLACES} SELECT place_id, number || ' ' || street || ' ' || {_SUFFIX} ||
 ', San Francisco, CA ' || CASE WHEN place_id % 8 = 0 THEN '' ELSE CAST(94100 + place_id % 59 AS VARCHAR) END
 AS address FROM places""")
def _(spark, sf):
    return fx.places(spark, sf).select("place_id", fc.full_address(
        F.col("number"), F.col("street"), fc.street_suffix(F.col("suffix"), F.col("street")),
        fc.legacy_zip(F.col("zip_float"))).alias("address"))


@check("cln_15_construction_type", f"""WITH {fx.PLACES} SELECT place_id, CASE WHEN place_type = 'III' THEN '3'
 WHEN place_type IS NULL THEN '99' ELSE left(place_type, 1) END AS construction_type FROM places""")
def _(spark, sf):
    return fx.places(spark, sf).select(
        "place_id", fc.construction_type(F.col("place_type")).alias("construction_type"))


@check("cln_16_code_maps", """SELECT o_orderkey,
 CASE WHEN o_orderkey % 5 IN (0, 3) THEN 1 ELSE 2 END AS permit_code,
 CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '5' ELSE 'Other' END AS construction_code,
 CASE o_orderkey % 5 WHEN 0 THEN 'Fire resistive' WHEN 1 THEN 'Non-combustible' WHEN 2 THEN 'Ordinary'
  WHEN 3 THEN 'Wood-framed' END AS construction_label FROM orders""")
def _(spark, sf):
    slot = F.col("o_orderkey") % 5
    permit = F.when(slot.isin(0, 3), "New Construction (Reinforced concrete, Steel, etc...)").otherwise(
        "New Construction Wood Frame")
    labels = F.array(*[F.lit(v) for v in [*fc.CONSTRUCTION_TYPE_CODES, "Brick"]])
    # labels come in the order 1, 2, 3, 5, unknown
    construction = F.element_at(labels, (slot + 1).cast("int"))
    code = fc.construction_type_code(construction)
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", fc.permit_type_code(permit).alias("permit_code"), code.alias("construction_code"),
        fc.code_label(code, fc.CONSTRUCTION_TYPE_CODES).alias("construction_label"))


@check("cln_17_money_text", """SELECT o_orderkey,
 replace(format('{:,}', CAST(floor(o_totalprice * 10) AS BIGINT)), ',', ' ') AS money FROM orders""")
def _(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", fc.money_text(F.col("o_totalprice") * 10).alias("money"))
