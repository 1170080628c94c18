"""Column roles of the city building-permit table. Another table needs only another set."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from costlake.operators.cleaning import QualityPlan, TypePlan


@dataclass(frozen=True)
class CostTable:
    """What each column of a cost table is for."""

    key: str
    newest: tuple[str, ...]
    types: TypePlan
    quality: QualityPlan
    creation_date: str
    year: str
    month: str
    amounts: tuple[tuple[str, str], ...]
    differences: dict[str, tuple[str, str]]
    yes_no: dict[str, str]
    feature_columns: tuple[str, ...]
    null_checked: tuple[str, ...]
    category_numbers: dict[str, str]
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    text: str
    profiles: dict[str, tuple[tuple[str, ...], tuple[str, ...], int | None]] = field(default_factory=dict)
    scale_averages: dict[str, str] = field(default_factory=dict)


# Column names of the permit table after snake-casing.
PERMITS = CostTable(
    key="record_id",
    newest=("data_loaded_at", "current_status_date", "ingested_at"),
    types=TypePlan(
        dates=("permit_creation_date", "current_status_date", "filed_date", "issued_date",
               "completed_date", "first_construction_document_date", "approved_date",
               "structural_notification_date", "expiration_date", "last_permit_activity_date",
               "data_as_of", "data_loaded_at"),
        integers=("permit_type", "street_number", "existing_units", "proposed_units", "plansets",
                  "existing_construction_type", "proposed_construction_type", "supervisor_district"),
        amounts=("estimated_cost", "revised_cost", "number_of_existing_stories",
                 "number_of_proposed_stories"),
        zips=("zipcode",),
    ),
    quality=QualityPlan(
        present={"dq_has_record_id": "record_id", "dq_has_permit_number": "permit_number"},
        positive={"dq_valid_estimated_cost": "estimated_cost", "dq_valid_revised_cost": "revised_cost"},
    ),
    creation_date="permit_creation_date",
    year="permit_creation_year",
    month="permit_creation_month",
    amounts=(("revised_cost", "dq_valid_revised_cost"), ("estimated_cost", "dq_valid_estimated_cost")),
    differences={"story_change": ("number_of_proposed_stories", "number_of_existing_stories"),
                 "unit_change": ("proposed_units", "existing_units")},
    yes_no={"is_adu": "adu", "is_site_permit": "site_permit", "is_reroof": "reroof"},
    feature_columns=(
        "record_id", "permit_number", "target_cost", "target_cost_log10", "target_source",
        "permit_creation_year", "permit_creation_month", "zipcode", "supervisor_district",
        "neighborhoods_analysis_boundaries", "permit_type", "permit_type_definition", "description",
        "application_submission_method", "existing_use", "proposed_use",
        "number_of_existing_stories", "number_of_proposed_stories", "story_change",
        "existing_units", "proposed_units", "unit_change", "existing_construction_type",
        "proposed_construction_type", "existing_construction_type_description",
        "proposed_construction_type_description", "is_adu", "is_site_permit", "is_reroof"),
    null_checked=(
        "permit_creation_year", "permit_creation_month", "zipcode", "supervisor_district",
        "permit_type", "permit_type_definition", "application_submission_method", "existing_use",
        "proposed_use", "number_of_existing_stories", "number_of_proposed_stories",
        "existing_units", "proposed_units", "existing_construction_type",
        "proposed_construction_type", "is_adu", "is_site_permit", "is_reroof"),
    category_numbers={"supervisor_district": "supervisor_district_cat"},
    categorical=(
        "zipcode", "supervisor_district_cat", "neighborhoods_analysis_boundaries",
        "permit_type_definition", "application_submission_method", "existing_use", "proposed_use",
        "existing_construction_type_description", "proposed_construction_type_description"),
    numeric=(
        "permit_creation_year", "permit_creation_month", "number_of_existing_stories",
        "number_of_proposed_stories", "story_change", "existing_units", "proposed_units",
        "unit_change", "is_adu", "is_site_permit", "is_reroof"),
    text="description",
    # report name -> (group columns, those that must not be NULL, rows kept by size or None for all)
    profiles={
        "target_source": (("target_source",), (), None),
        "permit_types_top20": (("permit_type", "permit_type_definition"), ("permit_type_definition",), 20),
        "annual_trend": (("permit_creation_year",), ("permit_creation_year",), None),
        "neighborhoods_top20": (("neighborhoods_analysis_boundaries",), ("neighborhoods_analysis_boundaries",), 20),
        "zipcodes_top20": (("zipcode",), ("zipcode",), 20),
    },
    scale_averages={
        "avg_existing_stories": "number_of_existing_stories",
        "avg_proposed_stories": "number_of_proposed_stories",
        "avg_story_change": "story_change",
        "avg_existing_units": "existing_units",
        "avg_proposed_units": "proposed_units",
        "avg_unit_change": "unit_change",
    },
)

# Training policy of the permit models.
MIN_COST = 100.0
MAX_COST = 1_000_000.0
TRAIN_YEARS = (2015, 2023)
VALIDATION_YEAR = 2024
TEST_FROM = 2025


def scoring_schema(table: CostTable = PERMITS) -> StructType:
    """Input of batch scoring: categories, numbers, text; year, month and text are required.

    Amounts and their differences are doubles, as in the feature layer; other numbers are integers.
    """
    doubles = set(table.types.amounts)
    doubles |= {name for name, pair in table.differences.items() if doubles & set(pair)}
    required = {table.year, table.month}
    fields = [StructField(c, StringType(), True) for c in table.categorical]
    fields += [StructField(c, DoubleType() if c in doubles else IntegerType(), c not in required)
               for c in table.numeric]
    return StructType(fields + [StructField(table.text, StringType(), False)])
