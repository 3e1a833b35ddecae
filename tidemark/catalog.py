"""What is refreshed: one configuration per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import as_list
from tidemark.operators.profile import CATEGORY_LIMIT
from tidemark.operators.shape import NO_FIELD, filter_matching
from tidemark.operators.versions import KEEP_CHANGE_LOGS, KEEP_VERSIONS
from tidemark.sources.pages import PAGE_SIZE

CATALOG_SCHEMA = (
    "table_name_descriptive string, table_name string, field_name string, id_vars string, download_size int"
)

# The default tables with their date field; all have the key Id
# and pages of 1000 rows.
DEFAULT_TABLES = [
    ("Activity", "Activity", "LastUpdateDate"),
    ("Case", "Case", "LastUpdateDate"),
    ("Environmental Sample", "EnvSample", "LastUpdateDate"),
    ("Geography", "Geography", "UpdatedDate"),
    ("Lab Specimen", "LabSpecimen", "LastUpdateDate"),
    ("LQAS", "Lqas", "None"),
    ("Population", "Population", "UpdatedDate"),
    ("Synonym", "Synonym", "UpdatedDate"),
    ("Virus", "Virus", "UpdatedDate"),
    ("Independent Monitoring", "Im", "None"),
]

# The columns read from one table that has no date field to filter on.
ACTIVITY_COLUMNS = (
    "Id,ActivityNumber,ActivityParentCode,ActivityDateFrom,ActivityType,WHORegion,Admin0Id,Admin0Name,"
    "ActivityAgeGroupCode,ActivityStatusCode,ActivityVaccineType,LqasDataLoaded,NbDoses,CountryPopulation,"
    "TargetPopulation,ActivityParentChildrenInaccessible,ActivityChildrenImmunized,"
    "ActivityParentLinkedOutbreaksList,Admin0TrendId,SIASubActivityCode,ActivityParentId,InitialPlannedDate,"
    "ActivityDateTo,IsPlannedDatesConfirmed,ISTName,CountryISO3Code,Admin0Guid,ActivityAgeGroup,ActivityStatus,"
    "ActivityAdditionalInterventions,IMDataLoaded,AreaPopulationPercent,AreaPopulation,"
    "PostCampaignImmunizedPercentage,ActivityChildrenInaccessible,LastUpdateDate,Admin0ShapeId"
).split(",")


@dataclass(frozen=True)
class TableConfig:
    """``keys`` identify a row; ``field`` is its change date, or ``None`` as text.

    Columns with more than ``category_limit`` values have no value set; ``keep_versions`` and ``keep_change_logs`` say
    how many old versions and change records of the table are kept. ``layout`` says how a version is cut into buckets: ``hash:n``
    for n buckets, ``range:w`` for w consecutive ids in each (one integer key).
    """

    table_name: str
    keys: list[str] = field(default_factory=lambda: ["Id"])
    field: str = NO_FIELD
    page_size: int = PAGE_SIZE
    description: str | None = None
    columns: list[str] | None = None
    infer_classes: bool = False
    category_limit: int = CATEGORY_LIMIT
    keep_versions: int = KEEP_VERSIONS
    keep_change_logs: int = KEEP_CHANGE_LOGS
    layout: str = "hash:32"


def default_catalog(spark: SparkSession) -> DataFrame:
    rows = [(label, name, date_field, "Id", PAGE_SIZE) for label, name, date_field in DEFAULT_TABLES]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def tables_matching(catalog: DataFrame, pattern: str) -> DataFrame:
    """Catalog rows whose table name matches a regular expression."""
    return filter_matching(catalog, "table_name", pattern)


def configs(catalog: DataFrame) -> list[TableConfig]:
    """The catalog as configurations; several key columns are comma-separated."""
    return [
        TableConfig(
            table_name=row.table_name,
            keys=[k.strip() for k in row.id_vars.split(",")],
            field=row.field_name,
            page_size=int(row.download_size),
            description=row.table_name_descriptive,
            columns=ACTIVITY_COLUMNS if (row.table_name, row.field_name) == ("Activity", NO_FIELD) else None,
        )
        for row in catalog.collect()
    ]


def config(table_name: str, keys: str | list[str] = "Id", field: str = NO_FIELD, **more) -> TableConfig:
    return TableConfig(table_name, as_list(keys), field, **more)
