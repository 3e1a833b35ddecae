"""Column types declared in a schema document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import as_text, col
from tidemark.functions.ladder import read_as
from tidemark.functions.text import strip_affix, trim_text

# Marks removed from names, and the class of each declared type.
TABLE_MARK = "ApiV2"
TYPE_MARK = "Edm."
DECLARED_CLASSES = {
    "Boolean": "logical",
    "DateTime": "timestamp",
    "Decimal": "numeric",
    "Double": "numeric",
    "Int16": "numeric",
    "Int32": "numeric",
    "Int64": "numeric",
    "Guid": "character",
    "String": "character",
}
LADDER_CLASS = {"logical": "logical", "timestamp": "datetime", "numeric": "number", "character": "character"}

_TYPE = "_Name string, Property array<struct<_Name: string, _Type: string>>"


def _columns(types: DataFrame) -> DataFrame:
    columns = types.select("_Name", F.explode("Property").alias("p"))
    return columns.select(
        strip_affix(F.col("_Name"), TABLE_MARK).alias("table"),
        F.col("p")["_Name"].alias("column"),
        strip_affix(F.col("p")["_Type"], TYPE_MARK).alias("edm_type"),
    )


def read_declared_types(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per declared column in files: ``table``, ``column``, ``edm_type``.

    With ``multi_line`` a file is one XML document; otherwise every line of it
    is one type, and big files are split between tasks.
    """
    reader = spark.read.format("xml").option("rowTag", "EntityType").option("multiLine", str(multi_line).lower())
    return _columns(reader.schema(_TYPE).load(path))


def parse_declared_types(documents: DataFrame, body: str = "body") -> DataFrame:
    """The same from a column that holds a whole schema document per row."""
    opened = F.from_xml(col(body), f"EntityType array<struct<{_TYPE}>>")
    return _columns(documents.select(opened.alias("d")).select(F.inline("d.EntityType")))


def declared_class(edm_type: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, kind in DECLARED_CLASSES.items():
        label = F.when(edm_type == name, F.lit(kind)).otherwise(label)
    return label


def map_declared_types(types: DataFrame) -> DataFrame:
    """Declared types with their ``class``; null for a type that is not known."""
    return types.withColumn("class", declared_class(F.col("edm_type")))


def apply_declared_types(df: DataFrame, types: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` read as declared for ``table``; others stay as they are.

    Only entries for columns of ``df`` reach the driver.
    """
    entries = (
        map_declared_types(types)
        .filter((F.col("table") == table) & F.col("column").isin(df.columns) & F.col("class").isNotNull())
        .groupBy("column")
        .agg(F.min("class").alias("lowest"), F.max("class").alias("highest"))
        .collect()
    )
    unclear = sorted(e["column"] for e in entries if e.lowest != e.highest)
    if unclear:
        raise ValueError(f"several declared types for {unclear}")
    classes = {e["column"]: LADDER_CLASS[e.lowest] for e in entries}
    read = {n for n, label in classes.items() if label != "character"}
    texts = df.select(
        *[
            (trim_text(as_text(f.name, f.dataType)) if f.name in read else as_text(f.name, f.dataType)).alias(f.name)
            if f.name in classes
            else col(f.name)
            for f in df.schema.fields
        ]
    )
    return texts.select(*[read_as(n, classes[n]).alias(n) if n in read else col(n) for n in df.columns])
