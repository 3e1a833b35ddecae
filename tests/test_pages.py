import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import declared, pages


def page(*records, count=None):
    return json.dumps({"odata.count": str(len(records) if count is None else count), "value": list(records)})


@pytest.fixture
def landed(spark):
    bodies = [
        ("t", 0, page({"Id": 1, "Name": "a", "Nest": {"x": 1}}, {"Id": 2, "Flag": True})),
        ("t", 1000, page({"Id": 3, "List": [1, 2], "Name": None})),
        ("t", 2000, page()),
        ("t", 3000, "<html>503</html>"),
        ("t", 4000, None),
        ("t", 5000, '{"odata.count": "3", "value": [{"Id": 4}'),
        ("u", 0, page({"Id": 9}, count=5)),
    ]
    return spark.createDataFrame(bodies, "table_name string, skip bigint, body string")


def test_records_of_all_pages(landed):
    got = pages.read_landed_pages(landed)
    assert got.columns == ["Flag", "Id", "List", "Name", "Nest"]
    assert sorted((r.Id, r.Flag, r.List, r.Name, r.Nest) for r in got.collect()) == [
        ("1", None, None, "a", '{"x":1}'),
        ("2", "true", None, None, None),
        ("3", None, "[1,2]", None, None),
        ("9", None, None, None, None),
    ]
    named = pages.read_landed_pages(landed, ["Id", "Missing"], keep="table_name")
    assert named.columns == ["table_name", "Id", "Missing"] and named.count() == 4


def test_page_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(json.loads(page({"Id": 1, "Nest": {"x": 1}}, {"Id": 2, "Name": "b"})), indent=1))
    (tmp_path / "two.json").write_text(page({"Id": 3, "Name": "c"}))
    for got in (
        pages.read_json_pages(spark, str(tmp_path)),
        pages.read_landed_pages(pages.read_page_files(spark, str(tmp_path))),
    ):
        assert sorted((r.Id, r.Name) for r in got.collect()) == [("1", None), ("2", "b"), ("3", "c")]


def test_quarantine(spark, rows, landed):
    expected = spark.createDataFrame([("t", 0), ("t", 6000), ("u", 0)], "table_name string, skip bigint")
    failed = pages.quarantine_pages(landed, expected)
    assert rows(failed) == [
        ("t", 3000, "unreadable"),
        ("t", 4000, "unreadable"),
        ("t", 5000, "unreadable"),
        ("t", 6000, "absent"),
    ]


def test_counts(rows, landed):
    assert rows(pages.reconcile_counts(landed.filter("skip <= 2000"))) == [("t", 2, 3, False), ("u", 5, 1, False)]
    assert rows(pages.reconcile_counts(landed.filter("table_name = 't' AND skip = 0"))) == [("t", 2, 2, True)]


def test_expected_pages(spark, rows):
    counts = spark.createDataFrame([("t", 15000), ("u", 0), ("v", 999)], "table_name string, total bigint")
    got = pages.expected_pages(counts)
    assert got.filter("table_name = 't'").count() == 16
    assert rows(got.filter("table_name <> 't'")) == [("u", 0, 1000), ("v", 0, 1000)]
    assert pages.expected_pages(spark.createDataFrame([("w", 30_000_000)], counts.schema)).count() == 30_001


DOCUMENT = """<Schema Namespace="x">
  <EntityType Name="CaseApiV2"><Property Name="Id" Type="Edm.Int32"/><Property Name="When" Type="Edm.DateTime"/>
    <Property Name="Ok" Type="Edm.Boolean"/><Property Name="Blob" Type="Edm.Stream"/></EntityType>
  <EntityType Name="VirusApiV2"><Property Name="Guid" Type="Edm.Guid"/></EntityType>
</Schema>"""
TYPES = [
    ("Case", "Blob", "Stream", None),
    ("Case", "Id", "Int32", "numeric"),
    ("Case", "Ok", "Boolean", "logical"),
    ("Case", "When", "DateTime", "timestamp"),
    ("Virus", "Guid", "Guid", "character"),
]


def test_declared_types(spark, rows, tmp_path):
    (tmp_path / "schema.xml").write_text(DOCUMENT)
    types = declared.read_declared_types(spark, str(tmp_path))
    assert rows(declared.map_declared_types(types)) == TYPES
    column = spark.createDataFrame([(DOCUMENT,)], "body string")
    assert rows(declared.parse_declared_types(column)) == [t[:3] for t in TYPES]
    df = spark.createDataFrame([("1", "2020-01-01T10:00:00", "T", "b"), ("x", None, "F", None)], "Id string, When string, Ok string, Other string")
    typed = declared.apply_declared_types(df, types, "Case")
    assert [t for _, t in typed.dtypes] == ["double", "timestamp_ntz", "boolean", "string"]
    assert [r.Id for r in typed.collect()] == [1.0, None]
    assert declared.apply_declared_types(df, types.filter(F.lit(False)), "Case").dtypes == df.dtypes
