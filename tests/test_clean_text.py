import re
import unicodedata

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.plans import clean


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c"))).first()[0]


def ascii_of(spark, value):
    return one(spark, value, text.latin_ascii)


def test_trim_takes_every_white_space(spark):
    for space in text.WHITE_SPACE:
        assert one(spark, f"{space}a b{space}{space}", text.trim_text) == "a b"
    assert one(spark, "　", text.trim_text) == ""
    assert one(spark, None, text.trim_text) is None


def test_latin_ascii(spark):
    cases = {
        "crème brûlée": "creme brulee",
        "Straße ẞ": "Strasse SS",
        "Łódź Ærø œuvre þing": "Lodz AEro oeuvre thing",
        "“q” – ‘s’… «x» ½": "\"q\" - 's'... <<x>>  1/2",
        "é̂ ñ": "e n",
        "Ελλάδα Москва 東京": "Ελλάδα Москва 東京",
        "plain": "plain",
        "": "",
        None: None,
    }
    for given, expected in cases.items():
        assert ascii_of(spark, given) == expected
        if given is not None and given != "é̂ ñ":
            assert text.latin_ascii_name(given) == expected


def test_no_accented_letter_is_left(spark):
    letters = "".join(
        c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if len(unicodedata.normalize("NFD", c)) > 1
    )
    left = ascii_of(spark, letters)
    assert not [c for c in left if not c.isascii() and re.match(r"LATIN .* WITH", unicodedata.name(c)) and unicodedata.normalize("NFD", c)[0].isascii()]


def test_small_functions(spark):
    assert one(spark, "2020-01-31T10:00:00", text.date_prefix).isoformat() == "2020-01-31"
    assert one(spark, "2020-02-31", text.date_prefix) is None
    assert one(spark, "Brand#12", lambda c: text.strip_affix(c, "Brand#", "prefix")) == "12"
    assert one(spark, "value.x", lambda c: text.strip_affix(c, ".x", "suffix")) == "value"
    assert one(spark, "xx", lambda c: text.strip_affix(c, "x")) == ""
    assert one(spark, "2020-01-31 10:00:05", lambda c: text.version_label(c.cast("timestamp_ntz"))) == "20200131_100005"
    assert one(spark, "2020-01-31 10:00:05", lambda c: text.snapshot_label(c.cast("timestamp_ntz"))) == "20200131_100005"


def test_clean_table(spark, rows):
    raw = spark.createDataFrame(
        [
            ("1", " é ", "2020-01-01T00:00:00", "1.50", ""),
            ("1", "e", "2020-01-01", "1.5", None),
            ("", " ", None, "NA", "\t"),
            ("2", "ß", "2020-01-02", "2", "NA"),
        ],
        ["RowId", "Some Text", "When?", "% Share", "Empty"],
    )
    cleaned = clean.clean_table(raw)
    assert cleaned.dtypes == [
        ("row_id", "bigint"), ("some_text", "string"), ("when", "date"), ("percent_share", "double"), ("empty", "boolean"),
    ]
    assert [(r[0], r[1], str(r[2]), r[3], r[4]) for r in rows(cleaned)] == [
        (1, "e", "2020-01-01", 1.5, None),
        (2, "ss", "2020-01-02", 2.0, None),
    ]
    assert rows(clean.clean_table(cleaned)) == rows(cleaned)


def test_blank_to_null(spark, rows):
    df = spark.createDataFrame([(1, " a\t"), (2, "  ")], "i int, s string")
    assert rows(clean.blank_to_null(df)) == [("1", "a"), ("2", None)]
    assert rows(clean.trim_all(df)) == [("1", "a"), ("2", "")]


def test_filters_on_cleaned_columns_stay_small(spark, small):
    """A filter is moved below all cleaning steps; it must not multiply them."""
    cleaned = clean.clean_table(clean.clean_table(spark.read.parquet(f"{small}/customer.parquet")))
    plan = cleaned.filter("c_mktsegment = 'BUILDING' AND c_custkey > 3").filter("c_name IS NOT NULL")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("trim(") < 300
    assert plan.count() > 0
