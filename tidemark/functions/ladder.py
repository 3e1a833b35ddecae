"""The ladder of value classes, as native expressions over text.

Each value gets a bit mask of every class it can be read as; ``bit_and`` over a
column leaves the classes that all its values share, and the lowest bit is the
strictest of them. One aggregate per column, no second look at the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_text, col
from tidemark.functions.text import trim_text

LOGICAL, INTEGER, DOUBLE, NUMBER, TIME, DATE, DATETIME, MIDNIGHT = (1 << i for i in range(8))

# Class names in ladder order, and the Spark type each one gets.
CLASSES = ["logical", "integer", "double", "number", "time", "date", "datetime", "character"]
CLASS_BITS = dict(zip(CLASSES, (LOGICAL, INTEGER, DOUBLE, NUMBER, TIME, DATE, DATETIME), strict=False))
SPARK_TYPES = {
    "logical": "boolean",
    "integer": "bigint",
    "double": "double",
    "number": "double",
    "time": "string",
    "date": "date",
    "datetime": "timestamp_ntz",
    "character": "string",
}

# Texts read as missing, and the text patterns of each class.
MISSING = ["", "NA"]
TRUE_TEXTS = ["T", "TRUE", "true"]
FALSE_TEXTS = ["F", "FALSE", "false"]
INTEGER_TEXT = r"^-?(0|[1-9][0-9]*)$"
DOUBLE_TEXT = r"^-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?$"
NUMBER_TEXT = r"^-?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]*)?$"
TIME_TEXT = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?( ?[AaPp][Mm])?$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
CLOCK_TEXT = r"[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
ZONE_TEXT = r"(Z|[-+][0-9]{2}:?[0-9]{2})$"
LOCAL_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(" + CLOCK_TEXT + ")?$"
DATETIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}" + CLOCK_TEXT + "(Z|[-+][0-9]{2}:?[0-9]{2})?$"
ZONED_TEXT = CLOCK_TEXT + ZONE_TEXT
MIDNIGHT_TEXT = r"[T ]00:00(:00(\.0+)?)?$"
FIRST_CHARACTERS = list("-.0123456789")


_TEXTS = {
    "missing": ", ".join(f"'{x}'" for x in MISSING),
    "true": ", ".join(f"'{x}'" for x in TRUE_TEXTS),
    "false": ", ".join(f"'{x}'" for x in FALSE_TEXTS),
    "first": ", ".join(f"'{x}'" for x in FIRST_CHARACTERS),
    "double": f"r'{DOUBLE_TEXT}'",
    "number": f"r'{NUMBER_TEXT}'",
    "time": f"r'{TIME_TEXT}'",
    "date": f"r'{DATE_TEXT}'",
    "datetime": f"r'{DATETIME_TEXT}'",
    "zoned": f"r'{ZONED_TEXT}'",
    "midnight": f"r'{MIDNIGHT_TEXT}'",
    "integer": f"r'{INTEGER_TEXT}'",
    "grouped": f"r'{DOUBLE_TEXT}|{NUMBER_TEXT}'",
    "local": f"r'{LOCAL_TEXT}'",
    "instant": f"r'{LOCAL_TEXT[:-1]}{ZONE_TEXT}'",
    "words": ", ".join([f"'{x}', true" for x in TRUE_TEXTS] + [f"'{x}', false" for x in FALSE_TEXTS]),
}

# ISO text as a zone-free time stamp; text with a zone is moved to UTC.
_MOMENT = """
CASE WHEN {t} RLIKE {zoned}
     THEN timestampadd(MICROSECOND,
                       unix_micros(try_cast(regexp_replace({t}, r'([-+][0-9]{{2}})([0-9]{{2}})$', '$1:$2') AS timestamp)),
                       TIMESTAMP_NTZ '1970-01-01 00:00:00')
     ELSE try_cast({t} AS timestamp_ntz) END"""

# Cheap tests come first: most values are settled without a regular expression.
_MASK = """
CASE WHEN {t} IS NULL THEN NULL
     WHEN substring({t}, 1, 1) IN ('T', 'F', 't', 'f') THEN CASE WHEN {t} IN ({true}, {false}) THEN {LOGICAL} ELSE 0 END
     WHEN substring({t}, 1, 1) NOT IN ({first}) THEN 0
     WHEN {whole} THEN {WHOLE}
     WHEN substring({t}, 5, 1) = '-' AND {t} RLIKE {date}
     THEN CASE WHEN try_cast({t} AS date) IS NOT NULL THEN {DAY} ELSE 0 END
     WHEN substring({t}, 5, 1) = '-' AND {t} RLIKE {datetime}
     THEN CASE WHEN {t} RLIKE {zoned}
               THEN coalesce({DATETIME} + {MIDNIGHT} * CAST(date_format({moment}, 'HHmmssSSSSSS') = '000000000000' AS int), 0)
               WHEN try_cast({t} AS timestamp_ntz) IS NULL THEN 0
               WHEN {t} RLIKE {midnight} THEN {DATETIME} + {MIDNIGHT}
               ELSE {DATETIME} END
     WHEN {t} RLIKE {double} THEN {REAL}
     WHEN {t} RLIKE {number} THEN {NUMBER}
     WHEN {t} RLIKE {time} THEN {TIME}
     ELSE 0 END"""

# Up to 18 digits always fit, so only longer ones are tried.
_WHOLE = "({t} RLIKE {integer} AND (length({t}) <= 18 OR try_cast({t} AS bigint) IS NOT NULL))"

# Each form names its text once or twice only: a filter that Spark moves below
# the cast then stays small.
_STAMP = """coalesce(
    try_cast(regexp_extract({t}, {local}, 0) AS timestamp_ntz),
    timestampadd(MICROSECOND,
                 unix_micros(try_cast(regexp_replace(regexp_extract({t}, {instant}, 0), r'([-+][0-9]{{2}})([0-9]{{2}})$', '$1:$2') AS timestamp)),
                 TIMESTAMP_NTZ '1970-01-01 00:00:00'))"""

_READ = {
    "logical": "element_at(map({words}), {t})",
    "integer": "try_cast(regexp_extract({t}, {integer}, 0) AS bigint)",
    "double": "try_cast(regexp_extract({t}, {double}, 0) AS double)",
    "number": "try_cast(replace(regexp_extract({t}, {grouped}, 0), ',', '') AS double)",
    "time": "CASE WHEN {t} RLIKE {time} THEN {t} END",
    "date": "CAST({stamp} AS date)",
    "datetime": "{stamp}",
    "character": "{t}",
}


def _fill(template: str, name: str, **values) -> Column:
    t = "`" + name.replace("`", "``") + "`"
    moment = _MOMENT.format(t=t, **_TEXTS)
    stamp = _STAMP.format(t=t, **_TEXTS)
    return F.expr(template.format(t=t, moment=moment, stamp=stamp, whole=_WHOLE.format(t=t, **_TEXTS), **_TEXTS, **values))


def present_texts(df: DataFrame, names: list[str]) -> DataFrame:
    """``names`` as trimmed text, null where the text means a missing value."""
    is_text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    texts = df.select(
        *[
            (trim_text(col(f.name)) if f.name in is_text else as_text(f.name, f.dataType)).alias(f.name)
            if f.name in names
            else col(f.name)
            for f in df.schema.fields
        ]
    )
    marked = [n for n in names if n in is_text]
    return texts.select(*[F.when(~col(n).isin(*MISSING), col(n)).alias(n) if n in marked else col(n) for n in df.columns])


def class_mask(name: str, integers: bool = True) -> Column:
    """Bit mask of the classes a value of a text column fits; null where it is missing."""
    return _fill(
        _MASK,
        name,
        LOGICAL=LOGICAL,
        WHOLE=(INTEGER if integers else 0) | DOUBLE | NUMBER,
        REAL=DOUBLE | NUMBER,
        NUMBER=NUMBER,
        TIME=TIME,
        DAY=DATE | DATETIME | MIDNIGHT,
        DATETIME=DATETIME,
        MIDNIGHT=MIDNIGHT,
    )


def read_as(name: str, label: str) -> Column:
    """A text column read as ``label``; null where it cannot be."""
    if label not in _READ:
        raise ValueError(f"unknown class {label!r}")
    return _fill(_READ[label], name)


def class_name(mask: Column) -> Column:
    """Strictest class in a combined mask; a column without values is logical."""
    name = F.when(mask.isNull(), F.lit("logical"))
    for bit, label in zip((LOGICAL, INTEGER, DOUBLE, NUMBER, TIME, DATE, DATETIME), CLASSES):
        name = name.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(label))
    return name.otherwise(F.lit("character"))
