"""A content-addressed web archive: payload bytes once by digest, record headers apart, records rebuilt by joins.

The archive is two Parquet tables in a folder. ``payloads`` has one row for each distinct payload: its SHA-256 as the address
and the bytes. ``records`` has one row per page: the exact bytes of the WARC header and the HTTP header as text, the payload's address and
the record's type. Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the largest page_id is the
response and the others revisit it. Reading back joins both, checks the address against the bytes (a mismatch is an error) and takes
type, digest and reference from the header lines, as another reader of the records would.

Nulls and repeats: a null html is an empty payload, a null url an empty target; pages that share a page_id and payload give equal
records, of which all are responses if the id is the largest; a null page_id is smaller than any other. Other columns are not archived.
Equal payloads are found by SHA-256 over all pages; the largest page_id of a digest is a partial maximum before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1000
EOL = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(seed: Column) -> Column:
    """A name-based UUID from a digest of the seed."""
    h = F.sha1(seed)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), _uuid(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("")))), F.lit(">"))


def _header(*fields: tuple[str, Column | str]) -> Column:
    parts = [F.lit(f"WARC/1.1{EOL}")]
    for name, value in fields:
        value = F.lit(value) if isinstance(value, str) else value
        parts.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit("")))
    return F.concat(*parts, F.lit(EOL))


def build_records(pages: DataFrame, date: str = "2020-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT) -> tuple[DataFrame, DataFrame]:
    """Records and payloads of ``pages(page_id, url, html)``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.sha2(payload, 256).alias("address"), F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )
    largest = own.groupBy("address").agg(F.max("page_id").alias("keeper"))
    own = own.join(largest, "address")
    response = (F.col("payload_bytes") < min_revisit) | F.col("page_id").eqNullSafe(F.col("keeper"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL + EOL)
    )
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    length = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(F.lit(0))
    # Line breaks in a target would end its header line.
    target = F.regexp_replace("url", r"[\r\n]", "%0A")
    head = _header(
        ("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        ("WARC-Record-ID", _record_id(F.col("page_id"))),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(~response, F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(~response, _record_id(F.col("keeper")))),
        ("WARC-Refers-To-Page", F.when(~response, F.col("keeper").cast("string"))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", length.cast("string")),
    )
    records = own.select("page_id", "address", head.alias("warc_header"), http.alias("http_header"))
    stored = pages.select("page_id", payload.alias("payload"), F.sha2(payload, 256).alias("address"))
    return records, stored


def write_archive(pages: DataFrame, folder: str, **options) -> None:
    """Write both tables; each distinct payload's bytes are stored once."""
    records, stored = build_records(pages, **options)
    records.write.parquet(f"{folder}/records")
    # Who keeps a payload is decided by digest alone; bytes move once, by a key that no two different pages share.
    named = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("named")
    keepers = stored.groupBy("address").agg(F.max("page_id").alias("page_id")).select("address", named)
    kept = stored.select("address", named, "payload").join(keepers, ["address", "named"], "left_semi")
    kept.dropDuplicates(["address", "named"]).select("address", "payload").write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records: ``page_id, record_type, refers_to, payload_digest, warc_header, http_header, payload``.

    ``payload`` is the full payload, for revisits too. ``payload_digest`` is taken from its bytes and must equal the header's.
    """
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads")
    field = lambda name: F.regexp_extract("warc_header", rf"\n{name}: ([^\r]*)\r", 1)
    joined = records.join(payloads, "address", "left").select(
        "page_id",
        field("WARC-Type").alias("record_type"),
        F.when(field("WARC-Type") == "revisit", field("WARC-Refers-To-Page").cast("bigint")).alias("refers_to"),
        F.sha1("payload").alias("payload_digest"),
        "warc_header",
        "http_header",
        "payload",
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("_stated"),
        "address",
    )
    sound = F.assert_true((F.sha2("payload", 256) == F.col("address")) & (F.col("payload_digest") == F.col("_stated")), F.lit("a payload does not match its digest"))
    return joined.where(sound.isNull()).drop("_stated", "address")


def record_bytes(archive: DataFrame) -> DataFrame:
    """``page_id, record``: the bytes of each record as a WARC file has them; revisits end after the HTTP header."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return archive.select("page_id", F.concat(F.col("warc_header").cast("binary"), F.col("http_header").cast("binary"), body, F.lit(EOL + EOL).cast("binary")).alias("record"))
