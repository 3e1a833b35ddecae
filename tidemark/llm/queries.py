"""The queries over the given tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import centroids, decontaminate, language, line_dedup, merkle, near_vectors, ngram_join, packing, secrets, shards, token_files, toxicity, warc
from tidemark.llm.common import read_table
from tidemark.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.kept_lines(documents)
    return kept.select("doc_id", F.col("_lines.n_lines"), F.col("_lines.n_dropped"), F.sha2(F.col("_lines.text"), 256).alias("kept_sha256"))


LINES = r"""
lines AS (
    SELECT doc_id, text, u.pos, u.line,
        translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, text, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'line': x, 'pos': i})) AS u FROM documents)
),
repeated AS (SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last_doc IS NOT NULL AND doc_id < last_doc) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last_doc IS NULL OR doc_id >= last_doc), '') AS kept
    FROM lines LEFT JOIN repeated USING (key) GROUP BY doc_id
)
"""
ORACLE["op10_line_dedup"] = f"WITH {LINES} SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept"


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.span_counts(secrets.find_secrets(read_table(spark, folder, "documents")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    archive = new_folder(spark, "warc")
    warc.write_archive(pages, archive)
    read = warc.read_archive(spark, archive)
    return read.select("page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN n >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM k
"""


@query
def op5_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.shard_documents(read_table(spark, folder, "documents"), shards=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = new_folder(spark, "token-files")
    token_files.write_token_files(read_table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(spark, files, with_ids=False)


@query
def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    pieces = packing.encode_pieces(documents, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.pack_pieces(pieces)


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    field = toxicity.train(toxicity.train_rows(spark, documents, labels))
    scores = toxicity.score_documents(documents, field)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "spans")


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(spark, read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query
def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_components(read_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.link_vectors(read_table(spark, folder, "embeddings"))


ORACLE["op4_ngram_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
ends AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, ends.b FROM reach JOIN ends ON reach.r = ends.a)
SELECT d AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d
"""


@query
def op11_subvector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster_vectors(read_table(spark, folder, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    digest = F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1) if digests else F.lit(None).cast("string")
    return centroids.with_inertia(found).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _cluster_sql(k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, seed: int = 1) -> str:
    parts = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS n FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}
                AND list_max(list_transform(list_filter(embedding, lambda x: isfinite(x)), lambda x: abs(floor({scale} * CAST(x AS DOUBLE))))) <= 134217728)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, n) - 1 AS c, n AS m FROM (SELECT sha256('{seed}:' || vec_id) AS h, n FROM v WHERE vec_id IS NOT NULL ORDER BY h, n LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        near = f"""SELECT r, c, list_sum(list_transform(list_zip(n, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v CROSS JOIN c{i}"""
        parts.append(f"a{i} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM ({near}) GROUP BY r)")
        if i < rounds:
            cell = f"SELECT c, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS k FROM (SELECT c, unnest(n) AS x, generate_subscripts(n, 1) AS pos FROM v JOIN a{i} USING (r)) GROUP BY c, pos"
            # Division of whole numbers cuts towards zero; taking the rest off first makes it a floor.
            parts.append(f"u{i} AS (SELECT c, list(((s - ((s % k) + k) % k) // k)::BIGINT ORDER BY pos) AS m FROM ({cell}) GROUP BY c)")
            parts.append(f"c{i + 1} AS (SELECT c, coalesce(u{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN u{i} USING (c))")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
            sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM v JOIN a{rounds} USING (r) JOIN c{rounds} USING (c)"""


ORACLE["op11_subvector_clusters"] = _cluster_sql()


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.check_documents(read_table(spark, folder, "documents"))


def _merkle_sql(levels: int = 4, arity: int = 16) -> str:
    """Trees of up to ``arity ** levels`` leaves a source, and as many sources; the levels have to be written out."""
    field = "coalesce(strlen({0}) || ':' || {0}, '-')"
    fields = " || ".join(field.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars"))
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 by its table-free form: eight steps for each byte of the id's digits.
    step = "lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {digits}, {step}), 4294967295)"
    parts = [
        f"""l AS (SELECT doc_id, coalesce({crc} % 5 = 0 AND text IS NOT NULL, false) AS hit, sha256({fields} || {field.format("text")}) AS leaf,
            sha256({fields} || {field.format(small)}) AS small, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, source FROM documents)""",
        "n0 AS (SELECT row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS r, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, * EXCLUDE (g) FROM l)",
        "s0 AS (SELECT g, i, leaf AS h FROM n0)",
    ]

    def up(name: str) -> None:
        for at in range(levels):
            # A run of the level, and whether another level stands on it.
            parts.append(f"{name}r{at} AS (SELECT g, i // {arity} AS run, string_agg(h, '' ORDER BY i) AS t FROM {name}{at} WHERE g IN (SELECT g FROM {name}{at} GROUP BY g HAVING count(*) > 1) GROUP BY g, run)")
            parts.append(f"{name}{at + 1} AS (SELECT g, run AS i, sha256(t) AS h FROM {name}r{at})")
        tops = " UNION ALL ".join(f"SELECT g, any_value(h) AS h FROM {name}{at} GROUP BY g HAVING count(*) = 1" for at in range(levels + 1))
        parts.append(f"{name}top AS ({tops})")

    def fold(before: str, name: str, g: str, i: str) -> str:
        for at in range(levels):
            place = f"({i} // {arity**at}) % {arity}"
            left, right = f"substr(t, 1, (64 * ({place}))::BIGINT)", f"substr(t, (64 * ({place} + 1) + 1)::BIGINT)"
            parts.append(
                f"{name}f{at} AS (SELECT x.* REPLACE (CASE WHEN t IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur, CASE WHEN t IS NULL THEN sib ELSE sib || {left} || {right} END AS sib) "
                f"FROM {before} x LEFT JOIN {name}r{at} y ON y.g = {g} AND y.run = {i} // {arity ** (at + 1)})"
            )
            before = f"{name}f{at}"
        return before

    up("s")
    parts.append("t0 AS (SELECT 0 AS g, g AS i, h FROM stop)")
    up("t")
    parts.append("start AS (SELECT r, doc_id, leaf, g AS sg, i AS si, CASE WHEN hit THEN small ELSE leaf END AS cur, '' AS sib FROM n0)")
    mid = fold("start", "s", "x.sg", "x.si")
    last = fold(mid, "t", "0", "x.sg")
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, stop.h AS subroot, ttop.h AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = ttop.h AS verified
        FROM {last} JOIN stop ON stop.g = sg CROSS JOIN ttop"""


ORACLE["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    held_out = language.held_out(F.col("doc_id"))
    # A null id is in no part, and is learned from.
    model = language.learn(documents.where(~F.coalesce(held_out, F.lit(False))))
    found = language.predict(documents, model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
