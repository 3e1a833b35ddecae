import hashlib
import math
import zlib

import numpy as np
import pytest

from tidemark.llm import near_vectors, shards, warc
from tidemark.llm.common import components, reduce_by_ids, with_positions


def brute(rows, cosine=0.98):
    good = [(i, label, np.array(v, float)) for i, label, v in rows if i is not None and label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links, parent = dict.fromkeys((r[0] for r in rows), 0), {r[0]: r[0] for r in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(good)):
        for b in range(a):
            (i, x, u), (j, y, v) = good[a], good[b]
            if x == y and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                if p != q:
                    parent[max(p, q)] = min(p, q)
    return {i: (links[i], find(i) if i is not None else None) for i in links}


def vectors(seed, count, dim, noise):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, count // 6), dim))
    rows = []
    for k in range(count):
        v = centres[k % len(centres)] + noise * rng.standard_normal(dim)
        rows.append((k, int(k % 3), [float(x) for x in np.float32(v)]))
    return rows


def test_links_recall(spark):
    rows = vectors(5, 600, 64, 0.1)
    for k in range(20):
        rows.append((1000 + k, 1, rows[1][2]))
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.link_vectors(df).collect()}
    want = brute(rows)
    total, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert total > 1000 and all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.98 * total


def test_links_of_repeated_ids(spark):
    a, b, near = [1.0, 0.0], [0.0, 1.0], [1.0, 0.01]
    cases = [
        [(1, 0, a), (1, 0, b), (2, 0, near)],
        [(1, 0, a), (1, 0, b), (2, 0, near), (3, 0, [0.01, 1.0]), (4, 0, [-1.0, 0.0]), (4, 1, a), (5, 1, near), (5, 1, near), (6, 1, a)],
        [(7, 0, a), (7, 0, a), (7, 1, a), (8, 1, a), (8, 2, b), (9, 2, b)],
    ]
    for rows in cases:
        df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
        got = near_vectors.link_vectors(df).collect()
        assert len(got) == len(rows)
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 0, None), (6, 0, [0.0, 0.0]), (7, 0, [1.0, None]),
        (8, 0, [float("nan"), 1.0]), (9, 0, [float("inf"), 1.0]), (10, 0, []), (11, 0, [1.0, 0.0, 0.0]), (None, 0, [1.0, 0.0]), (12, 0, [1.0, 0.0]), (13, 0, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, label int, embedding array<double>, component_id string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.link_vectors(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[12] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 13)) and got[None][0] == 0
    assert near_vectors.keep_one(df).count() == len(rows) - 2
    assert near_vectors.link_vectors(df.limit(0)).count() == 0


def test_least_count_has_the_recall_it_says():
    w, least, _ = near_vectors.plan(64)
    rng = np.random.default_rng(0)
    d = rng.standard_normal((4000, 64))
    d *= math.sqrt(0.04) / np.linalg.norm(d, axis=1, keepdims=True)
    hits = (np.abs(d @ near_vectors.directions(64, near_vectors.PROJECTIONS).T) <= w).sum(1)
    assert (hits >= least).mean() >= 0.98


PAGES = [(1, "http://a", "x" * 2000), (2, None, "x" * 2000), (3, "http://c\r\nd", "x" * 2000), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", "x" * 2000), (8, "é", "ü" * 600), (3, "http://c\r\nd", "x" * 2000)]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id bigint, url string, html string, payload string")
    folder = f"file://{tmp_path}/archive"
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    read = warc.read_archive(spark, folder)
    rows = read.collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        html = next((p[2] or "") for p in PAGES if p[0] == r.page_id).encode()
        assert bytes(r.payload) == html and r.payload_digest == hashlib.sha1(html).hexdigest()
        revisit = len(html) >= 1000 and r.page_id != {2000: 3, 1200: 8}[len(html)]
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
        assert f"\nWARC-Payload-Digest: sha1:{r.payload_digest}\r\n" in r.warc_header and r.warc_header.endswith("\r\n\r\n")
    for r in warc.record_bytes(read).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert block[length:] == b"\r\n\r\n"
    # A changed payload is noticed.
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}2/records")
    spark.read.parquet(f"{folder}/payloads").selectExpr("address", "concat(payload, X'00') AS payload").write.parquet(f"{folder}2/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, f"{folder}2").collect()
    warc.write_archive(pages.limit(0), f"{folder}3")
    assert warc.read_archive(spark, f"{folder}3").count() == 0


def test_shards(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = shards.shard_documents(docs, 16).collect()
    sizes, slots = {}, {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(sizes) == list(range(16)) and len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # A split is off by one document at most, at each of four levels.
    assert max(sizes.values()) - min(sizes.values()) <= 4 * max(r.size for r in rows)
    leaves = shards.shard_documents(docs, target_bytes=sum(sizes.values()) // 3)
    assert leaves.select("shard").distinct().count() == 4


def test_shards_of_odd_rows(spark, tmp_path):
    rows = [(None, None, None, "a"), (1, None, "en", None), (1, "same", "en", "a"), (1, "same", "en", "a"), (2, "", "de", "b")] + [(9, "hot" * 3, "en", "hot")] * 20
    docs = spark.createDataFrame([(*r, "node") for r in rows], "doc_id bigint, text string, lang string, source string, node string")
    got = shards.shard_documents(docs, 4).collect()
    assert len(got) == len(rows) and {r.size for r in got if r.doc_id is None} == {1}
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert shards.shard_documents(docs.limit(0), 4).count() == 0


def test_components_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(500, 560)] + [(900, k) for k in range(901, 960)]
    parent = {n: n for p in pairs for n in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_positions_and_id_filter(spark):
    rows = [(k % 3, k, k % 5) for k in range(100)]
    df = spark.createDataFrame(rows, "g int, o int, n int")
    got = {(r.g, r.o): r.start for r in with_positions(df, ["g"], ["o"], 5, "n", "start").collect()}
    for g in range(3):
        total = 0
        for _, o, n in sorted(r for r in rows if r[0] == g):
            assert got[(g, o)] == total
            total += n
    ids = spark.createDataFrame([(k,) for k in range(0, 1000, 7)], "i bigint")
    kept = {r.id for r in reduce_by_ids(spark.range(1000), "id", ids, "i").collect()}
    assert set(range(0, 1000, 7)) <= kept and len(kept) < 200
