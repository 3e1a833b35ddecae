import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import ranges


def brute(ids):
    runs = []
    for i in sorted(set(ids)):
        if runs and runs[-1][1] == i - 1:
            runs[-1] = (runs[-1][0], i)
        else:
            runs.append((i, i))
    return runs


def islands(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    return sorted(tuple(r) for r in ranges.id_islands(df, "id").collect())


def test_edges_of_blocks_at_every_level(spark):
    ids = []
    for middle in (0, 1 << 16, 1 << 17, 1 << 32, 3 << 32, 1 << 48, -(1 << 16), -(1 << 48)):
        ids += [middle + d for d in range(-3, 3)]
    ids += [-(1 << 63), -(1 << 63) + 1, (1 << 63) - 1, (1 << 63) - 2, None]
    assert islands(spark, ids) == brute([i for i in ids if i is not None])


def test_run_across_many_blocks(spark):
    df = spark.range(65530, 65536 * 4 + 10)
    assert [tuple(r) for r in ranges.id_islands(df, "id").collect()] == [(65530, 65536 * 4 + 9)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-200_000, 200_000).map(lambda i: i // 7 * 3 if i % 2 else i % 900), min_size=1, max_size=400))
def test_any_ids(spark, ids):
    assert islands(spark, ids) == brute(ids)


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_chunks_cover_every_id_once(spark, width):
    rng = random.Random(width)
    ids = {rng.randint(0, 3000) for _ in range(1500)}
    found = ranges.id_range_chunks(ranges.id_islands(spark.createDataFrame([(i,) for i in ids], "id bigint"), "id"), width)
    covered = [i for r in found.collect() for i in range(r.start, r.end + 1)]
    assert sorted(covered) == sorted(ids)
    assert all(r.end - r.start < width for r in found.collect())


def test_chunks_of_a_very_long_run(spark):
    run = spark.createDataFrame([(0, 25_000_000)], "start bigint, end bigint")
    chunks = ranges.id_range_chunks(run, 1000, "Id")
    assert chunks.count() == 25_001
    assert chunks.filter("start = 25000000").first().predicate == "Id >= 25000000 AND Id <= 25000000"
    assert chunks.filter("start = 1000").first().end == 1999


def test_no_row_level_single_partition(spark, small):
    plan = ranges.id_islands(spark.read.parquet(f"{small}/lineitem.parquet"), "l_orderkey")
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
