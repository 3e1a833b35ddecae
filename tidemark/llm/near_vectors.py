"""Near duplicates among embeddings by collision counting on one-dimensional projections.

Vectors are normalised and projected on ``projections`` random unit directions; each projection is sorted within a label. A vector
collides with another on a projection if that lies in the window of half width w centred at it. For a pair at the cosine limit the difference
of two projections has a known distribution (its share of the squared distance is Beta(1/2, (dim - 1)/2)), which gives the probability p of a collision; the least
count that a pair must reach is the largest one that a Binomial(projections, p) reaches with probability ``recall``. Pairs at or above it are
verified by their cosine in double precision; only verified pairs link.

Work is dealt out in blocks: per label, vectors are cut into runs of the first sorted projection of about ``block`` vectors, which other runs
meet if the windows of their first projection overlap at a width that loses less than one pair in a million. A task holds two runs at a time, sorts the
remaining projections of one, and finds windows of the other by binary search. Equal vectors of a label are one class before that, told by a
128-bit digest. A task adds up what each class links to, and names one class for each of its groups: a row a class, never a row a pair.

Nulls and repeats: labels that are null, and vectors that are null, empty, zero or hold a null or non-finite component, link with nothing;
vectors of other lengths are other groups; rows that share a vec_id are different vectors with one node, whose links are added up, and a null vec_id has no links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components
from tidemark.session import materialize

COSINE = 0.98
PROJECTIONS, RECALL, WIDTH, BLOCK = 24, 0.995, 1.5, 1500


def directions(dim: int, projections: int) -> np.ndarray:
    """Random unit vectors; the same for the same sizes."""
    drawn = np.random.default_rng(dim * 1009 + projections).standard_normal((projections, dim))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def share_within(width: float, distance: float, dim: int) -> float:
    """Probability that a vector of this length projects on a random direction to at most ``width``."""
    if dim < 2 or width >= distance:
        return float(width >= distance)
    # The density of the projection's share x in [-1, 1] is (1 - x^2)^((dim - 3) / 2); its angle has cos^(dim - 2).
    angles = np.linspace(0, math.pi / 2, 20_001)
    density = np.cos(angles) ** (dim - 2)
    part = angles <= math.asin(width / distance)
    return float(density[part].sum() / density.sum())


def least_count(projections: int, p: float, recall: float) -> int:
    """The largest count that a Binomial(projections, p) reaches with probability ``recall`` at least."""
    tail = 0.0
    for count in range(projections, 0, -1):
        tail += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 1


def plan(dim: int, cosine: float = COSINE, projections: int = PROJECTIONS, recall: float = RECALL, width: float = WIDTH) -> tuple[float, int, float]:
    """Half width of a window, least count, and the width at which runs meet."""
    distance = math.sqrt(max(0.0, 2 - 2 * cosine))
    w = min(distance, width * distance / math.sqrt(dim)) + 1e-9
    low, high = w, distance
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if share_within(middle, distance, dim) >= 1 - 1e-6 else (middle, high)
    return w, least_count(projections, min(1.0, share_within(w, distance, dim)), recall), high + 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v`` (doubles) of the rows that can link, and ``d1, d2``, a digest of ``v``."""
    v = F.col("embedding").cast("array<double>")
    own = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", v.alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = own.where(fine & F.exists("v", lambda x: x != 0))
    return kept.select("*", *[F.xxhash64(F.lit(i), "v").alias(f"d{i}") for i in (1, 2)])


def classes(rows: DataFrame) -> DataFrame:
    """``head, label, dim, v, members, d1, d2``: one row per distinct vector of a label, the smallest of its ids as head."""
    met = rows.groupBy("label", "d1", "d2").agg(F.min("vec_id").alias("head"), F.first("v").alias("v"), F.count("*").alias("members"))
    return met.select("head", "label", F.size("v").alias("dim"), "v", "members", "d1", "d2")


def _unit(column: pa.Array) -> np.ndarray:
    x = np.array(column.to_pylist(), float)
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def first_projection(heads: DataFrame) -> DataFrame:
    """``heads`` with ``p``: each vector's value on the first direction."""
    projections = PROJECTIONS

    def run(batches):
        for batch in batches:
            values = np.zeros(batch.num_rows)
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                values[at] = _unit(batch.column(3).take(pa.array(at))) @ directions(int(dim), projections)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, "p"])

    return heads.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in heads.schema), "p double"]))


def collisions(x: np.ndarray, y: np.ndarray, w: float, least: int, same: bool, span: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of two projected runs that collide on at least ``least`` projections; i < j in one run."""
    rows, cols = [], []
    orders = np.argsort(y, axis=0, kind="stable")
    sorted_ = np.take_along_axis(y, orders, 0)
    for low in range(0, len(x), span):
        part = x[low : low + span]
        counts = np.zeros((len(part), len(y)), np.uint8)
        for k in range(x.shape[1]):
            # The window centred at each query is a run of the sorted projection.
            start = np.searchsorted(sorted_[:, k], part[:, k] - w, "left")
            many = np.searchsorted(sorted_[:, k], part[:, k] + w, "right") - start
            spot = np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())
            counts[np.repeat(np.arange(len(part)), many), orders[spot, k]] += 1
        i, j = np.nonzero(counts >= least)
        keep = (i + low < j) if same else slice(None)
        rows.append(i[keep] + low)
        cols.append(j[keep])
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, int), np.zeros(0, int))


def near_classes(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors, numbered as ``cls``, and what links them.

    The second frame has ``a, b, others`` for each class with links in a block: ``b`` is the first class of its group
    there (a spanning forest of the block), ``others`` the number of vectors that it links to there.
    """
    spark = vectors.sparkSession
    # Written once, so that numbers stay the same.
    made = materialize(classes(usable(vectors)).withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    heads = materialize(first_projection(made), "vectors")
    sizes = heads.groupBy("dim").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return heads, spark.createDataFrame([], "a bigint, b bigint, others bigint")
    plans = {r["dim"]: plan(r["dim"], cosine, PROJECTIONS, recall) for r in sizes}
    # Runs: ranks of the first projection in a label, from a range shuffle and sums per task.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = heads.repartitionByRange(parts, "label", "dim", "p", "cls").sortWithinPartitions("label", "dim", "p", "cls")
    placed = materialize(ranged.withColumn("part", F.spark_partition_id()).withColumn("spot", F.monotonically_increasing_id()), "vector-order")
    firsts = placed.groupBy("label", "dim", "part").agg(F.min("spot").alias("first"))
    run_of = F.floor((F.col("spot") - F.col("first")) / block).cast("int")
    # A run never spans two tasks' ranges; it is named by range and number.
    runs = placed.join(firsts, ["label", "dim", "part"]).withColumn("run", F.concat_ws("-", F.col("part").cast("string"), run_of.cast("string")))
    runs = materialize(runs.select("cls", "members", "label", "dim", "v", "p", "run"), "vector-runs")
    bounds = runs.groupBy("label", "dim", "run").agg(F.min("p").alias("low"), F.max("p").alias("high"))
    reach = F.coalesce(*[F.when(F.col("dim") == d, F.lit(p[2])) for d, p in plans.items()])
    other = bounds.select("label", "dim", F.col("run").alias("run2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    meets = bounds.withColumn("reach", reach).join(other, ["label", "dim"]).where("run <= run2 AND low2 <= high + reach AND low <= high2 + reach")
    meets = meets.select("label", "dim", "run", "run2", F.xxhash64("label", "dim", "run", "run2").alias("pair"))
    sides = meets.select("label", "dim", F.col("run"), "run2", "pair", F.lit(0).alias("side")).unionByName(
        meets.where("run <> run2").select("label", "dim", F.col("run2").alias("run"), F.col("run").alias("run2"), "pair", F.lit(1).alias("side"))
    )
    dealt = runs.join(sides.drop("run2"), ["label", "dim", "run"]).select("pair", "side", "dim", "label", "cls", "members", "v")

    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        w, least, _ = plans[dim]
        side, cls, members = (table.column(c).to_numpy() for c in ("side", "cls", "members"))
        unit = _unit(table.column("v"))
        seen = unit @ directions(dim, PROJECTIONS).T
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(two)
        i, j = collisions(seen[one], seen[one if same else two], w, least, same)
        a, b = one[i], (one if same else two)[j]
        keep = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
        a, b = a[keep], b[keep]
        others = np.bincount(a, members[b], len(cls)) + np.bincount(b, members[a], len(cls))
        first = forest(a, b, len(cls))
        linked = np.flatnonzero(others)
        return pa.table({"a": pa.array(cls[linked]), "b": pa.array(cls[first[linked]]), "others": pa.array(others[linked].astype(np.int64))})

    links = dealt.groupBy("pair").applyInArrow(run, "a bigint, b bigint, others bigint")
    return heads, links


def forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The least member of each of ``count`` items' group under the links (a, b)."""
    first = np.arange(count)
    while True:
        least = np.minimum(first[a], first[b])
        after = first.copy()
        np.minimum.at(after, first[a], least)
        np.minimum.at(after, first[b], least)
        after = after[after]
        if np.array_equal(after, first):
            return first
        first = after


def link_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``: links to other vectors, copies included."""
    heads, links = near_classes(vectors, cosine, recall)
    links = materialize(links, "vector-links")
    known = heads.select("cls", "head", "label", "d1", "d2", "members")
    counts = links.groupBy(F.col("a").alias("cls")).agg(F.sum("others").alias("others"))
    member = usable(vectors).select("vec_id", "label", "d1", "d2").join(known.drop("head", "members"), ["label", "d1", "d2"]).select("vec_id", "cls")
    member = materialize(member, "vector-members")
    # Vectors that share an id are one node, so their classes are one component.
    shared = member.groupBy("vec_id").agg(F.min("cls").alias("b"), F.max("cls").alias("top")).where("b < top").select("vec_id", "b")
    bridges = member.join(shared, "vec_id").select(F.col("cls").alias("a"), "b")
    comps = materialize(components(links.select("a", "b").unionByName(bridges)), "vector-components")
    named = known.join(comps.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("head").alias("component_id"))
    of_class = named.join(least, "component").join(counts, "cls", "left").select("cls", (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n"), "component_id")
    placed = member.join(of_class, "cls").groupBy("vec_id").agg(F.sum("n").alias("n_links"), F.min("component_id").alias("component_id"))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    out = every.join(placed, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def keep_one(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vectors`` with one of each component."""
    gone = link_vectors(vectors, cosine).where(~F.col("kept")).select("vec_id").distinct()
    return vectors.join(gone, "vec_id", "left_anti")
