"""Merkle manifest of a table: digests of rows, runs of 16 under one node, a subtree for each group and a root over all groups.

A leaf is the SHA-256 of a row's fields, each as its byte count, ``:`` and value, ``-`` if null. Of a group's nodes every ``arity`` consecutive ones (the last run may be
shorter) are hashed together, level by level, until one remains. The groups' roots, in the order of the groups, are hashed likewise.

Layout. A tree is stored in aligned blocks of ``height`` levels of edges, ``arity ** height`` leaves at most, one row a block. Within a block the nodes lie in van Emde Boas
order: the tree is split at half its height, the upper subtree comes first and the lower ones follow from left to right, each laid out by the same
rule. ``address`` computes a node's place from the number of leaves alone; lower subtrees are full but for the last, so blocks that are not full have no
holes. The tree is built through these addresses, and a leaf's siblings are read through them: a run of siblings and their parents lie close
together whatever the size of a cache line or page. The roots of blocks are the leaves of the next tier's blocks, until a group has one block.

At scale: texts are hashed where they are read, and only digests move. Leaves get their place in a group by ranges and counts, never by one task per
group, so one group may hold any share of the rows. A task holds one block. Siblings above a block are found once for the block, from the
top tier down, and join it there; no path is stored for a row.

Nulls and ties: a null group is a group of its own, the first. Rows go by their key, nulls first, then by leaf; rows alike in both are leaves like any other. An empty table
has no rows and no root. A group of one row has that leaf as its subroot, a table of one group that subroot as its root, and a proof without siblings is the digest of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare
from tidemark.session import materialize

ARITY, HEIGHT = 16, 3
BYTES = 32


# -- the layout of one block ---------------------------------------------------


def node_count(leaves: int, height: int, arity: int = ARITY) -> int:
    """Nodes of a tree of this many leaves and levels of edges."""
    return sum(-(-leaves // arity**level) for level in range(height + 1))


def address(leaves: int, height: int, level: int, index: np.ndarray, arity: int = ARITY) -> np.ndarray:
    """Places of the nodes ``index`` of a level (0: leaves) in van Emde Boas order."""
    if height == 0:
        return np.zeros(len(index), np.int64)
    low = (height - 1) // 2
    span = arity ** (low + 1)
    tops = -(-leaves // span)
    if level > low:
        return address(tops, height - low - 1, level - low - 1, index, arity)
    # Each node above the split stands on `arity` lower subtrees, all of them full but the last.
    full = arity**low
    own = full // arity**level
    at = index // own
    lowers = -(-leaves // full)
    inner = index - at * own
    out = node_count(tops, height - low - 1, arity) + at * node_count(full, low, arity)
    last = at == lowers - 1
    out[~last] += address(full, low, level, inner[~last], arity)
    out[last] += address(leaves - (lowers - 1) * full, low, level, inner[last], arity)
    return out


class Block:
    """The nodes of one block in their layout; built from leaves, or read back."""

    def __init__(self, leaves: int, height: int, nodes: bytes | None = None, arity: int = ARITY):
        self.leaves, self.height, self.arity = leaves, height, arity
        size = node_count(leaves, height, arity)
        self.nodes = np.zeros((size, BYTES), np.uint8) if nodes is None else np.frombuffer(nodes, np.uint8).reshape(size, BYTES)

    def width(self, level: int) -> int:
        return -(-self.leaves // self.arity**level)

    def put(self, level: int, digests: bytes) -> None:
        at = address(self.leaves, self.height, level, np.arange(self.width(level)), self.arity)
        self.nodes[at] = np.frombuffer(digests, np.uint8).reshape(-1, BYTES)

    def run(self, level: int, run: int) -> list[str]:
        """Digests of one run of a level as text, from left to right."""
        low = run * self.arity
        at = address(self.leaves, self.height, level, np.arange(low, min(low + self.arity, self.width(level))), self.arity)
        text = self.nodes[at].tobytes().hex()
        return [text[i : i + 2 * BYTES] for i in range(0, len(text), 2 * BYTES)]

    def build(self, digests: bytes) -> Block:
        self.put(0, digests)
        for level in range(self.height):
            self.put(level + 1, b"".join(hashlib.sha256("".join(self.run(level, r)).encode()).digest() for r in range(self.width(level + 1))))
        return self

    @property
    def root(self) -> bytes:
        return self.nodes[address(self.leaves, self.height, self.height, np.zeros(1, np.int64), self.arity)].tobytes()

    def siblings(self, index: int) -> list[tuple[str, str]]:
        """What stands left and right of a leaf and of each node above it, below the block's root."""
        out = []
        for level in range(self.height):
            own, at = self.run(level, index // self.arity), index % self.arity
            out.append(("".join(own[:at]), "".join(own[at + 1 :])))
            index //= self.arity
        return out


def fold(leaf: str, siblings: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in siblings:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def proof_digest(siblings: list[tuple[str, str]]) -> str:
    return hashlib.sha256("".join(left + right for left, right in siblings).encode()).hexdigest()


def height_of(leaves: int, most: int, arity: int = ARITY) -> int:
    """Levels until one node remains, ``most`` at most."""
    height = 0
    while leaves > 1 and height < most:
        leaves, height = -(-leaves // arity), height + 1
    return height


# -- leaves and their places -----------------------------------------------------


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 over fields, each as byte count, ``:`` and value, or ``-`` for a null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def placed(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """Rows with ``index``, their place from 0 in their group, and ``leaves``, the size of the group.

    Rows are dealt out by ranges of group and order and written; the places in a written part follow from row numbers of that
    part, and parts of one group are counted up. At most one row a part and group is joined back.
    """
    grouped = rows if group is not None else rows.withColumn("_all", F.lit(0))
    group = group or "_all"
    down = [F.col(c).asc_nulls_first() for c in [group, *order]]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grouped.repartitionByRange(parts, *down).sortWithinPartitions(*down).withColumn("_id", F.monotonically_increasing_id())
    dealt = materialize(dealt, "merkle-leaves").withColumn("_part", F.shiftright("_id", 33))
    counts = dealt.groupBy(group, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(group)).alias("leaves"),
    )
    joined = dealt.join(counts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*rows.columns, (F.col("_before") + F.col("_id") - F.col("_first")).alias("index"), "leaves")


# -- trees over groups -------------------------------------------------------------


@dataclass
class Forest:
    """Tiers of blocks of all groups, the lowest first, and each group's root as ``grp, root``."""

    tiers: list[DataFrame]
    roots: DataFrame


_BLOCK = "grp {kind}, block bigint, total bigint, leaves int, height int, nodes binary, root binary{held}"


def blocks_of(leaves: DataFrame, held: list[str] | None = None, height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """One row a block from ``grp, index, leaves, digest``; columns in ``held`` go with it as arrays in the order of leaves."""
    kinds, held = dict(leaves.dtypes), held or []
    span = arity**height

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("index")
        count, total = table.num_rows, table.column("leaves")[0].as_py()
        # A block that is alone ends where one node is left; all others go up to the next tier.
        own = height_of(count, height, arity) if total <= span else height
        block = Block(count, own, arity=arity).build(b"".join(table.column("digest").to_pylist()))
        columns = {
            "grp": table.column("grp").slice(0, 1), "block": table.column("block").slice(0, 1), "total": pa.array([total], pa.int64()),
            "leaves": pa.array([count], pa.int32()), "height": pa.array([own], pa.int32()),
            "nodes": pa.array([block.nodes.tobytes()], pa.binary()), "root": pa.array([block.root], pa.binary()),
        }
        for name in held:
            values = table.column(name).combine_chunks()
            columns[name] = pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), values)
        return pa.table(columns)

    schema = _BLOCK.format(kind=kinds["grp"], held="".join(f", `{n}` array<{kinds[n]}>" for n in held))
    own = leaves.select("grp", F.expr(f"index div {span}").alias("block"), "index", "leaves", "digest", *held)
    return own.groupBy("grp", "block").applyInArrow(run, schema)


def build_forest(leaves: DataFrame, held: list[str] | None = None, height: int = HEIGHT, arity: int = ARITY) -> Forest:
    """All tiers over ``grp, index, leaves, digest`` (binary); the loop runs once for each ``height`` levels."""
    tiers = [materialize(blocks_of(leaves, held, height, arity), "merkle-blocks")]
    ready = tiers[0].where(F.col("total") <= arity**height).select("grp", "root")
    while True:
        # Roots of the blocks of groups that have several.
        open_ = tiers[-1].where(F.col("total") > arity**height)
        if open_.isEmpty():
            return Forest(tiers, ready)
        up = open_.select("grp", F.col("block").alias("index"), F.expr(f"(total + {arity**height - 1}) div {arity**height}").alias("leaves"), F.col("root").alias("digest"))
        tiers.append(materialize(blocks_of(up, None, height, arity), "merkle-blocks"))
        ready = ready.unionByName(tiers[-1].where(F.col("total") <= arity**height).select("grp", "root"))


_PATH = "array<struct<`left`:string,`right`:string>>"


def child_paths(blocks: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """``grp, block, path`` of every leaf of ``blocks`` (with a column ``path``): siblings from the leaf up to the top of all."""
    kind = dict(blocks.dtypes)["grp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row["leaves"], row["height"], row["nodes"], arity)
                above = [(s["left"], s["right"]) for s in row["path"]]
                for low in range(0, own.leaves, arity):
                    index = range(low, min(low + arity, own.leaves))
                    paths = [[{"left": a, "right": b} for a, b in own.siblings(i) + above] for i in index]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["grp"]] * len(index), batch.schema.field("grp").type), pa.array([row["block"] * arity**height + i for i in index], pa.int64()),
                         pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))],
                        ["grp", "block", "path"],
                    )

    return blocks.select("grp", "block", "leaves", "height", "nodes", "path").mapInArrow(run, f"grp {kind}, block bigint, path {_PATH}")


def with_paths(forest: Forest, tops: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """The lowest tier's blocks with ``path``, the siblings above each block; ``tops(grp, path)`` holds those above each group."""

    def join(blocks: DataFrame, paths: DataFrame) -> DataFrame:
        named = paths.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path")
        return blocks.join(named, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))).drop("_grp", "_block")

    paths = None
    for at in range(len(forest.tiers) - 1, -1, -1):
        blocks = forest.tiers[at]
        alone = blocks.where(F.col("total") <= arity**height)
        named = tops.select(F.col("grp").alias("_grp"), "path")
        ready = alone.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
        full = ready if paths is None else ready.unionByName(join(blocks.where(F.col("total") > arity**height), paths))
        if at == 0:
            return full
        paths = materialize(child_paths(full, arity, height), "merkle-paths")
    raise AssertionError("a forest has a tier")


# -- a table ---------------------------------------------------------------------------


@dataclass
class Manifest:
    """Blocks of all groups with the rows of their leaves, the top tree's blocks, and the root as text (None for an empty table)."""

    groups: Forest
    top: Forest
    root: str | None
    group_paths: DataFrame


def build_manifest(rows: DataFrame, key: str, group: str, leaf: str, held: list[str], height: int = HEIGHT, arity: int = ARITY) -> Manifest:
    """A manifest of ``rows``, whose column ``leaf`` has their digests as hexadecimal text."""
    spark = prepare(rows.sparkSession)
    own = rows.select(F.col(group).alias("grp"), F.col(key).alias("key"), F.unhex(leaf).alias("digest"), *[F.col(h).alias(f"held_{i}") for i, h in enumerate(held)])
    # Ranges are found by a look at the rows before they are dealt out; texts are to be hashed once.
    own = materialize(own, "merkle-digests")
    leaves = placed(own, "grp", ["key", "digest"])
    names = ["key", *[f"held_{i}" for i in range(len(held))]]
    groups = build_forest(leaves, names, height, arity)
    kind = dict(rows.dtypes)[group]
    tops = placed(groups.roots.select(F.col("grp").alias("name"), F.col("root").alias("digest")), None, ["name"])
    tops = tops.withColumn("grp", F.lit(0))
    top = build_forest(tops, ["name"], height, arity)
    found = top.roots.first()
    # Siblings of each group's root, from the top tree, of which the one group has none above it.
    nothing = spark.range(1).select(F.lit(0).alias("grp"), F.array().cast(_PATH).alias("path"))
    lowest = with_paths(top, nothing, arity, height)
    names_of = lowest.select(F.posexplode("name").alias("i", "name"), F.col("block").alias("b")).select((F.col("b") * arity**height + F.col("i")).alias("index"), F.col("name").cast(kind).alias("grp"))
    paths = child_paths(lowest, arity, height).select(F.col("block").alias("index"), "path")
    joined = materialize(names_of.join(paths, "index").select("grp", "path"), "merkle-group-paths")
    return Manifest(groups, top, None if found is None else bytes(found["root"]).hex(), joined)


def verify_rows(manifest: Manifest, key: str, key_kind: str, current: int = 0, height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """Every row's proof against the manifest: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``held_<current>`` has the leaf as it is found now, as hexadecimal text; null means unchanged.
    """
    roots = manifest.groups.roots.select(F.col("grp").alias("_g"), F.col("root").alias("subroot"))
    blocks = with_paths(manifest.groups, manifest.group_paths, arity, height)
    blocks = blocks.join(roots, F.col("grp").eqNullSafe(F.col("_g"))).select("leaves", "height", "nodes", "path", "subroot", "key", F.col(f"held_{current}").alias("now"))
    root = manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _verified(batch.slice(at, 1))

    def _verified(batch: pa.RecordBatch) -> pa.RecordBatch:
        row = {n: batch.column(n)[0] for n in ("leaves", "height", "nodes", "path", "subroot", "now")}
        own = Block(row["leaves"].as_py(), row["height"].as_py(), row["nodes"].as_py(), arity)
        above = [(s["left"], s["right"]) for s in row["path"].as_py()]
        above_text = "".join(left + right for left, right in above).encode()
        now, levels, runs = row["now"].as_py(), own.height, {}
        leaf, proof, folded = [], [], []
        for i in range(own.leaves):
            # Neighbours share their runs, so each is read once.
            digest, path, index = hashlib.sha256(), [], i
            for level in range(levels):
                run_ = (level, index // arity)
                if run_ not in runs:
                    runs[run_] = "".join(own.run(*run_))
                text, place = runs[run_], 2 * BYTES * (index % arity)
                path.append((text[:place], text[place + 2 * BYTES :]))
                digest.update((path[-1][0] + path[-1][1]).encode())
                if level == 0:
                    leaf.append(text[place : place + 2 * BYTES])
                index //= arity
            if not levels:
                leaf.append(own.root.hex())
            digest.update(above_text)
            proof.append(digest.hexdigest())
            # The nodes in the layout were built from untampered leaves; a row that is as it was folds to their root.
            folded.append(fold(now[i] or leaf[-1], path + above))
        sub = row["subroot"].as_py().hex()
        columns = [batch.column("key").flatten(), pa.array(leaf), pa.array([sub] * len(leaf)), pa.array([root] * len(leaf)), pa.array(proof), pa.array(folded), pa.array([f == root for f in folded])]
        return pa.RecordBatch.from_arrays(columns, [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = f"`{key}` {key_kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return blocks.mapInArrow(run, schema)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered(documents: DataFrame, every: int = 5) -> Column:
    """The text as a copy of the table would have it whose A-Z were lower-cased in every ``every``-th document by the CRC-32 of its id."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate("text", upper, upper.lower()))


def check_documents(documents: DataFrame, height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """Documents against their manifest, some of them tampered with; see ``verify_rows``."""
    own = documents.select(*FIELDS).withColumn("_now", tampered(documents))
    fields = [F.col(c) for c in FIELDS]
    now = F.when(F.col("_now").isNotNull(), leaf_digest([*fields[:-1], F.col("_now")]))
    leaves = own.select("doc_id", "source", leaf_digest(fields).alias("leaf"), now.alias("now"))
    manifest = build_manifest(leaves, "doc_id", "source", "leaf", ["now"], height, arity)
    return verify_rows(manifest, "doc_id", dict(documents.dtypes)["doc_id"], 0, height, arity)
