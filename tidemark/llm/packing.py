"""Packing of documents into sequences of a fixed number of tokens: best fit, then swap-based local search.

Documents are encoded, ended by an id and cut into pieces only where they are longer than a sequence. Pieces are dealt into groups of about
``group_rows`` by a hash, each packed in one task by their lengths alone: longest first into the fullest bin with room, then
documents are moved, or exchanged one for one, two for one or one for two, from the emptiest bin to others. Each
step makes a fuller bin fuller, so the sum of squared fills grows; a bin that runs empty is gone. It ends when no step helps or the
bins are as few as their tokens allow. What is left in each group's underfull bins is packed together in a second round.

Nulls and repeats: a null text is empty, a piece of the end id alone; rows that share a doc_id are different documents; a null doc_id is kept.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.tokens import encoder
from tidemark.session import materialize

PIECES = "doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


def encode_pieces(documents: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``: the pieces of every document."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        end = np.array([end_id], "<u4").tobytes()
        owners, piece, start, length, crcs, ids = [], [], [], [], [], []
        for at, encoded in enumerate(encoder(tokenizer).encode([t or "" for t in batch.column(1).to_pylist()])):
            encoded += end
            for k, low in enumerate(range(0, len(encoded), 4 * size)):
                own = encoded[low : low + 4 * size]
                owners.append(at)
                piece.append(k)
                start.append(low // 4)
                length.append(len(own) // 4)
                crcs.append(zlib.crc32(own))
                if with_ids:
                    ids.append(np.frombuffer(own, "<u4").astype(np.int32))
        columns = {"doc_id": batch.column(0).take(pa.array(owners, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64())}
        return columns | {"length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))}

    return map_batches(documents.select("doc_id", "text"), run, PIECES.format(kind=kind) + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: list[int], size: int) -> list[list[tuple[int, int]]]:
    """Bins of (length, item): longest first, each into the fullest bin that has room."""
    bins, rooms, mask = [], {}, 0
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        fit = mask >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, at = size, len(bins)
            bins.append([])
        bins[at].append((n, item))
        room -= n
        if room:
            rooms.setdefault(room, []).append(at)
            mask |= 1 << room
    return bins


def _pairs(items: list[tuple[int, int]], low: int, high: int) -> tuple | None:
    """Two items of a sorted list whose sum is the least in [low, high)."""
    best, i, j = None, 0, len(items) - 1
    while i < j:
        total = items[i][0] + items[j][0]
        if total >= low:
            if total < high and (best is None or total < best[0]):
                best = (total, items[i], items[j])
            j -= 1
        else:
            i += 1
    return best


def _step(giver: list, taker: list, room: int) -> tuple[list, list] | None:
    """What ``giver`` gives and gets so that ``taker`` becomes fuller by at most ``room``: the largest such gain found."""
    best = None

    def offer(gives, gets):
        nonlocal best
        gain = sum(n for n, _ in gives) - sum(n for n, _ in gets)
        if 0 < gain <= room and (best is None or gain > best[0]):
            best = (gain, gives, gets)

    for d in giver:
        if d[0] <= room:
            offer([d], [])
            continue
        at = bisect_left(taker, (d[0] - room, -1))
        if at < len(taker) and taker[at][0] < d[0]:
            offer([d], [taker[at]])
        two = _pairs(taker, d[0] - room, d[0])
        if two:
            offer([d], [two[1], two[2]])
        if best and best[0] == room:
            return best[1:]
    for e in taker:
        # Two of the giver's for one: their sum is at most what e and the room allow, as large as can be.
        i, j = 0, len(giver) - 1
        while i < j:
            total = giver[i][0] + giver[j][0]
            if total > e[0] + room:
                j -= 1
            else:
                offer([giver[i], giver[j]], [e])
                i += 1
        if best and best[0] == room:
            break
    return best[1:] if best else None


def local_search(bins: list[list[tuple[int, int]]], size: int) -> list[list[tuple[int, int]]]:
    """Fewer bins, if moves and exchanges can empty some.

    The emptiest bin that is not stuck gives. A log of changed bins keeps a bin from meeting one again when neither has
    changed since, so that going back to the emptiest bin after every gain costs what has changed, not all pairs of bins.
    """
    least = -(-sum(n for b in bins for n, _ in b) // size)
    fill = [sum(n for n, _ in b) for b in bins]
    full = [b for b, f in zip(bins, fill, strict=True) if f == size]
    # Fill, items, where in the log it changed last, and up to where it has met the others as giver.
    open_ = sorted(([f, sorted(b), 0, -1] for b, f in zip(bins, fill, strict=True) if f < size), key=lambda x: x[0])
    log, stuck = [], 0
    while len(full) + len(open_) > least and stuck < len(open_):
        giver, before = open_[stuck], len(log)
        if giver[3] < giver[2] or before - giver[3] > len(open_):
            takers = open_[::-1]
        else:
            takers = log[giver[3] :]
        for taker in takers:
            while taker is not giver and giver[1] and taker[1] and giver[0] <= taker[0] < size:
                step = _step(giver[1], taker[1], size - taker[0])
                if not step:
                    break
                for item in step[0]:
                    giver[1].remove(item)
                    insort(taker[1], item)
                for item in step[1]:
                    taker[1].remove(item)
                    insort(giver[1], item)
                gain = sum(n for n, _ in step[0]) - sum(n for n, _ in step[1])
                giver[0] -= gain
                taker[0] += gain
                log += [giver, taker]
                giver[2] = taker[2] = len(log)
            if not giver[1]:
                break
        if len(log) == before:
            # A bin that no step helps stays as it is; the next one is tried.
            giver[3] = before
            stuck += 1
            continue
        full += [b[1] for b in open_ if b[0] == size]
        open_ = sorted((b for b in open_ if b[1] and b[0] < size), key=lambda b: b[0])
        # After any step all of them are tried again: a step may have opened room for one that was stuck.
        stuck = 0
    return full + [b[1] for b in open_]


def pack_lengths(lengths: list[int], size: int) -> list[list[tuple[int, int]]]:
    return local_search(best_fit(lengths, size), size)


def _pack_groups(rows: DataFrame, groups: int, size: int, round_: int) -> DataFrame:
    """``rid, length`` packed: adds ``sequence_id, offset, fill``. Groups are numbered per round."""

    def run(table: pa.Table) -> pa.Table:
        lengths, group = table.column("length").to_pylist(), table.column("grp")[0].as_py()
        items, seq, offset, fill = [], [], [], []
        for at, members in enumerate(pack_lengths(lengths, size)):
            place, total = 0, sum(n for n, _ in members)
            for n, item in sorted(members, key=lambda m: m[1]):
                items.append(item)
                seq.append(((round_ << 30 | group) << 32) | at)
                offset.append(place)
                fill.append(total)
                place += n
        taken = table.take(pa.array(items, pa.int64()))
        return pa.table({"rid": taken.column("rid"), "length": taken.column("length"), "sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(offset, pa.int64()), "fill": pa.array(fill, pa.int64())})

    dealt = rows.select("rid", "length", F.pmod(F.xxhash64(F.col("rid"), F.lit(round_)), F.lit(groups)).cast("int").alias("grp"))
    return dealt.groupBy("grp").applyInArrow(run, "rid bigint, length bigint, sequence_id bigint, offset bigint, fill bigint")


def pack_pieces(pieces: DataFrame, size: int = 4096, group_rows: int = 20_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Needs a column ``length`` of at most ``size``; all others are carried along."""
    numbered = materialize(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    packed = placed = None
    rows = numbered.select("rid", "length")
    for round_ in range(2):
        found = rows.count()
        if round_ and found == 0:
            break
        out = materialize(_pack_groups(rows, max(1, -(-found // group_rows)), size, round_), "packed")
        # Bins that are nearly full stay; the pieces of the others meet again once, over all groups.
        keep = (F.col("fill") >= size * 0.98) | F.lit(round_ == 1)
        placed = out.where(keep).drop("fill", "length")
        packed = placed if packed is None else packed.unionByName(placed)
        rows = out.where(~keep).select("rid", "length")
        if found <= group_rows:
            packed = out.drop("fill", "length") if round_ == 0 else packed
            break
    return numbered.join(packed, "rid").drop("rid")
