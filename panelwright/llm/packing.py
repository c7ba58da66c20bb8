"""Best-fit packing by exact-complement hashing.

Texts become token ids with an end id. Texts longer than a sequence are cut into full sequences; the rest, if any, comes
first. Only the lengths of the rests matter for packing, and there are fewer different lengths than a sequence has
tokens: the plan is made from the counts per length. Hash tables of single, pair and triple sums of the lengths still
available say which combination fills the gap left by the longest rest exactly; each such pattern is used as often as
the counts allow. Where no combination fits exactly, best fit takes the longest lengths that still fit. A step uses up a
length, so the plan has at most a few patterns per length however many documents there are.

Each rest has a rank among those of its length (counted inside ranges of a hash, so a length that many copies share is
no single task) and looks up the pattern, the repetition and the place it belongs to.

NULL texts count as empty and hold only the end id; repeated rows are packed each; a NULL ``doc_id`` stays NULL. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import text_or_empty
from panelwright.llm.encoding import default_path, encoder
from panelwright.session import cut_lineage

CAPACITY = 1024
END_ID = 2
RANGES = 256


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text; ids are little-endian unsigned 32-bit numbers."""
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def cut(batches):
        encode = encoder(tokenizer_path, False).encode
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total, at, piece = len(ids) // 4, 0, 0
                while at < total:
                    length = total % capacity or capacity if at == 0 else capacity
                    own = ids[4 * at : 4 * (at + length)]
                    rows.append((doc_id, piece, at, length, zlib.crc32(own), *[own] * with_ids))
                    at, piece, size = at + length, piece + 1, size + length * with_ids
                if len(rows) >= 20_000 or size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(cut, ddl)


def _complement(free: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to ``gap``: the one with the longest part."""
    if free[gap] > 0:
        return (gap,)
    have = np.flatnonzero(free[: gap + 1])
    have = have[have > 0]
    if not len(have):
        return None
    other = gap - have
    pairs = have[(other > 0) & (free[other] > 0) & ((have != other) | (free[have] > 1))]
    if len(pairs):
        a = int(pairs[-1])
        return (max(a, gap - a), min(a, gap - a))
    # Sums of two available lengths, each with the longer one of its shortest-difference pair.
    for a in have[::-1]:
        free[a] -= 1
        rest = gap - int(a)
        part = have[(have < rest) & (free[have] > 0)]
        other = rest - part
        good = part[(free[other] > 0) & ((part != other) | (free[part] > 1))]
        free[a] += 1
        if len(good):
            b = int(good[-1])
            return tuple(sorted((int(a), b, rest - b), reverse=True))
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (how often, lengths) that use up ``counts``: lengths below ``capacity`` with their numbers."""
    free = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        free[length] = n
    patterns: list[tuple[int, tuple[int, ...]]] = []
    for longest in range(capacity - 1, 0, -1):
        while free[longest] > 0:
            free[longest] -= 1
            parts, gap, exact = [longest], capacity - longest, None
            while gap:
                exact = _complement(free, gap)
                if exact:
                    for x in exact:
                        free[x] -= 1
                    parts += exact
                    break
                fits = np.flatnonzero(free[1 : gap + 1] > 0)
                if not len(fits):
                    break
                best = int(fits[-1]) + 1
                free[best] -= 1
                parts.append(best)
                gap -= best
            used = {x: parts.count(x) for x in parts}
            more = int(min(free[x] // k for x, k in used.items()))
            for x, k in used.items():
                free[x] -= more * k
            patterns.append((1 + more, tuple(parts)))
    return patterns


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with (sequence_id, offset). Full pieces are sequences by themselves.

    ``pieces`` needs (doc_id, piece, length) and should be a written table: it is read several times.
    """
    rests = pieces.where(F.col("length") < capacity).withColumn("_range", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANGES)).cast("int"))
    per_range = rests.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("_n"))
    per_range = cut_lineage(per_range, "pack-ranges")  # at most capacity * RANGES rows
    counts = {r["length"]: r["n"] for r in per_range.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    patterns = plan(counts, capacity)

    # For each length: the ranks from which on a place in a pattern serves, with what to make of the rank.
    firsts: dict[int, list[int]] = {}
    places: dict[int, list[tuple[int, int]]] = {}
    sequence = 0
    taken: dict[int, int] = {}
    for times, parts in patterns:
        offset = 0
        for x in parts:
            firsts.setdefault(x, []).append(taken.get(x, 0))
            places.setdefault(x, []).append((sequence, offset))
            taken[x] = taken.get(x, 0) + times
            offset += x
        sequence += times
    earlier = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_range.select("length", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"))
    order = Window.partitionBy("length", "_range").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rests.withColumn("_row", F.row_number().over(order)).join(ahead, ["length", "_range"])
    ranked = ranked.withColumn("_rank", F.col("_ahead") + F.col("_row") - 1).drop("_ahead", "_row", "_range")

    def place(batches):
        for rows in batches:
            where = []
            for length, rank in zip(rows["length"], rows["_rank"], strict=True):
                i = bisect_right(firsts[length], rank) - 1
                first, offset = places[length][i]
                where.append((first + rank - firsts[length][i], offset))
            rows = rows.drop(columns="_rank")
            yield rows.assign(sequence_id=pd.Series([w[0] for w in where], dtype="int64"), offset=pd.Series([w[1] for w in where], dtype="int64"))

    schema = ", ".join(f"`{c}` {t}" for c, t in ranked.drop("_rank").dtypes) + ", sequence_id long, offset long"
    placed = ranked.mapInPandas(place, schema)
    full = pieces.where(F.col("length") >= capacity)
    full = full.withColumns({"sequence_id": F.lit(sequence) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return placed.unionByName(full.select(placed.columns))


def packed_sequences(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_tokens, ids): the ids of each sequence, at most ``capacity`` of them."""
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, end_id, capacity, with_ids=True), "pack-ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return pack(pieces, capacity).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ids.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece of a document with its place."""
    path = tokenizer_path or default_path("byte_bpe_50k.json")
    return pack(cut_lineage(token_pieces(docs, path), "pack-pieces"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
