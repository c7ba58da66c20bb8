"""Repeated byte strings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller ``doc_id``,
or further ahead in the same document. All strings are judged on the input.

*Sharding.* A suffix array over all text in one place is out of the question, and comparing every pair of shards too. So
shards are made by content: every window of ``length`` bytes is named after the smallest hash among the ``GRAM``-byte
strings in it, its anchor. Equal windows have the same anchor at the same place, so they meet in the same shard. The
consecutive windows of an anchor form a segment. Only segments matter whose anchor occurs more than once; of equal
segments (same anchor hash, same 64-bit hash of the bytes) one is looked at, and all windows of the later ones are
repeated. Where all segments of an anchor are equal, nothing is left to compare. Equal segments of the texts that are read
together are one row from the start, with the first place and a list of the others, so a passage that is in every document
is a row per some megabytes of text.

*Shards.* The remaining segments of a range of anchors are put together. An equal window holds the anchor at the same place,
so each segment is cut to the bytes around its anchor that any other one with the same anchor has too; where these are fewer
than ``length``, it goes. What stays is laid end to end to a text of bounded size. Its suffix array comes
from Larsson-Sadakane refinement in numpy: suffixes are sorted by their first bytes, then groups of equal ones by the
rank of the suffix that follows, the compared length doubling each time, until it exceeds the string length. Kasai's
recursion gives the common prefixes, for all segments in step. Neighbours with a common prefix of at least ``length``
bytes are the same window; all but the earliest are repeated.

*Merging.* An anchor with more segments than a shard may hold is spread over several. Each writes its windows as sorted
runs, cut by the windows' place relative to the anchor and by a hash; runs that belong together are merged by binary
search of each run in the union of the others.

NULL texts count as empty; documents shorter than ``length`` lose nothing. A NULL ``doc_id`` comes after all others.
Rows with the same ``doc_id`` and different texts are ordered by two 64-bit hashes of the text; of equal rows one counts as the
first and the others as its repetitions. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import mix64, text_or_empty
from panelwright.session import cut_lineage, discard

LENGTH = 100
GRAM = 32
SLICE_BYTES = 2_000_000
SHARD_SEGMENTS = 12_000
ROWS_PER_TASK = 200_000
LAST = (1 << 63) - 1
KEY = ["d", "th", "tu"]


# --- anchors -------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    up = np.full(n, base, dtype=np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def segments(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor position, anchor hash) of all segments of the texts laid end to end.

    ``ends``: where each text ends. No window reaches over an end.
    """
    n = len(raw)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64)
    up, down = _powers(1 << max(21, (n - 1).bit_length()))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix64((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    low = np.uint64((1 << 24) - 1)
    order = (hashes & ~low) | (np.arange(len(hashes), dtype=np.uint64) & low)  # the place breaks ties: leftmost
    span, width, least = length - gram + 1, 1, order
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    valid = np.ones(n - length + 1, dtype=bool)
    for end in ends[:-1]:
        valid[max(0, end - length + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    anchor = (least[at] & low).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    return at[begin], np.diff(np.append(begin, len(at))), anchor[begin], hashes[anchor[begin]]


def _slices(texts: list[bytes], length: int):
    """Lists of (row, offset, bytes) of bounded size; long texts are cut with an overlap of one window less a byte."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - length + 1, 0), SLICE_BYTES):
            part = text[offset : offset + SLICE_BYTES + length - 1]
            if size + len(part) > 2 * SLICE_BYTES:
                yield held
                held, size = [], 0
            held.append((row, offset, part))
            size += len(part)
    if held:
        yield held


def _segments_of(texts: list[bytes], length: int, gram: int):
    """(row, start, windows, place of the anchor in its segment, anchor hash, hash of the bytes), as arrays per slice."""
    for parts in _slices(texts, length):
        joined = b"".join(p for _, _, p in parts)
        ends = np.cumsum([len(p) for _, _, p in parts])
        first, count, anchor, h = segments(np.frombuffer(joined, dtype=np.uint8), ends, length, gram)
        part = np.searchsorted(ends, first, side="right")
        begins = ends - np.array([len(p) for _, _, p in parts])
        rows = np.array([r for r, _, _ in parts], dtype=np.int64)[part]
        start = first - begins[part] + np.array([o for _, o, _ in parts], dtype=np.int64)[part]
        view = memoryview(joined)
        seg = np.fromiter(
            (xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)), dtype=np.uint64, count=len(first)
        )
        # The same bytes around another place of the anchor would be another segment.
        yield rows, start, count, anchor - first, h, seg + (anchor - first).astype(np.uint64)


def _text_hashes(text: Column) -> list[Column]:
    """Two 64-bit hashes, which tell apart texts of one ``doc_id`` (all rows without one among them)."""
    return [F.xxhash64(text).alias("th"), F.xxhash64(F.lit(2), text).alias("tu")]


def _sources(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), *_text_hashes(text))


def _folded(h: np.ndarray, seg: np.ndarray, where: list[np.ndarray]) -> tuple[np.ndarray, list[bytes | None]]:
    """Equal segments as one: (index of the first place of each, packed places of its others or None)."""
    order = np.lexsort((*where[::-1], seg, h))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (seg[order[1:]] != seg[order[:-1]])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(order))
    others: list[bytes | None] = [None] * len(first)
    for i in np.flatnonzero(ends - first > 1).tolist():
        rows = order[first[i] + 1 : ends[i]]
        others[i] = np.stack([w[rows] for w in where], axis=1).tobytes()
    return order[first], others


def all_segments(sources: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, seg, d, th, tu, place, others) of the different segments of some texts at a time.

    ``place`` holds the start of the first one, its anchor's place and its number of windows; ``others`` (d, th, tu, place)
    of the rest, packed.
    """
    names = ["h", "seg", *KEY, "place"]
    schema = pa.schema([*[(n, pa.int64()) for n in names], ("others", pa.binary())])

    def find(batches):
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(0)]
            d, th, tu = (c.to_numpy() for c in batch.columns[1:])
            for row, start, count, anchor, h, seg in _segments_of(texts, length, gram):
                where = [d[row], th[row], tu[row], start << 16 | anchor << 8 | count]
                own, others = _folded(h, seg, where)
                columns = [h[own].view(np.int64), seg[own].view(np.int64), *[w[own] for w in where]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(others, pa.binary())], schema=schema)

    return sources.select("text", *KEY).mapInArrow(find, "h long, seg long, d long, th long, tu long, place long, others binary")


def _unfolded(rows: DataFrame) -> DataFrame:
    """(d, th, tu, place) of all the packed places."""

    def unpack(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                packed = b"".join(x for x in batch.column(0).slice(at, 500).to_pylist() if x)
                places = np.frombuffer(packed, dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(places[:, i].copy()) for i in range(4)], names=[*KEY, "place"])

    return rows.where("others is not null").select("others").mapInArrow(unpack, "d long, th long, tu long, place long")


def _repeating(found: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of segments whose anchor repeats: later ones that equal an earlier one (d, th, tu, place), and the first of each kind
    where there are several kinds (h, seg, d, th, tu, place, kinds).

    The rows of a rare anchor are compared in one pass. Those of frequent ones (``hot``) are reduced to the first place of
    each kind by sums; the later places are all rows but these, told apart by grouping on the whole row, so that no task
    holds all rows of such an anchor.
    """
    place = F.struct(*KEY, "place")
    size = 1 + F.coalesce(F.length("others") / 32, F.lit(0)).cast("long")
    rare = found if hot is None else found.join(F.broadcast(hot), "h", "left_anti")
    rare = rare.withColumn("_m", size).repartition("h")  # one exchange for all windows
    rare = rare.withColumns(
        {
            "first": F.min(place).over(Window.partitionBy("h", "seg")),
            "_kind": F.dense_rank().over(Window.partitionBy("h").orderBy("seg")),
            "_n": F.sum("_m").over(Window.partitionBy("h")),
        }
    )
    rare = rare.withColumn("kinds", F.max("_kind").over(Window.partitionBy("h"))).where("_n > 1").drop("_kind", "_n", "_m")
    rare = cut_lineage(rare.withColumn("is_first", F.col("first") == place).drop("first"), "suffix-repeating")
    copies = rare.where("not is_first").select(*KEY, "place").unionByName(_unfolded(rare))
    contested = rare.where("is_first and kinds > 1").select("h", "seg", *KEY, "place", "kinds")
    if hot is None:
        return copies, contested
    often = cut_lineage(found.join(F.broadcast(hot), "h", "left_semi"), "suffix-often")
    first = cut_lineage(often.groupBy("h", "seg").agg(F.min(place).alias("f")).select("h", "seg", "f.*"), "suffix-first")
    rows = often.drop("others").withColumn("is_first", F.lit(0)).unionByName(first.withColumn("is_first", F.lit(1)))
    later = rows.groupBy("h", "seg", *KEY, "place").agg(F.max("is_first").alias("is_first")).where("is_first = 0")
    many = first.groupBy("h").agg(F.count(F.lit(1)).cast("int").alias("kinds")).where("kinds > 1")
    copies = copies.unionByName(later.select(*KEY, "place")).unionByName(_unfolded(often))
    return copies, contested.unionByName(first.join(many, "h").select(contested.columns))


# --- suffix arrays of a shard --------------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, place) of all suffixes; ``text`` holds bytes, -1 ends a segment.

    Larsson-Sadakane: only groups that are still equal are sorted again, by the rank of what follows.
    """
    n, first = len(text), 7
    wide = np.zeros(n + first, dtype=np.uint64)
    wide[:n] = (text.astype(np.int64) + 1).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(first):
        key = (key << np.uint64(9)) | wide[i : i + n]
    order = np.argsort(key)
    key = key[order]
    head = np.ones(n, dtype=bool)
    head[1:] = key[1:] != key[:-1]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = group
    rank[n] = -1
    h = first
    while True:
        at = np.flatnonzero(~(head & np.append(head[1:], True)))  # places in groups of several
        if not len(at):
            break
        own = order[at]
        follow = rank[np.minimum(own + h, n)]
        inside = np.argsort(group[at] * (n + 1) + follow + 1)
        order[at] = own[inside]
        follow, lead = follow[inside], group[at][inside]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (lead[1:] != lead[:-1]) | (follow[1:] != follow[:-1])
        head[at] = new
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[order] = group
        h *= 2
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(text: np.ndarray, order: np.ndarray, place: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Kasai: the common prefix of each suffix with the one before it in ``order``, up to ``most``.

    From one suffix to the next the prefix shrinks by one byte at most. All segments run in step.
    """
    n = len(text)
    out = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([text.astype(np.int16), np.full(most + 1, -2, dtype=np.int16)])
    before = np.where(place > 0, order[place - 1], n)
    have = np.zeros(len(starts), dtype=np.int64)
    for step in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > step)
        i = starts[live] + step
        j = before[i]
        k = np.maximum(have[live] - 1, 0)
        k[j == n] = 0
        go = np.flatnonzero(j < n)
        while len(go):
            a, b = padded[i[go] + k[go]], padded[np.minimum(j[go] + k[go], n)]
            go = go[(a == b) & (a >= 0) & (k[go] < most)]
            k[go] += 1
        out[i] = k
        have[live] = k
    return out


def repeated_windows(bodies: list[bytes], places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a shard in suffix order: (segment, offset, class, place, repeated).

    ``places``: rank of each segment in the order of documents, such that ``places + offset`` orders windows.
    """
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.full(int((sizes + 1).sum()), -1, dtype=np.int16)
    owner = np.repeat(np.arange(len(bodies)), sizes + 1)
    text[np.arange(len(text)) - starts[owner] < sizes[owner]] = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    order, rank = suffix_array(text)
    prefix = common_prefixes(text, order, rank, starts, sizes, length)
    offset = order - starts[owner[order]]
    window = offset + length <= sizes[owner[order]]
    # Suffixes between two equal windows have that prefix in common too, so none that is no window lies between them.
    order = order[window]
    new = prefix[order] < length
    label = np.cumsum(new) - 1
    segment, offset = owner[order], offset[window]
    where = places[segment] + offset
    first = np.full(int(label[-1]) + 1 if len(label) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, label, where)
    return segment, offset, label, where, where > first[label]


def _shared(bodies: list[bytes], h: np.ndarray, anchor: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and behind its anchor each segment has in common with any other of the same anchor, up to ``span``.

    Sorted by anchor and by what lies on that side of it, a segment has most in common with a neighbour.
    """
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    names = np.ascontiguousarray(np.unique(h, return_inverse=True)[1].astype(">i8")).view(np.uint8).reshape(-1, 8)
    out = []
    for room, first, step in ((anchor, starts + anchor - 1, -1), (sizes - anchor - gram, starts + anchor + gram, 1)):
        at = first[:, None] + step * np.arange(span)
        # Zeros behind an end may count as common: too much is kept then, never too little.
        side = np.where(np.arange(span) < room[:, None], raw[at.clip(0, len(raw) - 1)], 0).astype(np.uint8)
        keys = np.concatenate([names, side], axis=1)
        order = np.argsort(keys.view(f"S{8 + span}").ravel())
        same = keys[order[1:]] == keys[order[:-1]]
        common = np.where(same.all(axis=1), span, same.argmin(axis=1) - 8)
        most = np.zeros(len(bodies), dtype=np.int64)
        most[order[1:]] = common.clip(0)
        most[order[:-1]] = np.maximum(most[order[:-1]], common.clip(0))
        out.append(np.minimum(most, room))
    return out[0], out[1]


def _trimmed(rows: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    """``rows`` (all segments of some anchors) without the bytes, and the segments, that can have no window in common with others."""
    if length == gram:
        return rows
    place = rows["place"].to_numpy()
    anchor = (place >> 8) & 0xFF
    before, behind = _shared(rows["body"].tolist(), rows["h"].to_numpy(), anchor, length - gram, gram)
    stay = before + gram + behind >= length
    first, end = (anchor - before)[stay], (anchor + gram + behind)[stay]
    rows = rows[stay]
    bodies = [b[x:y] for b, x, y in zip(rows["body"], first.tolist(), end.tolist(), strict=True)]
    place = (place[stay] >> 16) + first << 16 | before[stay] << 8 | end - first - length + 1
    return rows.assign(body=bodies, place=place).reset_index(drop=True)


# --- the job -------------------------------------------------------------------------------------------------------

RESULT = "d long, th long, tu long, start long, n long, h long, o int, r int, keys binary, docs binary, starts binary"


def _bodies(sources: DataFrame, contested: DataFrame, length: int) -> DataFrame:
    """``contested`` (h, seg, d, th, tu, place, kinds) with the bytes of each segment."""
    wanted = contested.groupBy(*KEY).agg(F.collect_list(F.struct("h", "seg", "place", "kinds")).alias("wanted"))
    names = ["h", "seg", *KEY, "place", "kinds", "body"]
    kinds = [*[pa.int64()] * 6, pa.int32(), pa.binary()]

    def cut(batches):
        for batch in batches:
            rows, size = [], 0
            for text, d, th, tu, own in zip(*(c if i in (0, 4) else c.to_pylist() for i, c in enumerate(batch.columns)), strict=True):
                raw = text.as_py().encode()
                for x in own.as_py():
                    start, n = x["place"] >> 16, x["place"] & 0xFF
                    body = raw[start : start + n + length - 1]
                    rows.append((x["h"], x["seg"], d, th, tu, x["place"], x["kinds"], body))
                    size += len(body)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    joined = sources.select("text", *KEY).join(wanted, KEY).select("text", *KEY, "wanted")
    return joined.mapInArrow(cut, "h long, seg long, d long, th long, tu long, place long, kinds int, body binary")


def _runs(owner: np.ndarray, start: np.ndarray):
    """Consecutive starts of one owner as (first index, count)."""
    new = np.ones(len(start), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(start)))


def _shard(length: int, gram: int = GRAM):
    """Suffix array, common prefixes and repeated windows of one shard."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["h", "seg", *KEY, "place"]).sort_values([*KEY, "place"], kind="stable").reset_index(drop=True)
        part, parts = int(rows["part"].iat[0]), int(rows["parts"].iat[0])
        if part < 0:
            rows = _trimmed(rows, length, gram)
        d, th, tu, place = (rows[c].to_numpy() for c in (*KEY, "place"))
        start = place >> 16
        doc = np.cumsum(np.append(False, (d[1:] != d[:-1]) | (th[1:] != th[:-1]) | (tu[1:] != tu[:-1])))
        segment, offset, label, where, again = repeated_windows(rows["body"].tolist(), (doc << 40) + start, length)
        by = np.lexsort((offset[again], segment[again]))
        s, at = segment[again][by], (start[segment] + offset)[again][by]
        first, n = _runs(s, at)
        out = [pd.DataFrame({"d": d[s[first]], "th": th[s[first]], "tu": tu[s[first]], "start": at[first], "n": n})]
        if part >= 0:  # an anchor spread over several shards: runs of its windows, in sorted order
            keep = np.flatnonzero(~again)
            keep = keep[np.unique(label[keep], return_index=True)[1]]
            bodies, h = rows["body"].tolist(), rows["h"].iat[0]
            keys = [bodies[a][b : b + length] for a, b in zip(segment[keep].tolist(), offset[keep].tolist(), strict=True)]
            o = ((place[segment[keep]] >> 8) & 0xFF) - offset[keep]
            r = np.array([xxhash.xxh3_64_intdigest(k) % parts for k in keys], dtype=np.int64)
            pairs = np.stack([x[segment[keep]] for x in (d, th, tu)], axis=1)
            starts = start[segment[keep]] + offset[keep]
            for cell in np.unique(np.stack([o, r], axis=1), axis=0):
                own = np.flatnonzero((o == cell[0]) & (r == cell[1]))
                run = {"h": h, "o": cell[0], "r": cell[1], "keys": b"".join(keys[i] for i in own), "docs": pairs[own].tobytes(), "starts": starts[own].tobytes()}
                out.append(pd.DataFrame([run]))
        names = [x.strip().split(" ")[0] for x in RESULT.split(",")]
        kinds = {"d": "Int64", "th": "Int64", "tu": "Int64", "start": "Int64", "n": "Int64", "h": "Int64", "o": "Int32", "r": "Int32"}
        return pd.concat([x.reindex(columns=names).astype(kinds) for x in out], ignore_index=True)

    return work


def _merge(length: int):
    """Merges the sorted runs of one cell by binary search; returns the windows that an earlier shard entry repeats."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        union, held, found = np.zeros(0, dtype=f"S{length}"), [], []
        for keys, docs, starts in sorted(zip(rows["keys"], rows["docs"], rows["starts"], strict=True)):
            run = np.frombuffer(keys, dtype=f"S{length}")
            places = [(*p, s) for p, s in zip(np.frombuffer(docs, dtype=np.int64).reshape(-1, 3).tolist(), np.frombuffer(starts, dtype=np.int64).tolist(), strict=True)]
            at = np.searchsorted(union, run)
            same = np.zeros(len(run), dtype=bool)
            inside = at < len(union)
            same[inside] = union[at[inside]] == run[inside]
            for i in np.flatnonzero(same).tolist():
                mine, other = places[i], held[at[i]]
                found.append(max(mine, other))
                held[at[i]] = min(mine, other)
            fresh = np.flatnonzero(~same)
            union = np.insert(union, at[fresh], run[fresh])
            merged, k = [], 0
            for i in fresh.tolist():
                merged += held[k : at[i]]
                k = at[i]
                merged.append(places[i])
            held = merged + held[k:]
        return pd.DataFrame([(*p, 1) for p in found], columns=[*KEY, "start", "n"]).astype("int64")

    return work


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(d, th, tu, start, n): from ``start`` on, ``n`` consecutive windows that also start earlier. ``d`` is ``doc_id``, the
    largest long for NULL; ``th`` and ``tu`` are hashes of the text."""
    sources = _sources(docs)
    found = cut_lineage(all_segments(sources, length, gram), "suffix-segments")
    # Which way an anchor goes does not change the result. Partial counts of all rows, kept by task where they are large,
    # name the anchors of more rows than a task should hold; there are few of them, whatever the size of the table.
    counts = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_task).select("h")
    hot = cut_lineage(counts, "suffix-frequent")
    hot = None if hot.isEmpty() else hot
    later, contested = _repeating(found, hot)
    discard(found)
    copies = later.select(*KEY, F.shiftright("place", 16).alias("start"), F.col("place").bitwiseAND(0xFF).alias("n"))
    contested = contested.withColumn("kinds", F.col("kinds").cast("int"))
    shards = max(1, -(-contested.count() // shard_segments))
    parts = F.ceil(F.col("kinds") / shard_segments).cast("int")
    large = F.col("kinds") > shard_segments
    bodies = _bodies(sources, contested, length).withColumns(
        {
            "parts": parts,
            "part": F.when(large, F.pmod(F.col("seg"), parts.cast("long")).cast("int")).otherwise(F.lit(-1)),
            "shard": F.when(large, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards))),
        }
    )
    inside = cut_lineage(bodies.groupBy("shard", "part").applyInPandas(_shard(length, gram), RESULT), "suffix-shards")
    across = inside.where("keys is not null").groupBy("h", "o", "r").applyInPandas(_merge(length), "d long, th long, tu long, start long, n long")
    return copies.unionByName(inside.where("keys is null").select(*KEY, "start", "n")).unionByName(across)


def _marked(docs: DataFrame, length: int, **options) -> DataFrame:
    spans = cut_lineage(repeated_starts(docs, length, **options), "suffix-spans").groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    same = Window.partitionBy(*KEY).orderBy("doc_id")
    return _sources(docs).withColumn("again", F.row_number().over(same) > 1).join(spans, KEY, "left").select("doc_id", "text", "again", "spans")


def removed_mask(n: int, spans, again: bool, length: int) -> np.ndarray:
    """Which of ``n`` bytes go."""
    if again:
        return np.full(n, n >= length)
    change = np.zeros(n + 1, dtype=np.int64)
    for start, count in spans:
        change[start] += 1
        change[start + count + length - 1] -= 1
    return np.cumsum(change[:n]) > 0


def repeated_bytes(docs: DataFrame, length: int = LENGTH, with_kept: bool = False, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row; ``kept``: the bytes that stay."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_kept]

    def digest(batches):
        for batch in batches:
            rows = []
            spans = batch.column(3)
            for i, (doc_id, text, again) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True)):
                raw = text.as_py().encode()
                own = [(x["start"], x["n"]) for x in spans[i].as_py() or ()]
                if own or again:
                    gone = removed_mask(len(raw), own, again, length)
                    kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                    runs = int((gone & ~np.append(False, gone[:-1])).sum())
                else:
                    kept, runs = raw, 0
                rows.append((doc_id, len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), *[kept] * with_kept))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return _marked(docs, length, **options).mapInArrow(digest, ddl)


def query(spark, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
