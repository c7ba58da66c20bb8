"""How filters of a corpus interact: what each removes in every order in which they can be applied.

Five filters judge whole texts (see ``FILTERS``). Four of them come from one pass over the UTF-8 bytes, the fifth (E) from
an aggregate over equal texts. A text is then five bits, and the audit needs only the number of documents per part and
set of bits: all orders, steps and Shapley sums follow from the 32 sets of filters that may have been applied.

*Transducer.* A table of two states (gap, word) and 256 bytes gives the next state and what to note: start of a word, end
of a word, capital, code point, symbol. The state behind a byte depends on that byte alone, so a block of bytes passes
through the table in one vectorised step; each text starts in the state gap.

*Hash table.* The word spans found are inserted into an open-addressing table per batch, keyed by text and word. A slot's
span is compared byte by byte before a word counts as known; an unequal one goes on to the next slot. So numbers of
different words are exact.

NULL texts are empty: they fail A, and E if an earlier document is empty too. A NULL or empty ``source`` is the part ''. A
NULL ``doc_id`` comes after all others: it fails E if any document with an id has the text. Rows with the same id are not
earlier than each other. Several labels of a document count as set if one of them is; NULL labels count as not set. Extra
columns are ignored. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import mix64, text_or_empty
from panelwright.session import cut_lineage

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
SYMBOLS = b"#$%&*|"
WHITE = b" \t\n\x0b\x0c\r"
GAP, WORD = 0, 1
STARTS, ENDS, CAPITAL, POINT, SYMBOL = 2, 4, 8, 16, 32
BLOCK_BYTES = 1 << 22
INSERTED = 1 << 18
LONG_WORD = 64
ALL = (1 << len(FILTERS)) - 1


def transducer() -> np.ndarray:
    """Entry [state, byte]: the next state in the lowest bit, then what to note."""
    table = np.zeros((2, 256), dtype=np.uint8)
    for state, byte in itertools.product((GAP, WORD), range(256)):
        white = byte in WHITE
        entry = GAP if white else WORD
        entry |= STARTS * (state == GAP and not white) | ENDS * (state == WORD and white)
        entry |= CAPITAL * (0x41 <= byte <= 0x5A) | POINT * (byte & 0xC0 != 0x80) | SYMBOL * (byte in SYMBOLS)
        table[state, byte] = entry
    return table


TABLE = transducer()


class SpanTable:
    """Distinct words of several texts: open addressing, every match verified byte by byte."""

    def __init__(self, raw: np.ndarray, words: int):
        """``raw``: the bytes, with eight more behind them; ``words``: how many will be inserted at most."""
        self.raw = raw
        self.eights = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        self.slots = np.full(1 << max(4, int(2 * words).bit_length()), -1, dtype=np.int64)
        self.start = np.zeros(words, dtype=np.int64)
        self.size = np.zeros(words, dtype=np.int64)
        self.text = np.zeros(words, dtype=np.int64)
        self.head = np.zeros(words, dtype=np.uint64)
        self.used = 0

    def _eight(self, start: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Up to eight bytes from ``start`` on, of which ``left`` belong to the word."""
        shift = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
        return self.eights[start] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> shift)

    def _hash(self, start, size, text, head) -> np.ndarray:
        h = mix64(head ^ mix64(text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)))
        more, at = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
        while len(more):
            h[more] = mix64(h[more] ^ self._eight(start[more] + at, size[more] - at))
            at += 8
            more = more[size[more] > at]
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(self.raw[start[i] : start[i] + size[i]].data))
        return h

    def _same(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether words i and j are the same bytes of the same text."""
        same = (self.head[i] == self.head[j]) & (self.size[i] == self.size[j]) & (self.text[i] == self.text[j])
        more, at = np.flatnonzero(same & (self.size[i] > 8) & (i != j)), 8
        while len(more):
            long = self.size[i[more]] > LONG_WORD
            for k in more[long].tolist():
                a, b, n = self.start[i[k]], self.start[j[k]], self.size[i[k]]
                same[k] = np.array_equal(self.raw[a : a + n], self.raw[b : b + n])
            more = more[~long]
            left = self.size[i[more]] - at
            equal = self._eight(self.start[i[more]] + at, left) == self._eight(self.start[j[more]] + at, left)
            same[more[~equal]] = False
            more = more[equal & (left > 8)]
            at += 8
        return same

    def insert(self, start: np.ndarray, size: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Adds words; True for those that were not there."""
        new = np.arange(self.used, self.used + len(start))
        self.used += len(start)
        self.start[new], self.size[new], self.text[new] = start, size, text
        self.head[new] = self._eight(start, size)
        mask = len(self.slots) - 1
        slot = (self._hash(start, size, text, self.head[new]) & np.uint64(mask)).astype(np.int64)
        fresh = np.zeros(len(new), dtype=bool)
        open_ = np.arange(len(new))
        while len(open_):
            at = slot[open_]
            empty = self.slots[at] < 0
            self.slots[at[empty]] = new[open_[empty]]  # of several words the last one gets the slot
            owner = self.slots[at]
            fresh[open_[owner == new[open_]]] = True
            open_ = open_[~self._same(new[open_], owner)]
            slot[open_] = (slot[open_] + 1) & mask
        return fresh


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """words, distinct, capitals, points, symbols of every text."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(ends[-1] - ends[0])
    raw = np.zeros(size + 8, dtype=np.uint8)
    if size:
        raw[:size] = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    first = ends[:-1][ends[1:] > ends[:-1]]  # where a text that is not empty starts
    text_of = np.flatnonzero(ends[1:] > ends[:-1])
    begins, stops = [], []
    counts = {name: np.zeros(len(texts), dtype=np.int64) for name in ("words", "distinct", "capitals", "points", "symbols")}
    state = GAP
    for lo in range(0, size, BLOCK_BYTES):
        part = raw[lo : min(lo + BLOCK_BYTES, size)]
        states = np.empty(len(part), dtype=np.uint8)
        states[0] = state
        np.take(TABLE[GAP] & 1, part[:-1], out=states[1:])
        heads = first[np.searchsorted(first, lo) : np.searchsorted(first, lo + len(part))] - lo
        cut = heads[states[heads] == WORD]  # words that end where the next text starts
        states[heads] = GAP
        noted = np.take(TABLE, (states.astype(np.uint16) << 8) | part)
        begins.append(np.flatnonzero(noted & STARTS) + lo)
        stops.append(np.sort(np.concatenate([np.flatnonzero(noted & ENDS), cut])) + lo)
        state = int(noted[-1] & 1)
        edges = np.concatenate([[0], heads[heads > 0]])
        own = text_of[np.searchsorted(first, edges + lo, side="right") - 1]
        for name, bit in (("capitals", CAPITAL), ("points", POINT), ("symbols", SYMBOL)):
            counts[name][own] += np.add.reduceat((noted & bit) > 0, edges, dtype=np.int64)
    if not size:
        return counts
    if state == WORD:
        stops.append(np.array([size]))
    start, stop = np.concatenate(begins), np.concatenate(stops)
    text = text_of[np.searchsorted(first, start, side="right") - 1]
    counts["words"] += np.bincount(text, minlength=len(texts))
    at = 0
    while at < len(start):  # a table for some whole texts, or for one long text
        to = int(np.searchsorted(text, text[min(at + INSERTED, len(text)) - 1], side="right"))
        table = SpanTable(raw, to - at)
        for lo in range(at, to, INSERTED):
            own = slice(lo, min(lo + INSERTED, to))
            fresh = table.insert(start[own], stop[own] - start[own], text[own])
            counts["distinct"] += np.bincount(text[own][fresh], minlength=len(texts))
        at = to
    return counts


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, fails): bit i of ``fails`` for the i-th of the filters A to D."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.string()), ("fails", pa.int32())])

    def judge(batches):
        for batch in batches:
            n = measure(batch.column(3))
            fails = (n["words"] < LEAST_WORDS).astype(np.int32)
            fails |= (100 * n["distinct"] < DISTINCT_PERCENT * n["words"]) << 1
            fails |= (100 * n["capitals"] > CAPITAL_PERCENT * n["points"]) << 2
            fails |= (n["symbols"] > 0) << 3
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fails, pa.int32())], schema=schema)

    text = text_or_empty()
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    return own.mapInArrow(judge, "doc_id long, part string, digest string, fails int")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails) of every row, with the bits of all five filters."""
    own = cut_lineage(judged(docs), "audit-judged")
    copies = own.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _first is not null")
    copies = cut_lineage(copies.select("digest", "_first"), "audit-copies")
    copy = F.col("_first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("_first")))
    bits = F.col("fails").bitwiseOR(F.when(copy, 1 << 4).otherwise(0))
    return own.join(copies, "digest", "left").select("doc_id", "part", bits.alias("fails"))


def orders() -> list[tuple[str, list[tuple[int, str, int, int]]]]:
    """Each order of the filters with its steps: (step, filter, filters before as bits, the filter's number)."""
    out = []
    for order in itertools.permutations(FILTERS):
        before, steps = 0, []
        for step, name in enumerate(order, 1):
            steps.append((step, name, before, FILTERS.index(name)))
            before |= 1 << FILTERS.index(name)
        out.append(("".join(order), steps))
    return out


def shapley_weights() -> list[tuple[int, int, int]]:
    """(filter, filters before as bits, in how many orders exactly these come before it)."""
    seen: dict[tuple[int, int], int] = {}
    for _, steps in orders():
        for _, _, before, number in steps:
            seen[number, before] = seen.get((number, before), 0) + 1
    return [(number, before, n) for (number, before), n in sorted(seen.items())]


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; ``failed`` as from ``failures``."""
    is_set = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_set("quality").alias("_good"), is_set("toxic").alias("_toxic"))
    marked = failed.join(known, "doc_id", "left").select("part", "fails", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("_good", "_toxic")])
    sums = [F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good"), F.sum("_toxic").alias("toxic")]
    cells = cut_lineage(marked.groupBy("part", "fails").agg(*sums), "audit-cells")  # at most 32 rows a part

    # What is left of a part after each of the 32 sets of filters.
    sets = cells.select("*", F.explode(F.array(*[F.lit(s) for s in range(ALL + 1)])).alias("applied"))
    passes = F.col("fails").bitwiseAND(F.col("applied")) == 0
    left = [F.sum(F.when(passes, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    by_set = sets.groupBy("part", "applied").agg(*left).groupBy("part").agg(F.sort_array(F.collect_list(F.struct("applied", "n", "good", "toxic"))).alias("left"))

    def at(applied: Column | int, what: str) -> Column:
        place = applied if isinstance(applied, Column) else F.lit(applied)
        return F.get("left", place)[what]

    shapley = {}
    for number, before, n in shapley_weights():
        term = F.lit(n) * (at(before, "n") - at(before | 1 << number, "n"))
        shapley[number] = shapley[number] + term if number in shapley else term
    by_set = by_set.select("*", F.array(*[shapley[i] for i in range(len(FILTERS))]).alias("shapley"))
    step = lambda s: F.struct(F.lit(s[0]).alias("step"), F.lit(s[2]).alias("before"), F.lit(s[3]).alias("number"))
    plan = [F.struct(F.lit(o).alias("filter_order"), F.array(*[step(s) for s in steps]).alias("steps")) for o, steps in orders()]
    rows = by_set.select("*", F.explode(F.array(*plan)).alias("_o")).select("*", "_o.filter_order", F.explode("_o.steps").alias("_s"))
    rows = rows.select("*", F.col("_s.before").alias("_before"), F.expr("shiftleft(1, _s.number)").alias("_own"))
    before, after, own = F.col("_before"), F.col("_before").bitwiseOR(F.col("_own")), F.col("_own")
    gone = lambda what: at(before, what) - at(after, what)
    return rows.select(
        "part",
        "filter_order",
        F.col("_s.step").alias("step"),
        at(after, "n").alias("kept"),
        gone("n").alias("removed"),
        (at(0, "n") - at(own, "n") - gone("n")).alias("redundant"),
        (at(F.lit(ALL).bitwiseXOR(own), "n") - at(ALL, "n")).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("_s.number")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return interactions(failures(docs), labels)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, 'A' AS x,
             list_filter(['A', 'B', 'C', 'D', 'E'], lambda c: CASE c
               WHEN 'A' THEN len(w) < 200
               WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
               WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t)
               WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
               ELSE first IS NOT NULL AND (doc_id IS NULL OR doc_id > first) END) AS fails
      FROM m LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, string_split(left(filter_order, step - 1), '') AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, own,
             sum(n * (NOT list_has_any(fails, before) AND NOT list_contains(fails, own))::INT) AS kept,
             sum(n * (NOT list_has_any(fails, before) AND list_contains(fails, own))::INT) AS removed,
             sum(n * (list_has_any(fails, before) AND list_contains(fails, own))::INT) AS redundant,
             sum(n * (fails = [own])::INT) AS unique_fails,
             sum(good * (NOT list_has_any(fails, before) AND list_contains(fails, own))::INT) AS good_lost,
             sum(toxic * (NOT list_has_any(fails, before) AND list_contains(fails, own))::INT) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
