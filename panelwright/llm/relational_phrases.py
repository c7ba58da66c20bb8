"""Phrase collocations by relational mining: occurrence relations are joined, counted and thinned length by length.

A text (ASCII letters lower-cased) is cut at ``.,;:!?`` and line ends into pieces, a piece at blanks and tabs into words.
The occurrence relation of length k has a row (piece, position, group) for every place of a phrase of k words that
occurs ``least`` times or more in its language. From one length to the next:

* *merge-join*: the relation, sorted by piece and position, is joined with itself at adjacent positions, so both the
  first and the last k words of a new phrase are frequent;
* *group-count*: the counts of (first group, last group) are added up over all chunks;
* *semi-join*: only the occurrences of frequent groups are written as the next relation. The sums go back to the chunks in
  the same exchange, by a window over each group's rows, so that counting and thinning shuffle the groups once.

The relation is stored by chunks: the places of about ``CHUNK_WORDS`` words of one language as two sorted arrays, in which
places of one piece are consecutive numbers and a new piece leaves a gap; both are written compressed, the places as their
differences. A piece is never cut. What was shuffled for a length is deleted once its relation is written. Spark joins, shuffles and
counts one row per chunk and group, so a phrase that is everywhere costs a row a chunk, not a row an occurrence. Groups are
named by a number in the first chunk that has them, not by hashes: two phrases are never confused.

A phrase of k words has k - 1 cuts; its score is that of the lowest one, floor(1000 * a * n / (l * r)) in exact decimals.
A phrase goes if a phrase one word longer that contains it occurs ``share`` per cent as often: any still longer one that
does has one of these between.

NULL texts count as empty, a NULL language is ``und``; extra columns are ignored, repeated rows count each. Ties are broken
by score, count and the phrase's bytes, so the order is total. An empty table, or one without frequent phrases, gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import text_or_empty
from panelwright.session import cut_lineage, discard

LEAST, LONGEST, SHARE, TOP = 100, 5, 100, 2000
CHUNK_WORDS = 1_000_000
SLICE_BYTES = 1 << 20
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(UPPER + PIECE_ENDS + b"\t", LOWER + b"." * len(PIECE_ENDS) + b" ")
RELATION = "chunk long, places binary, groups binary"


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    return _codec()[0].compress(np.ascontiguousarray(values).tobytes())


def unpack(packed: pa.BinaryScalar, kind) -> np.ndarray:
    return np.frombuffer(_codec()[1].decompress(packed.as_py()), dtype=kind)


# --- occurrences of single words -------------------------------------------------------------------------------------


class Codes(dict):
    """Numbers for words in the order of their first use; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class Chunk:
    def __init__(self):
        self.codes, self.parts, self.size = Codes(), [], 0

    def add(self, raw: bytes) -> None:
        words = raw.replace(b".", b" . ").split()
        if words:
            self.parts.append(np.fromiter(map(self.codes.__getitem__, words), dtype=np.int32, count=len(words)))
            self.size += len(words)


def slices(raw: bytes, size: int):
    """(part, whether a piece ends behind it): parts of about ``size`` bytes, cut at ends of pieces or else at blanks."""
    at = 0
    while at < len(raw):
        end = at + size
        if end < len(raw):
            cut = raw.rfind(b".", at, end) + 1 or raw.rfind(b" ", at, end) + 1
            if not cut:
                later = [x for x in (raw.find(b".", end), raw.find(b" ", end)) if x >= 0]
                cut = min(later) + 1 if later else len(raw)
            end = cut
        part = raw[at:end]
        yield part, end >= len(raw) or part.endswith(b".")
        at = end


def chunks(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(chunk, lang, n, codes, words): words as numbers into the chunk's own word list, 0 where a piece ends."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("codes", pa.binary()), ("words", pa.binary())])

    def cut(batches):
        task, made, open_ = TaskContext.get().partitionId(), 0, {}

        def flush(lang):
            nonlocal made
            own = open_.pop(lang)
            made += 1
            codes = np.concatenate(own.parts)
            row = [(task << 16) + made], [lang], [int((codes > 0).sum())], [pack(codes)], [b"\n".join(own.codes)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part, whole in slices(text.as_py().encode().translate(PLAIN), SLICE_BYTES):
                    own = open_.setdefault(lang, Chunk())
                    own.add(part + b"." if whole else part)
                    if whole and own.size >= chunk_words:
                        yield flush(lang)
            while sum(c.size for c in open_.values()) > 4 * chunk_words:
                yield flush(max(open_, key=lambda x: open_[x].size))
        for lang in list(open_):
            if open_[lang].parts:
                yield flush(lang)

    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    return own.mapInArrow(cut, "chunk long, lang string, n long, codes binary, words binary")


def word_counts(chunked: DataFrame) -> DataFrame:
    """(chunk, lang, word, code, n) of every different word of a chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("code", pa.int32()), ("n", pa.int64())])

    def count(batches):
        for batch in batches:
            for chunk, lang, codes, words in zip(*(batch.column(i) for i in range(4)), strict=True):
                n = np.bincount(unpack(codes, np.int32))
                names = pa.array(words.as_py().split(b"\n"), pa.binary()).cast(pa.string())[1 : len(n)]
                if len(names):
                    k = len(names)
                    columns = [pa.repeat(chunk, k), pa.repeat(lang, k), names, pa.array(np.arange(1, k + 1), pa.int32()), pa.array(n[1:])]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return chunked.select("chunk", "lang", "codes", "words").mapInArrow(count, "chunk long, lang string, word string, code int, n long")


# --- relations ---------------------------------------------------------------------------------------------------------


def _relation(chunk: int, places: np.ndarray, groups: np.ndarray) -> pa.Table:
    rows = [(chunk, pack(np.diff(places.astype(np.int32), prepend=np.int32(0))), pack(groups.astype(np.int64)))] if len(places) else []
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "places", "groups"])


def _occurrences(places: pa.BinaryScalar, groups: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(places, np.int32), dtype=np.int32), unpack(groups, np.int64)


def single_words(chunked: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of frequent words; ``frequent``: (chunk, code, id)."""

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _relation(0, np.zeros(0), np.zeros(0))
        codes = unpack(left.column("codes")[0], np.int32)
        name = np.full(int(codes.max()) + 1, -1, dtype=np.int64)
        name[right.column("code").to_numpy()] = right.column("id").to_numpy()
        groups = name[codes]
        places = np.flatnonzero(groups >= 0)
        return _relation(left.column("chunk")[0].as_py(), places, groups[places])

    return chunked.select("chunk", "codes").groupBy("chunk").cogroup(frequent.groupBy("chunk")).applyInArrow(keep, RELATION)


def merge_join(places: np.ndarray, groups: np.ndarray):
    """The relation joined with itself at adjacent places: (index of the left rows, distinct left groups, distinct right
    groups, which of the distinct pairs each joined row has)."""
    at = np.flatnonzero(places[1:] == places[:-1] + 1)
    names, own = np.unique(groups, return_inverse=True)
    pairs, which = np.unique(own[at] * np.int64(max(len(names), 1)) + own[at + 1], return_inverse=True)
    return at, names[pairs // max(len(names), 1)], names[pairs % max(len(names), 1)], which


def pair_counts(relation: DataFrame) -> DataFrame:
    """(chunk, u, v, code, n): how often group v follows group u in a chunk, one place later; ``code`` numbers its pairs."""
    schema = pa.schema([("chunk", pa.int64()), ("u", pa.int64()), ("v", pa.int64()), ("code", pa.int32()), ("n", pa.int64())])

    def count(batches):
        for batch in batches:
            for chunk, places, groups in zip(*batch.columns, strict=True):
                _, u, v, which = merge_join(*_occurrences(places, groups))
                if len(u):
                    n = np.bincount(which, minlength=len(u)).astype(np.int64)
                    codes = pa.array(np.arange(len(u)), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.repeat(chunk, len(u)), pa.array(u), pa.array(v), codes, pa.array(n)], schema=schema)

    return relation.select("chunk", "places", "groups").mapInArrow(count, "chunk long, u long, v long, code int, n long")


def longer(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of phrases one word longer; ``frequent``: (chunk, code, id)."""

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _relation(0, np.zeros(0), np.zeros(0))
        places, groups = _occurrences(left.column("places")[0], left.column("groups")[0])
        at, u, _, which = merge_join(places, groups)
        name = np.full(len(u), -1, dtype=np.int64)
        name[right.column("code").to_numpy()] = right.column("id").to_numpy()
        found = name[which]
        stay = found >= 0
        return _relation(left.column("chunk")[0].as_py(), places[at][stay], found[stay])

    return relation.groupBy("chunk").cogroup(frequent.groupBy("chunk")).applyInArrow(keep, RELATION)


def _frequent(counted: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """(chunk, keys, code, a, id): the rows of groups that occur often enough; written."""
    group = Window.partitionBy(*keys)
    own = F.shiftleft("chunk", 24) + F.col("code")
    sums = counted.select("chunk", *keys, "code", F.sum("n").over(group).alias("a"), F.min(own).over(group).alias("id"))
    return cut_lineage(sums.where(F.col("a") >= least), name, release=True)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, a) of all phrases up to ``longest`` words that occur ``least`` times, (lang, n) of all languages)."""
    chunked = cut_lineage(chunks(docs, chunk_words), "phrases-chunks")
    totals = cut_lineage(chunked.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals", release=True)
    found = _frequent(word_counts(chunked), ["lang", "word"], least, "phrases-1")
    relation = cut_lineage(single_words(chunked, found.select("chunk", "code", "id")), "phrases-relation", release=True)
    discard(chunked)
    named = found.groupBy("id", "lang", F.col("word").alias("phrase"), "a").agg(F.count(F.lit(1)).alias("_")).drop("_")
    phrases = cut_lineage(named, "phrases-named", release=True)
    discard(found)
    out = phrases.select("lang", F.lit(1).alias("k"), "phrase", "a")
    for k in range(2, longest + 1):
        found = _frequent(pair_counts(relation), ["u", "v"], least, f"phrases-{k}")
        if found.isEmpty():
            break
        if k < longest:
            shorter, relation = relation, cut_lineage(longer(relation, found.select("chunk", "code", "id")), "phrases-relation", release=True)
            discard(shorter)
        left = phrases.select(F.col("id").alias("u"), "lang", F.substring_index("phrase", " ", 1).alias("_first"))
        right = phrases.select(F.col("id").alias("v"), F.col("phrase").alias("_rest"))
        groups = found.groupBy("u", "v", "a", "id").agg(F.count(F.lit(1)).alias("_"))
        named = groups.join(left, "u").join(right, "v").select("lang", F.concat_ws(" ", "_first", "_rest").alias("phrase"), "a", "id")
        phrases = cut_lineage(named, "phrases-named", release=True)
        discard(found)
        out = out.unionByName(phrases.select("lang", F.lit(k).alias("k"), "phrase", "a"))
    discard(relation)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int | None = TOP, **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two words or more."""
    counts, totals = frequent_phrases(docs, least, longest, **sizes)
    counts = cut_lineage(counts, "phrases-counts")
    found = counts.where("k > 1")
    cuts = found.join(totals, "lang").select("lang", "k", "phrase", "a", "n", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', j)").alias("_head"), F.expr("substring_index(phrase, ' ', j - k)").alias("_tail"))
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = cuts.join(of("_head", "l"), ["lang", "_head"]).join(of("_tail", "r"), ["lang", "_tail"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.select("*", (F.lit(1000) * wide("a") * wide("n")).alias("_over"), (wide("l") * wide("r")).alias("_under"))
    scored = cuts.groupBy("lang", "k", "phrase", "a", "n").agg(F.min(F.struct(F.expr("_over div _under").alias("score"), "j", "l", "r")).alias("_cut"))
    parts = F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))
    within = found.where("k > 2").select("lang", "a", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.phrase, c.a, c.j, x.a AS l, y.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a) AS score
      FROM c JOIN n USING (lang)
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.j], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s),
d AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN f ON f.lang = b.lang AND f.k > b.k AND 100 * f.a >= 100 * b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
      FROM b ANTI JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM t WHERE rank <= 2000
"""
