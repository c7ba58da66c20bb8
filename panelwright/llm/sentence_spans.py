"""Repeated passages by sliding sentence spans.

A sentence ends after ``.``, ``!``, ``?`` or a line feed and the white space behind; the sentences of a text make up the
whole text. Two sentences are equal without regard to white space and to upper-case ASCII letters. Every run of ``span``
consecutive sentences is hashed (128 bits; a text with fewer sentences is one run). Long sentences make a passage before
there are ``span`` of them, so from each sentence on the shortest run of ``least_words`` words is hashed too, if it has
fewer sentences. The runs of all documents are joined by their hash, and a sentence is removed if any run that covers it
also starts earlier: in a document with a smaller ``doc_id``, or further ahead in the same document.

The runs are found in one pass and written. The first place of each run is an aggregate with partial sums; all runs are
then joined to the runs that repeat, a join that Spark splits where one run is very frequent. Positions come together per
document only. Runs, and what was shuffled to compare them, are deleted before the texts are shuffled, which happens once.

NULL texts count as empty and have no sentences. A NULL ``doc_id`` comes after all others. Of rows with the same
``doc_id`` those with other texts are ordered by a hash of the text; of equal rows one counts as the first, and the
others as its repetitions. Extra columns are ignored by ``repeated_sentences`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import WHITE, matched, text_or_empty, whole_row
from panelwright.session import cut_lineage, discard

SPAN = 3
LEAST_WORDS = 20
SENTENCE = r"[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+"
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
KEY = ["doc_id", "_text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(whole_row(docs), "doc_id", text_or_empty().alias("_text")).withColumn("_text_hash", F.xxhash64("_text"))


def runs_of(text: str, span: int, least_words: int) -> list[tuple[bytes, int, int]]:
    """(hash, first sentence, number of sentences) of every run of a text."""
    raw = [p.encode() for p in re.findall(SENTENCE, text)]
    names = [xxhash.xxh3_128_digest(p.translate(PLAIN, WHITE.encode())) for p in raw]
    runs = [(i, min(span, len(raw))) for i in range(max(len(raw) - span + 1, 1))] if raw else []
    words = [len(p.split()) for p in raw]  # bytes are split at ASCII white space only
    for i in range(len(raw)):
        found = 0
        for n in range(1, min(span - 1, len(raw) - i) + 1):
            found += words[i + n - 1]
            if found >= least_words:
                runs.append((i, n))
                break
    return [(xxhash.xxh3_128_digest(b"".join(names[i : i + n])), i, n) for i, n in runs]


def spans(docs: DataFrame, span: int = SPAN, least_words: int = LEAST_WORDS) -> DataFrame:
    """(h1, h2, doc_id, _text_hash, pos, n): every run of sentences."""
    schema = pa.schema([(c, pa.int64()) for c in ("h1", "h2", *KEY)] + [("pos", pa.int32()), ("n", pa.int32())])

    def find(batches):
        for batch in batches:
            names, rows, pos, size = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                for name, i, n in runs_of(text.as_py(), span, least_words):
                    names.append(name), rows.append(row), pos.append(i), size.append(n)
                if len(names) >= 200_000:
                    yield table(batch, names, rows, pos, size)
                    names, rows, pos, size = [], [], [], []
            if names:
                yield table(batch, names, rows, pos, size)

    def table(batch, names, rows, pos, size):
        halves = np.frombuffer(b"".join(names), dtype=np.int64).reshape(-1, 2)
        own = [batch.column(i).take(pa.array(rows, pa.int64())) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), *own, pa.array(pos, pa.int32()), pa.array(size, pa.int32())], schema=schema)

    own = _keyed(docs).select(F.col("doc_id").cast("long"), "_text_hash", "_text")
    return own.mapInArrow(find, "h1 long, h2 long, doc_id long, _text_hash long, pos int, n int")


def repeated_starts(docs: DataFrame, span: int = SPAN, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, _text_hash, starts): where in a document runs start (and their sentences) that also start earlier elsewhere or further ahead; a written table."""
    found = cut_lineage(spans(docs, span, least_words), "spans-runs")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_text_hash", "pos")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = cut_lineage(first.where("_n > 1").select("h1", "h2", "_first"), "spans-repeated", release=True)
    later = found.join(first, ["h1", "h2"]).where(~F.col("_first").eqNullSafe(place))
    starts = cut_lineage(later.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "n")).alias("starts")), "spans-starts", release=True)
    discard(found, first)
    return starts


def _marked(docs: DataFrame, span: int, least_words: int) -> DataFrame:
    """``docs`` with ``_text``, the ``starts`` of repeated runs and whether the row repeats one of the same ``doc_id``."""
    # Without NULLs, so that window and join deal out the texts alike, and only once.
    whole = ["_id", "_none", "_text_hash"]
    key = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull()}
    starts = repeated_starts(docs, span, least_words).withColumns(key).drop("doc_id")
    same = Window.partitionBy(*whole).orderBy("_text_hash")
    rows = _keyed(docs).withColumns(key).withColumn("_again", F.row_number().over(same) > 1)
    return rows.join(starts, whole, "left")


def _kept(text: str, starts, again: bool) -> tuple[list[str], int]:
    """The sentences that stay, and how many there were."""
    pieces = re.findall(SENTENCE, text)
    gone = np.full(len(pieces), again)
    for run in starts or ():
        gone[run["pos"] : run["pos"] + run["n"]] = True
    return [p for p, g in zip(pieces, gone, strict=True) if not g], len(pieces)


def repeated_sentences(docs: DataFrame, span: int = SPAN, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_sentences, n_removed, kept_sha256) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def digest(batches):
        for batch in batches:
            rows = []
            for doc_id, text, starts, again in zip(*(c if i == 1 else c.to_pylist() for i, c in enumerate(batch.columns)), strict=True):
                kept, n = _kept(text.as_py(), starts, again)
                rows.append((doc_id, n, n - len(kept), hashlib.sha256("".join(kept).encode()).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows = _marked(docs, span, least_words).select(F.col("doc_id").cast("long"), "_text", "starts", "_again")
    return rows.mapInArrow(digest, "doc_id long, n_sentences long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, span: int = SPAN, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with their repeated sentences taken out of ``text``; all other columns as they are."""
    rows = _marked(docs, span, least_words).select("_row", "_text", "starts", "_again")

    def cut(batches):
        for batch in batches:
            row, text, starts, again = batch.columns
            kept = ["".join(_kept(t.as_py(), s, a)[0]) for t, s, a in zip(text, starts.to_pylist(), again.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([row, pa.array(kept, pa.string())], names=["_row", "_kept"])

    schema = T.StructType([rows.schema["_row"], T.StructField("_kept", T.StringType())])
    return rows.mapInArrow(cut, schema).select(F.col("_row").withField("text", F.col("_kept")).alias("_row")).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return repeated_sentences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH p AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+') AS s FROM documents),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS piece, unnest(range(1, len(s) + 1)) AS j FROM p),
k AS (SELECT *, translate(regexp_replace(piece, '[\x20\x09-\x0D]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k,
             len(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')) AS words FROM x),
l AS (SELECT *, lead(k, 1) OVER w AS k1, lead(k, 2) OVER w AS k2, lead(words, 1) OVER w AS words1 FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
r AS (SELECT doc_id, j, least(n, 3) AS size, k || coalesce(chr(10) || k1, '') || coalesce(chr(10) || k2, '') AS run FROM l WHERE j <= greatest(n - 2, 1)
      UNION SELECT doc_id, j, 1 AS size, k AS run FROM l WHERE words >= 20
      UNION SELECT doc_id, j, 2 AS size, k || chr(10) || k1 AS run FROM l WHERE words < 20 AND words + words1 >= 20),
f AS (SELECT doc_id, j, size, row_number() OVER (PARTITION BY run ORDER BY doc_id, j) > 1 AS again FROM r),
c AS (SELECT k.doc_id, k.j, k.piece, coalesce(bool_or(f.again), false) AS gone
      FROM k LEFT JOIN f ON f.doc_id = k.doc_id AND f.j BETWEEN k.j - 2 AND k.j AND k.j < f.j + f.size GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (gone) AS n_removed, string_agg(piece, '' ORDER BY j) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM p LEFT JOIN g USING (doc_id)
"""
