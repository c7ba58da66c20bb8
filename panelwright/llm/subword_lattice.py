"""Subword lattice likelihood: the probability of a text over all segmentations of its words.

A vocabulary that exists already (the pieces of a public tokenizer) gets unigram scores from the training documents: how
often each piece occurs when the tokenizer splits all distinct training words. A word counts once, since the pieces serve
to write words that were not seen, which are like rare words. Words seen in training are entries of the lattice too. A word's probability is the sum over every way to write it as entries,

    P(word) = (1 - novel) c / N  +  novel * (sum over segmentations of the product of the piece probabilities) * P(end of word)

with ``novel`` the share of training tokens that occur once (the mass Good and Turing give to what was not seen). The sum
over segmentations is a forward recursion over the bytes of the word in log space; single bytes are pieces, so any word
can be written. A text is its words and one end token; its log10 probability is the sum over them.

Counting and scoring go by blocks of documents of about ``block_chars`` characters. Each block sends its distinct words
with their training counts; the counts of a word are added up over all blocks, its lattice is summed once, and counts and
probability go back to the blocks that asked. A frequent word is one row per block, not one per occurrence. The piece
counts, one number per piece of the vocabulary, are all that reaches the driver.

Documents whose crc32 of ``doc_id`` as text is divisible by ``folds`` are held out. NULL texts count as empty and consist
of the end token; a NULL ``doc_id`` counts as the empty text (held out). Repeated rows count each. Without any training
document all counts are zero, ``base_score`` follows its formula and ``novel`` is 1. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import text_or_empty
from panelwright.llm.encoding import byte_symbols, default_path, encoder
from panelwright.session import cut_lineage

FOLDS = 10
BLOCK_CHARS = 8_000_000
ADDED = 0.1


def vocabulary(tokenizer_path: str) -> dict[bytes, int]:
    """The pieces of a byte-level vocabulary as bytes, with their numbers."""
    from tokenizers import Tokenizer

    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    pieces = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=False)
    return {bytes(byte_of[c] for c in p): i for p, i in pieces.items() if p and all(c in byte_of for c in p)}


class Lattice:
    """Sums over all segmentations of a word into pieces of the vocabulary."""

    def __init__(self, scores: dict[bytes, float]):
        """``scores``: natural logarithms of the piece probabilities."""
        self.scores = scores
        self.prefixes = {p[:k] for p in self.scores for k in range(1, len(p) + 1)}

    def log_probability(self, word: bytes) -> float:
        """The forward recursion: the logarithm of the sum over segmentations."""
        n, scores, prefixes = len(word), self.scores, self.prefixes
        exp, log1p = math.exp, math.log1p
        low = -math.inf
        forward = [low] * (n + 1)
        forward[0] = 0.0
        for i in range(n):
            here = forward[i]
            for j in range(i + 1, n + 1):
                part = word[i:j]
                if part not in prefixes:
                    break
                s = scores.get(part)
                if s is not None:
                    a, b = forward[j], here + s
                    if a == low:
                        forward[j] = b
                    elif a > b:
                        forward[j] = a + log1p(exp(b - a))
                    else:
                        forward[j] = b + log1p(exp(a - b))
        return forward[n]


def blocked(docs: DataFrame, folds: int, block_chars: int) -> DataFrame:
    """(block, doc_id, text, held_out)."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0
    own = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), held.alias("held_out"))
    return own.select(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int").alias("block"), "*")


def block_words(docs: DataFrame) -> DataFrame:
    """(block, word, c): the distinct words of each block with their training counts; the end token is the empty word."""
    schema = pa.schema([("block", pa.int32()), ("word", pa.binary()), ("c", pa.int64())])

    def count(key, batches):
        counts: dict[bytes, int] = {b"": 0}
        for batch in batches:
            for text, held in zip(batch.column("text"), batch.column("held_out").to_pylist(), strict=True):
                words = text.as_py().encode().lower().split()
                if held:
                    for w in words:
                        counts.setdefault(w, 0)
                else:
                    words.append(b"")
                    for w in words:
                        counts[w] = counts.get(w, 0) + 1
        block = key[0].as_py()
        words = list(counts)
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int32()), pa.array(part, pa.binary()), pa.array([counts[w] for w in part], pa.int64())], schema=schema)

    return docs.select("block", "text", "held_out").groupBy("block").applyInArrow(streamed(count), "block int, word binary, c long")


def streamed(per_group):
    """A grouped Arrow function that takes its group as batches and returns batches."""

    def run(key, batches):
        yield from per_group(key, batches)

    from collections.abc import Iterator

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def piece_scores(words: DataFrame, tokenizer_path: str) -> tuple[dict[bytes, float], float]:
    """Logarithms of the piece probabilities and of the end of a word, from the distinct ``words``."""
    pieces = vocabulary(tokenizer_path)
    size = max(pieces.values(), default=0) + 1
    schema = pa.schema([("piece", pa.int32()), ("n", pa.int64())])

    def split(batches):
        known = encoder(tokenizer_path, False).first
        total = np.zeros(size, dtype=np.int64)
        ends = 0
        for batch in batches:
            ids = b"".join(known[w] for w in batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(ids, dtype="<u4"), minlength=size)[:size]
            ends += batch.num_rows
            known.clear()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int32()), pa.array([*total[at], ends], pa.int64())], schema=schema)

    counted = words.where("c > 0 and word <> X''").select("word").mapInArrow(split, "piece int, n long")
    n = {r["piece"]: r["n"] for r in counted.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    whole = sum(n.values()) + ADDED * (len(pieces) + 1)
    log = lambda i: math.log((n.get(i, 0) + ADDED) / whole)
    return {p: log(i) for p, i in pieces.items()}, log(-1)


def score_documents(docs: DataFrame, tokenizer_path: str | None = None, folds: int = FOLDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    path = tokenizer_path or default_path("byte_bpe_50k.json")
    own = blocked(docs, folds, block_chars)
    same = Window.partitionBy("word")
    added = block_words(own).select("block", "word", F.sum("c").over(same).alias("c"), (F.row_number().over(same.orderBy("block")) == 1).alias("first"))
    words = cut_lineage(added, "lattice-words")
    one = F.when(F.col("first"), F.col("c"))
    total, distinct, single = words.agg(F.sum(one), F.sum((one > 0).cast("int")), F.sum((one == 1).cast("int"))).first()
    total, distinct, single = total or 0, distinct or 0, single or 0
    scores, end = piece_scores(words.where("first"), path)
    novel = min(1.0, (single + 1) / (total + 1))
    known_share = (1 - novel) / max(total, 1)
    weighed = pa.schema([("block", pa.int32()), ("word", pa.binary()), ("c", pa.int64()), ("p", pa.float64())])

    def weigh(batches):
        lattice = Lattice(scores)
        last, p = None, 0.0
        for batch in batches:
            out = []
            for word, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if word != last:  # the rows of a word lie together
                    spelled = math.log(novel) + lattice.log_probability(word) + end if word else math.log(novel) + end
                    seen = math.log(known_share * c) if c and known_share > 0 else -math.inf
                    high = max(spelled, seen)
                    last, p = word, (high + math.log(math.exp(spelled - high) + math.exp(seen - high))) / math.log(10)
                out.append(p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.float64())], schema=weighed)

    asked = words.select("block", "word", "c").mapInArrow(weigh, "block int, word binary, c long, p double")
    floor = total + ADDED * (distinct + 1)
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(texts: pa.Table, table: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(table.column("word").to_pylist())}
        counts = table.column("c").to_numpy()
        base, own_p = np.log10((counts + ADDED) / floor), table.column("p").to_numpy()
        rows = []
        for doc_id, text, held in zip(texts.column("doc_id").to_pylist(), texts.column("text"), texts.column("held_out").to_pylist(), strict=True):
            found = text.as_py().encode().lower().split()
            found.append(b"")
            at = np.fromiter(map(place.__getitem__, found), dtype=np.int64, count=len(found))
            rows.append((doc_id, held, len(at), int((counts[at] > 0).sum()), total, float(base[at].sum()), float(own_p[at].sum())))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out) if rows else out.empty_table()

    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return own.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(score, ddl)


def query(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
