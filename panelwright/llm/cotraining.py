"""Quality classifier by co-training two views of a document.

The text view sees hashed words and the shape of the text (shares of capitals, marks, digits, repeated lines, ...). The
metadata view sees language, source and the stated number of characters. Each view has a logistic regression, fitted on
labelled documents; in every round each view labels the unlabelled documents it is surest of, and they join the training
rows of the other view. Afterwards a third regression on held-back labelled documents calibrates both views' scores
and combines them, so a view that says little weighs little. A document is rejected when its combined probability of
good quality is below ``threshold``.

The models are fitted on bounded samples, chosen by a hash: ``labelled_rows`` labelled documents and ``pool_rows``
unlabelled ones, at most, each with all its hashed words, of which there are ``2**WORD_BITS`` at most. All documents are
scored on whole texts. Scores do not depend on how rows are spread over tasks.

NULL texts count as empty; NULL languages, sources or lengths are values of their own. Labels with a NULL ``quality`` or
``doc_id`` are ignored, of several labels of a document the lowest counts. With labels of one class only, every document
gets that class; without labels, all are kept. Rows that repeat get the same score. Extra columns are ignored by
``quality_scores`` and kept by ``good_documents``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import text_or_empty
from panelwright.session import cut_lineage

WORD_BITS = 14
META_BITS = 10
LABELLED_ROWS = 8_000
POOL_ROWS = 4_000
ROUNDS = 3
EXCHANGED = 200
CONFIDENT = 0.95
THRESHOLD = 0.5
SHAPE = 12
MARKS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def text_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, weights, shape): hashed words with their damped counts, and numbers that describe the text's form."""
    raw = text.encode()
    chars = np.frombuffer(raw, dtype=np.uint8)
    n = max(len(raw), 1)
    words = raw.lower().split()
    n_words = max(len(words), 1)
    counts = np.bincount(chars, minlength=256)
    marks = int(counts[[*MARKS]].sum())
    lines = text.split("\n")
    ends_in_marks = sum(1 for w in words if len(w) > 2 and w[-1] in MARKS and w[-2] in MARKS)
    shape = np.array(
        [
            counts[65:91].sum() / n, marks / n, counts[48:58].sum() / n, counts[33] / n, counts[124] / n,
            (counts[[35, 36, 37, 38, 42]].sum()) / n, (counts[[46, 44]].sum()) / n_words, len(raw) / n_words / 10,
            ends_in_marks / n_words, 1 - len(set(lines)) / len(lines), 1 - len(set(words)) / n_words, math.log1p(n_words) / 10,
        ],
        dtype=np.float64,
    )
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0), shape
    hashed = np.fromiter(map(xxhash.xxh32_intdigest, words), dtype=np.int64, count=len(words)) & ((1 << WORD_BITS) - 1)
    index, times = np.unique(hashed, return_counts=True)
    weight = np.log1p(times)
    return index, weight / np.sqrt((weight**2).sum()), shape


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed indices of language, source, both together, and the magnitude of the length."""
    size = "none" if n_chars is None else str(int(math.log2(max(n_chars, 1)) * 2))
    keys = (f"l:{lang}", f"s:{source}", f"b:{lang}:{source}", f"n:{size}", f"m:{lang}:{size}")
    return np.array([xxhash.xxh32_intdigest(k) & ((1 << META_BITS) - 1) for k in keys], dtype=np.int64)


class Rows:
    """Sparse rows, with an intercept and dense columns behind the hashed ones."""

    def __init__(self, index: list[np.ndarray], weight: list[np.ndarray], dense: np.ndarray, width: int):
        self.width = width + dense.shape[1] + 1
        n, d = dense.shape
        tail = np.broadcast_to(np.arange(width, width + d + 1), (n, d + 1))
        self.index = np.concatenate([np.concatenate([i, t]) for i, t in zip(index, tail, strict=True)]) if n else np.zeros(0, dtype=np.int64)
        self.weight = np.concatenate([np.concatenate([w, x, [1.0]]) for w, x in zip(weight, dense, strict=True)]) if n else np.zeros(0)
        self.ends = np.cumsum([len(i) + d + 1 for i in index]) if n else np.zeros(0, dtype=np.int64)
        self.row = np.repeat(np.arange(n), np.diff(np.concatenate([[0], self.ends])).astype(np.int64)) if n else np.zeros(0, dtype=np.int64)
        self.n = n

    def scores(self, model: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.weight * model[self.index], minlength=self.n)

    def gradient(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=self.weight * residual[self.row], minlength=self.width)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: Rows, y: np.ndarray, weight: np.ndarray, steps: int = 120, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by full-batch Adam: deterministic, the same on every run."""
    model, m, v = np.zeros(rows.width), np.zeros(rows.width), np.zeros(rows.width)
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        g = rows.gradient(weight * (sigmoid(rows.scores(model)) - y)) / total + decay * model
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        model -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return model


def co_train(text: Rows, meta: Rows, quality: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The models of both views and of their combination. ``quality``: 1, 0 or -1 for unlabelled; ``fold`` 0 calibrates."""
    known, calibrate = (quality >= 0) & (fold > 0), (quality >= 0) & (fold == 0)
    if not calibrate.any() or not known.any():
        known = calibrate = quality >= 0
    labels = {"text": np.where(known, quality, -1), "meta": np.where(known, quality, -1)}
    views = {"text": text, "meta": meta}
    models: dict[str, np.ndarray] = {}
    for turn in range(rounds + 1):
        for name, rows in views.items():
            has = labels[name] >= 0
            models[name] = fit(rows, np.clip(labels[name], 0, 1).astype(float), np.where(quality >= 0, 1.0, 0.5) * has)
        if turn == rounds:
            break
        for name, other in (("text", "meta"), ("meta", "text")):
            sure = sigmoid(views[name].scores(models[name]))
            free = (quality < 0) & (labels[other] < 0)
            for value, certainty in ((1, sure), (0, 1 - sure)):
                order = np.argsort(-certainty, kind="stable")
                taken = order[(free & (certainty >= CONFIDENT))[order]][:EXCHANGED]
                labels[other][taken] = value
    both = np.stack([views[n].scores(models[n]) for n in ("text", "meta")], axis=1)
    pair = Rows([np.zeros(0, dtype=np.int64)] * len(both), [np.zeros(0)] * len(both), both, 0)
    models["both"] = fit(pair, np.clip(quality, 0, 1).astype(float), calibrate.astype(float), steps=400, rate=0.1, decay=1e-3)
    return models


def _sample(docs: DataFrame, labels: DataFrame, target: str, labelled_rows: int, pool_rows: int) -> DataFrame:
    """Bounded samples of labelled and unlabelled documents, smallest hashes first."""
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(target).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    every = labels.select("doc_id").where("doc_id is not null").distinct()
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    pool = ids.join(every, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool_rows).withColumn("_y", F.lit(-1))
    chosen = cut_lineage(known.unionByName(pool).withColumn("_fold", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4))), "quality-sample")
    return docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS) -> dict[str, np.ndarray] | float:
    """The models, or one probability for all documents where the labels have less than two classes."""
    own = _sample(docs, labels, target, labelled_rows, pool_rows)
    own = own.select("doc_id", text_or_empty().alias("text"), "lang", "source", F.col("n_chars").cast("long"), "_y", F.col("_fold").cast("int"))

    def features(batches):
        for batch in batches:
            out = []
            for doc_id, text, lang, source, n_chars, y, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index, weight, shape = text_features(text)
                out.append((doc_id, y, fold, index.astype(np.int32).tobytes(), weight.astype(np.float32).tobytes(), shape.tobytes(), meta_features(lang, source, n_chars).tobytes()))
            names = ["doc_id", "y", "fold", "i", "w", "shape", "meta"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    made = cut_lineage(own.mapInArrow(features, "doc_id long, y int, fold int, i binary, w binary, shape binary, meta binary"), "quality-features")
    classes = {r["y"] for r in made.where("y >= 0").select("y").distinct().collect()}
    if len(classes) < 2:
        return float(next(iter(classes), 1))

    def learn(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: r["doc_id"])
        index = [np.frombuffer(r["i"], dtype=np.int32).astype(np.int64) for r in rows]
        weight = [np.frombuffer(r["w"], dtype=np.float32).astype(np.float64) for r in rows]
        shape = np.stack([np.frombuffer(r["shape"]) for r in rows])
        meta = [np.frombuffer(r["meta"], dtype=np.int64) for r in rows]
        text_rows = Rows(index, weight, shape, 1 << WORD_BITS)
        meta_rows = Rows(meta, [np.ones(len(m)) for m in meta], np.zeros((len(rows), 0)), 1 << META_BITS)
        models = co_train(text_rows, meta_rows, np.array([r["y"] for r in rows]), np.array([r["fold"] for r in rows]))
        yield pa.RecordBatch.from_pydict({"name": list(models), "model": [models[n].tobytes() for n in models]})

    # The sample is bounded, so one task may hold it.
    fitted = made.coalesce(1).mapInArrow(learn, "name string, model binary").collect()
    return {r["name"]: np.frombuffer(bytes(r["model"])) for r in fitted}


def _probabilities(models: dict[str, np.ndarray] | float):
    """A function from the columns text, lang, source, n_chars to (text, meta, combined) probabilities of each row."""

    def rows(text, lang, source, n_chars):
        for t, a, b, n in zip(text, lang, source, n_chars, strict=True):
            if isinstance(models, float):
                yield models, models, models
                continue
            index, weight, shape = text_features(t.as_py() or "")
            model, behind = models["text"], 1 << WORD_BITS
            x = weight @ model[index] + shape @ model[behind : behind + SHAPE] + model[-1]
            y = models["meta"][meta_features(a.as_py(), b.as_py(), n.as_py())].sum() + models["meta"][-1]
            both = models["both"]
            yield float(sigmoid(x)), float(sigmoid(y)), float(sigmoid(both[0] * x + both[1] * y + both[2]))

    return rows


def quality_scores(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD, **sizes) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every row; scores are probabilities of good quality."""
    own = docs.select(F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("long"))
    probabilities = _probabilities(train(docs, labels, target, **sizes))
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.float64()) for c in ("text_score", "meta_score", "score")], ("kept", pa.bool_())])

    def score(batches):
        for batch in batches:
            found = list(probabilities(*batch.columns[1:]))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            kept = [x >= threshold for x in columns[2]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.float64()) for c in columns], pa.array(kept, pa.bool_())], schema=schema)

    return own.mapInArrow(score, "doc_id long, text_score double, meta_score double, score double, kept boolean")


def good_documents(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD, **sizes) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    probabilities = _probabilities(train(docs, labels, target, **sizes))
    at = [docs.columns.index(c) for c in ("text", "lang", "source", "n_chars")]

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array([p >= threshold for _, _, p in probabilities(*(batch.column(i) for i in at))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
