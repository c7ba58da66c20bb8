"""The filter audit against sets of failing documents, and its byte pass against plain string functions."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from panelwright.llm import filter_audit as fa
from tests.llm import fixtures

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def failing(data):
    texts = {}
    for doc_id, text, *_ in data:
        if doc_id is not None:
            texts[text or ""] = min(texts.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, _, source, *_ in data:
        t = text or ""
        w, first = WORDS.findall(t), texts.get(t)
        fails = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        fails += "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (first is not None and (doc_id is None or doc_id > first))
        out.append((doc_id, source or "", frozenset(fails)))
    return out


def brute(data, labels):
    good, toxic = ({x[0] for x in labels if x[0] is not None and x[i] == 1} for i in (1, 2))
    rows, total = {}, {}
    for part in {p for _, p, _ in failing(data)}:
        own = [(d, f) for d, p, f in failing(data) if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                all_fail = [f for _, f in own if x in f]
                rows[part, order, step] = [len(left), len(gone), len(all_fail) - len(gone), sum(f == {x} for f in all_fail), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                total[part, x] = total.get((part, x), 0) + len(gone)
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def data():
    rng = random.Random(4)
    out = fixtures.rows()
    long = fixtures.words(rng, 400)
    out += [(200, long, "en", "b", 1), (201, long, "en", None, 1), (202, long + " #", "en", "", 1), (203, "Same Word " * 300, "en", "b", 1), (204, " ".join(f"Word{i}|" for i in range(250)), None, "b", 1)]
    return out


def test_audit(spark):
    rng = random.Random(8)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 210, 2), 4, 4, 8]] + [(None, 1, 1), (999, 1, 1)]
    got = {tuple(r) for r in fa.audit(fixtures.documents(spark, data()).repartition(3), spark.createDataFrame(labels, LABELS)).collect()}
    assert got == brute(data(), labels)
    assert len(got) == 600 * len({r[3] or "" for r in data()})


def test_no_documents_no_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert fa.audit(fixtures.documents(spark, []), none).count() == 0
    assert {tuple(r) for r in fa.audit(fixtures.documents(spark), none).collect()} == brute(fixtures.rows(), [])


@pytest.mark.parametrize(("block", "inserted"), [(1 << 22, 1 << 18), (7, 5), (64, 1)])
def test_byte_pass(monkeypatch, block, inserted):
    """Counts of all texts, wherever blocks and tables are cut."""
    monkeypatch.setattr(fa, "BLOCK_BYTES", block)
    monkeypatch.setattr(fa, "INSERTED", inserted)
    rng = random.Random(1)
    long = "x" * 70
    texts = [r[1] or "" for r in fixtures.rows()][: 80 if block > 100 else 25] + ["", "", "A#", "", "word", "word word", " a\tb ", f"{long} {long} {long}y {long[1:]}", "é" * 9 + " " + "é" * 9]
    texts += ["".join(rng.choice("ab \nÄ日#Z") for _ in range(rng.randint(0, 40))) for _ in range(40)]
    got = fa.measure(pa.array(["skipped", *texts])[1:])
    for i, t in enumerate(texts):
        w = WORDS.findall(t)
        want = (len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t)))
        assert tuple(int(got[k][i]) for k in ("words", "distinct", "capitals", "points", "symbols")) == want, (i, t)
    assert all(len(v) == 0 for v in fa.measure(pa.array([], pa.string())).values())


def test_words_with_equal_hashes(monkeypatch):
    """Matches are verified, so words stay apart even if all hashes are the same."""
    monkeypatch.setattr(fa.SpanTable, "_hash", lambda self, start, size, text, head: np.zeros(len(start), dtype=np.uint64))
    texts = ["one two one three threefold threefolx threefold", "one", "a" * 65 + " " + "a" * 64 + "b" + " " + "a" * 65]
    got = fa.measure(pa.array(texts))
    assert got["distinct"].tolist() == [5, 1, 2]
