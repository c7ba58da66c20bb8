"""Relational phrase mining against counting every phrase."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict

import pytest

from panelwright import session
from panelwright.llm import relational_phrases as rp
from tests.llm import fixtures

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, least, longest=5, share=100, top=None):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in data:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        own = {p: a for p, a in counts.items() if a >= least}
        rows = []
        for p, a in own.items():
            if len(p) < 2:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (own[p[:j]] * own[p[j:]]), j, own[p[:j]], own[p[j:]]) for j in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in own.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize(("least", "chunk_words", "slice_bytes"), [(3, 1_000_000, 1 << 20), (2, 50, 40), (40, 500, 7)])
def test_phrases(spark, monkeypatch, least, chunk_words, slice_bytes):
    """Also with tiny chunks and with texts read in tiny parts."""
    monkeypatch.setattr(rp, "SLICE_BYTES", slice_bytes)
    docs = fixtures.documents(spark).repartition(3)
    got = {tuple(r) for r in rp.collocations(docs, least, top=None, chunk_words=chunk_words).collect()}
    assert got == brute(fixtures.rows(), least) and got


def test_shares_lengths_and_limits(spark):
    rng = random.Random(2)
    data = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) + rng.choice([".", ", A b", "\tb c"]), "en", "a", 1) for i in range(80)]
    docs = fixtures.documents(spark, data)
    for longest, share, top in ((3, 100, None), (4, 50, 7), (2, 100, 3)):
        got = {tuple(r) for r in rp.collocations(docs, 4, longest, share, top).collect()}
        assert got == brute(data, 4, longest, share, top) and got


def test_no_phrases(spark):
    assert rp.collocations(fixtures.documents(spark, [])).count() == 0
    assert rp.collocations(fixtures.documents(spark), 10**6).count() == 0


def test_little_is_left_on_disk(spark, tmp_path, monkeypatch):
    """No shuffle files of counting and thinning, and of the written tables only the named phrases and the totals."""
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    shuffled = lambda: set(re.findall(r"shuffle_\w+\.data", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    before = shuffled()
    out, _ = rp.frequent_phrases(fixtures.documents(spark), 3)
    until = time.monotonic() + 20
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert {p.name.rsplit("-", 1)[0] for p in (tmp_path / "panelwright").iterdir()} == {"phrases-named", "phrases-totals"}
    assert {r["k"] for r in out.select("k").distinct().collect()} == {1, 2, 3, 4, 5}


def test_merge_join():
    """Places of one piece follow each other; a gap ends it."""
    import numpy as np

    at, u, v, which = rp.merge_join(np.array([0, 1, 2, 4, 5], dtype=np.int32), np.array([7, 8, 7, 7, 8]))
    assert at.tolist() == [0, 1, 3]
    assert [(u[i], v[i]) for i in which] == [(7, 8), (8, 7), (7, 8)]
