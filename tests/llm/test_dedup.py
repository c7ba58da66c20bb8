"""Exact and near-duplicates, repeated sentences and repeated bytes, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from panelwright import session
from panelwright.llm import block_naming, components, minhash, sentence_spans, suffix_arrays
from tests.llm import fixtures

BARE = re.compile(r"[\x20\x09-\x0D]")
INF = float("inf")


def order(doc_id):
    return INF if doc_id is None else doc_id


@pytest.fixture(scope="module")
def docs(spark):
    return fixtures.documents(spark).repartition(3).cache()


def test_exact_duplicates(spark, docs):
    groups = defaultdict(list)
    for doc_id, text, *_ in fixtures.rows():
        groups[BARE.sub("", text or "")].append((-len(text or ""), order(doc_id), doc_id))
    want = Counter()
    for bare, members in groups.items():
        best = min(members, key=lambda m: m[:2])
        spare = [best]
        for m in members:
            kept = m == best and bool(spare)
            if kept:
                spare.pop()
            want[(m[2], best[2], len(members), kept, hashlib.sha256(bare.encode()).hexdigest())] += 1
    for chars in (2048, 5):  # with five characters to a block names are paired many times
        got = block_naming.exact_duplicates(docs, chars).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
        assert Counter(map(tuple, got)) == want


def test_exact_duplicates_keep_rows_whole(spark, docs):
    kept = block_naming.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [BARE.sub("", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({BARE.sub("", r[1] or "") for r in fixtures.rows()})


def test_names_do_not_collide(spark):
    """Texts of few different blocks in all orders."""
    rng = random.Random(3)
    data = [(i, "".join(rng.choice(["aaaa", "aaab"]) for _ in range(rng.randint(1, 6))), "en", "a", 1) for i in range(300)]
    got = block_naming.identities(fixtures.documents(spark, data), 4).collect()
    by_name = defaultdict(set)
    for r in got:
        by_name[(r["level"], r["name"])].add(data[r["doc_id"]][1])
    assert all(len(t) == 1 for t in by_name.values())
    assert len(by_name) == len({d[1] for d in data})


def jaccard_components(data, k):
    sets = []
    for _, text, *_ in data:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset())
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = defaultdict(lambda: INF)
    for i, r in enumerate(data):
        low[root(i)] = min(low[root(i)], order(r[0]))
    return [(r[0], len(sets[i]), None if low[root(i)] == INF else low[root(i)]) for i, r in enumerate(data)], sets, [root(i) for i in range(len(data))]


def test_near_duplicates(spark, docs):
    want, _, _ = jaccard_components(fixtures.rows(), 4)
    got = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def chained(seed=11, n=70):
    """Near copies of near copies: components that no single document is close to all of."""
    rng = random.Random(seed)
    out, texts = [], [fixtures.words(rng, 60).split() for _ in range(4)]
    for i in range(n):
        base = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = f"new{rng.randrange(1000)}"
        texts.append(base)
        out.append((i, " ".join(base), "en", "a", 1))
    return out


@pytest.mark.parametrize(("rounds", "members"), [(2, 2000), (0, 3)])
def test_near_duplicates_of_near_duplicates(spark, monkeypatch, rounds, members):
    """Also when all is left to the last comparison, in small blocks."""
    monkeypatch.setattr(minhash, "SPREAD_ROUNDS", rounds)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members)
    want, _, _ = jaccard_components(chained(), 4)
    got = minhash.near_duplicates(fixtures.documents(spark, chained())).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_near_duplicates_keep_one_of_each(spark, docs):
    data = fixtures.rows()
    _, sets, roots = jaccard_components(data, 5)
    want = len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    near = defaultdict(set)
    for u, v in edges:
        if u != v:
            near[u].add(v), near[v].add(u)
    assert set(got) == set(near)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        assert got[node] == min(seen)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_sentences(data, span, least_words):
    """{doc_id: [(n_sentences, n_removed, hash of what stays)]}"""
    seen, out = set(), {}
    for _, (doc_id, text, *_rest) in sorted(enumerate(data), key=lambda x: (order(x[1][0]), 0)):
        pieces = re.findall(sentence_spans.SENTENCE, text or "")
        plain = [BARE.sub("", p).translate(LOWER) for p in pieces]
        runs = {(i, min(span, len(pieces))) for i in range(max(len(pieces) - span + 1, 1) if pieces else 0)}
        for i in range(len(pieces)):
            words = [len(re.findall(r"[^\x20\x09-\x0D]+", p)) for p in pieces[i : i + span - 1]]
            runs |= {(i, n) for n in range(1, len(words) + 1) if sum(words[:n]) >= least_words > sum(words[: n - 1])}
        gone = [False] * len(pieces)
        for i, n in sorted(runs):
            run = tuple(plain[i : i + n])
            if run in seen:
                gone[i : i + n] = [True] * n
            seen.add(run)
        kept = "".join(p for p, g in zip(pieces, gone) if not g)
        out.setdefault(doc_id, []).append((len(pieces), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def passages(seed=3):
    """Texts that share one, two or three sentences, long and short, whole or joined to what stands around them."""
    rng = random.Random(seed)
    long = [fixtures.words(rng, n).capitalize() + ". " for n in (55, 30, 26, 9, 22, 12, 11, 21, 3, 70)]
    out = []
    for i in range(60):
        at, n = rng.randrange(len(long)), rng.randint(1, 4)
        out.append((i, fixtures.sentences(rng, rng.randint(0, 3)) + rng.choice([" ", "joined "]) + "".join(long[at : at + n]) + rng.choice(["", "and so on "]) + fixtures.sentences(rng, rng.randint(0, 3)), "en", "a", 1))
    return out


@pytest.mark.parametrize(("span", "least_words"), [(3, 20), (3, 8), (2, 25), (4, 40)])
def test_repeated_sentences(spark, docs, span, least_words):
    for data, table in ((fixtures.rows(), docs), (passages(), fixtures.documents(spark, passages()))):
        want = brute_sentences(data, span, least_words)
        got = {}
        for r in sentence_spans.repeated_sentences(table, span, least_words).collect():
            got.setdefault(r["doc_id"], []).append((r["n_sentences"], r["n_removed"], r["kept_sha256"]))
        assert {k: sorted(v) for k, v in got.items()} == want
    cut = sentence_spans.without_repeats(docs, span, least_words)
    assert cut.columns == docs.columns
    want = brute_sentences(fixtures.rows(), span, least_words)
    assert sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in cut.collect()) == sorted(x[2] for v in want.values() for x in v)


def test_repeated_sentences_leave_little_on_disk(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = sentence_spans._marked(docs, 3, 20)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan  # texts once, places once
        assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "panelwright").iterdir()] == ["spans-starts"]
        assert all(spark.conf.get(k) == v for k, v in settings.items())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def brute_bytes(data, length):
    seen, out = set(), Counter()
    for doc_id, text, *_ in sorted(data, key=lambda r: order(r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            part = raw[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        out[(doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"shard_segments": 2}, {"shard_segments": 7}])
def test_repeated_bytes(spark, docs, options):
    got = Counter(map(tuple, suffix_arrays.repeated_bytes(docs, **options).collect()))
    assert got == brute_bytes(fixtures.rows(), 100)


def test_repeated_bytes_with_frequent_anchors_and_periods(spark, monkeypatch):
    rng = random.Random(2)
    shared = fixtures.words(rng, 60)
    data = [(i, fixtures.words(rng, 20) + shared[: rng.randint(90, 300)] + fixtures.words(rng, 30), "en", "a", 1) for i in range(120)]
    data += [(200, "ab" * 400, "en", "a", 1), (201, "x" * 350, "en", "a", 1), (202, "abc" * 100 + "ab" * 90, "en", "a", 1)]
    monkeypatch.setattr(suffix_arrays, "SLICE_BYTES", 3000)
    for rows_per_task in (10, 200_000):
        got = Counter(map(tuple, suffix_arrays.repeated_bytes(fixtures.documents(spark, data), rows_per_task=rows_per_task).collect()))
        assert got == brute_bytes(data, 100)


def test_a_passage_in_every_document_is_few_rows(spark):
    """Equal segments are one row for the texts that are read together, and all of their places are still found."""
    rng = random.Random(4)
    shared = fixtures.words(rng, 400)
    data = [(i, f"{fixtures.words(rng, 20)} {shared} {fixtures.words(rng, 20)}", "en", "a", 1) for i in range(300)]
    docs = fixtures.documents(spark, data).coalesce(3)
    found = suffix_arrays.all_segments(suffix_arrays._sources(docs), 100, 32)
    per_anchor = found.groupBy("h", "seg").count().agg({"count": "max"}).first()[0]
    assert per_anchor <= 3 and found.selectExpr("sum(1 + coalesce(length(others), 0) / 32)").first()[0] > 5 * found.count()
    assert Counter(map(tuple, suffix_arrays.repeated_bytes(docs).collect())) == brute_bytes(data, 100)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_repeated_bytes_of_texts_with_equal_short_hashes(spark, doc_id):
    pairs = [(22177, 266647), (178584, 299207), (76950, 110747)]
    data = [(doc_id, f"{i:08d}" * 14, "en", "a", 1) for pair in pairs for i in pair]
    df = fixtures.documents(spark, data)
    assert df.selectExpr("hash(text) AS x").distinct().count() == len(pairs)
    assert Counter(map(tuple, suffix_arrays.repeated_bytes(df).collect())) == brute_bytes(data, 100)


def texts_around_a_passage(lengths):
    """Texts that hold parts of one passage, zero bytes and letters of two bytes among them, each between bytes of its own."""
    rng = random.Random(6)
    own = lambda n: "".join(rng.choice("abc d\0ü") for _ in range(n))
    shared = own(400)
    return [(i, own(rng.randint(0, 90)) + shared[(x := rng.randint(0, 200)) : x + n] + own(rng.randint(0, 90)), "en", "a", 1) for i, n in enumerate(lengths)]


def shard_of(data):
    """The segments of the texts as a shard gets them."""
    texts = [text.encode() for _, text, *_ in data]
    rows = []
    for at in suffix_arrays._segments_of(texts, 100, 32):
        for row, start, n, anchor, h, seg in zip(*(x.tolist() for x in at), strict=True):
            rows.append((h % (1 << 63), seg % (1 << 63), row, 0, 0, start << 16 | anchor << 8 | n, 2, texts[row][start : start + n + 99], 1, -1))
    names = ["h", "seg", "d", "th", "tu", "place", "kinds", "body", "parts", "part"]
    return pd.DataFrame(rows, columns=names).drop_duplicates(["h", "seg"])


def test_suffix_arrays_hold_what_segments_can_share(monkeypatch):
    """Segments that have an anchor but no whole window in common are not sorted, nor are the bytes around the common ones."""
    sorted_bytes, find = [], suffix_arrays.repeated_windows
    monkeypatch.setattr(suffix_arrays, "repeated_windows", lambda bodies, *a: (sorted_bytes.append(sum(map(len, bodies))), find(bodies, *a))[1])
    rows = shard_of(texts_around_a_passage([70] * 60))
    assert len(suffix_arrays._shard(100)(rows)) == 0 and sorted_bytes.pop() < 0.2 * rows["body"].str.len().sum()
    rows = shard_of(data := texts_around_a_passage([50, 85, 90, 100, 130, 180] * 10))
    got = {(d, start + i) for d, start, n in suffix_arrays._shard(100)(rows)[["d", "start", "n"]].astype(int).itertuples(index=False) for i in range(n)}
    assert sorted_bytes.pop() < 0.7 * rows["body"].str.len().sum()
    seen, want, texts = set(), set(), [text.encode() for _, text, *_ in data]
    windows = {(d, (p >> 16) + i) for d, p in zip(rows["d"], rows["place"], strict=True) for i in range(p & 0xFF)}
    for d, i in sorted(windows):
        part = texts[d][i : i + 100]
        want |= {(d, i)} if part in seen else set()
        seen.add(part)
    assert got == want and got


@pytest.mark.parametrize("options", [{}, {"shard_segments": 3}])
def test_repeated_bytes_of_passages_of_about_a_window(spark, options):
    for lengths in ([70] * 30, [50, 85, 90, 100, 130, 180] * 8):
        data = texts_around_a_passage(lengths)
        got = Counter(map(tuple, suffix_arrays.repeated_bytes(fixtures.documents(spark, data), **options).collect()))
        assert got == brute_bytes(data, 100)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 2, n).astype(np.int16) for n in (1, 40, 200, 7, 200)]
    parts.append(parts[2].copy())
    text = np.concatenate([np.append(p, -1) for p in parts]).astype(np.int16)
    starts = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
    sizes = np.array([len(p) for p in parts])
    order_, place = suffix_arrays.suffix_array(text)
    suffixes = [tuple(text[i:].tolist()) for i in range(len(text))]
    assert [suffixes[i] for i in order_] == sorted(suffixes)
    got = suffix_arrays.common_prefixes(text, order_, place, starts, sizes, 100)
    for i in range(len(text)):
        if text[i] >= 0 and place[i] > 0:
            j, k = order_[place[i] - 1], 0
            while k < 100 and i + k < len(text) and j + k < len(text) and text[i + k] == text[j + k] >= 0:
                k += 1
            assert got[i] == k


@pytest.mark.parametrize(
    "operator",
    [block_naming.exact_duplicates, block_naming.drop_duplicates, minhash.near_duplicates, minhash.drop_near_duplicates,
     sentence_spans.repeated_sentences, sentence_spans.without_repeats, suffix_arrays.repeated_bytes],
)
def test_empty_table(spark, operator):
    assert operator(fixtures.documents(spark, [])).count() == 0
