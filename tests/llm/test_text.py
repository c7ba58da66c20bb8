"""Scoring, packing, token files, mixing, classifier and neighbours."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from panelwright.llm import cotraining, encoding, mixing, packing, prefix_forest, subword_lattice, token_files
from panelwright.llm.encoding import Encoder, default_path
from panelwright.session import scratch_path
from tests.llm import fixtures

ODD = ["", " ", "\n", " a", "a ", "a  b", "a   b\n\n c", "it's 'S don't", "x\ty", "<|endoftext|> hi <|startoftext|>", "ΣΑΣ Σ", "é ́x", "a\x1cb", "a\x85 b",
       "日本 語\n絵文字😀 a", "Ünï ß. a... b?! . ! x'. 's. it's. İI ŉa ǅx ſa ªb", "don't! 12,a b-c.", "a b  c"]


@pytest.fixture(scope="module")
def docs(spark):
    return fixtures.documents(spark).repartition(3).cache()


@pytest.mark.parametrize(("name", "ends"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_remembered_words_change_nothing(name, ends):
    encode = Encoder(default_path(name), ends)
    for text in ODD + [r[1] or "" for r in fixtures.rows()]:
        assert encode.encode(text) == encode.whole(text), text


@pytest.mark.parametrize(("name", "ends"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_marks_behind_words_change_nothing(name, ends, monkeypatch):
    monkeypatch.setattr(encoding, "MOST_REMEMBERED", 40)
    encode, rng = Encoder(default_path(name), ends), random.Random(4)
    cores = ["a", "Été", "straße", "ÀÇÑ", "日本", "x1", "don't", "7", "e\u0301", "ªº", "µ", "ÿ", "Ā", "<", "it's", "", "|endoftext", "<|endoftext|>"]
    for _ in range(300):
        text = " ".join((rng.choice(cores) + "".join(rng.choices(".,;:!?#$%&*|", k=rng.randint(0, 4)))) or "b" for _ in range(rng.randint(1, 9)))
        assert encode.encode(text) == encode.whole(text), text


@pytest.mark.parametrize(("name", "ends"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_words_with_marks_are_not_encoded_again(name, ends):
    encode = Encoder(default_path(name), ends)
    known, calls = encode.first if ends else encode.later, []
    whole = known._ids
    known._ids = lambda text: calls.append(text) or whole(text)
    encode.encode("x house, house tree** house** tree| tree, house&")
    assert calls == [",", "**", "|", "&"]
    for kept in ("house", "tree"):
        assert (kept.encode() if ends else kept) in known


def test_frequent_words_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(encoding, "MOST_REMEMBERED", 40)
    encode = Encoder(default_path("word_bpe_49k.json"), True)
    encode.encode("first words")
    for i in range(20):
        encode.encode(" ".join(f"w{i}x{j}" for j in range(10)))
        assert b"first" in encode.first and len(encode.first) <= 50


def test_subword_lattice(spark, docs):
    data = fixtures.rows()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in data]
    tokens = [[*(r[1] or "").encode().lower().split(), b""] for r in data]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, distinct = sum(counts.values()), len(counts)
    pieces = subword_lattice.vocabulary(default_path("byte_bpe_50k.json"))
    encode = Encoder(default_path("byte_bpe_50k.json"), False)
    used, ends = Counter(), 0
    for w in counts:
        if w:
            used.update(np.frombuffer(encode.whole(w.decode()), dtype="<u4").tolist())
            ends += 1
    whole = sum(used.values()) + ends + 0.1 * (len(pieces) + 1)
    p = {b: (used[i] + 0.1) / whole for b, i in pieces.items() if len(b) <= 16}
    novel = (sum(c == 1 for c in counts.values()) + 1) / (total + 1)

    def probability(word):
        if not word:
            spelled = 1.0
        else:
            ways = [1.0] + [0.0] * len(word)
            for j in range(1, len(word) + 1):
                ways[j] = sum(ways[i] * p.get(word[i:j], 0.0) for i in range(max(0, j - 16), j))
            spelled = ways[-1]
        return novel * spelled * (ends + 0.1) / whole + (1 - novel) * counts[word] / total

    want = defaultdict(list)
    for r, h, t in zip(data, held, tokens):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)
        want[r[0]].append((h, len(t), sum(counts[w] > 0 for w in t), total, base, sum(math.log10(probability(w)) for w in t)))
    for chars in (8_000_000, 2_000):
        got = defaultdict(list)
        for r in subword_lattice.score_documents(docs, block_chars=chars).collect():
            got[r["doc_id"]].append(tuple(r)[1:])
        assert set(got) == set(want)
        for k in want:
            for a, b in zip(sorted(got[k]), sorted(want[k]), strict=True):
                assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9)


def test_lattice_probabilities_add_up():
    """Over all strings of a length, the probabilities of a vocabulary of single pieces add up to one."""
    lattice = subword_lattice.Lattice({b"a": math.log(0.6), b"b": math.log(0.4)})
    assert math.isclose(sum(math.exp(lattice.log_probability(bytes([x, y]))) for x in b"ab" for y in b"ab"), 1.0)
    both = subword_lattice.Lattice({b"a": math.log(0.5), b"aa": math.log(0.25)})
    assert math.isclose(math.exp(both.log_probability(b"aaa")), 0.125 + 2 * 0.125)


def test_lattice_weighs_pieces_of_any_length():
    pieces = subword_lattice.vocabulary(default_path("byte_bpe_50k.json"))
    total = sum(range(1, len(pieces) + 1))
    p = {b: (i % len(pieces) + 1) / total for b, i in pieces.items()}
    lattice = subword_lattice.Lattice({b: math.log(x) for b, x in p.items()})
    longest = max(pieces, key=lambda b: (len(b), b))
    assert len(longest) > 16
    for word in (longest, b"-" * 40, b"=" * 33 + b"x", b"word"):
        ways = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            ways[j] = sum(ways[i] * p.get(word[i:j], 0.0) for i in range(j))
        assert math.isclose(lattice.log_probability(word), math.log(ways[-1]), rel_tol=1e-12)


def test_packing(spark, docs):
    encode = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    encode.encode_special_tokens = True
    for capacity in (1024, 50):
        path = default_path("byte_bpe_50k.json")
        pieces = packing.token_pieces(docs, path, capacity=capacity, with_ids=True)
        got = packing.pack(packing.cut_lineage(pieces, "test-pieces"), capacity).toPandas()
        want = Counter()
        for doc_id, text, *_ in fixtures.rows():
            ids = [*encode.encode(text or "", add_special_tokens=False).ids, 2]
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[(doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))] += 1
        assert Counter((None if x != x or x is None else int(x), *r) for x, *r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).values.tolist()) == want
        got = got.sort_values(["sequence_id", "offset"])
        assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
        used = got.groupby("sequence_id")["length"].sum()
        assert used.max() <= capacity
        bound = -(-got["length"].sum() // capacity)
        assert len(used) <= bound + max(2, bound // 20)


def test_plan_fills_gaps_exactly():
    for times, parts in packing.plan({6: 4, 4: 1, 3: 2, 1: 3, 2: 1}, 10):
        assert times > 0 and sum(parts) <= 10
    rng = random.Random(4)
    counts = Counter(rng.randint(1, 99) for _ in range(5000))
    patterns = packing.plan(counts, 100)
    used = Counter()
    for times, parts in patterns:
        assert sum(parts) <= 100
        used.update({x: times * k for x, k in Counter(parts).items()})
    assert used == counts
    assert sum(t for t, _ in patterns) <= 1.01 * sum(x * n for x, n in counts.items()) / 100 + 1
    assert len(patterns) < 2000


def test_packed_sequences_hold_the_ids(spark, docs):
    path = default_path("byte_bpe_50k.json")
    rows = packing.packed_sequences(docs, path, capacity=64).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 256 for r in rows)
    ids = np.concatenate([np.frombuffer(bytes(r["ids"]), dtype="<u4") for r in rows])
    assert (ids == 2).sum() >= len(fixtures.rows())


def test_token_files(spark, docs):
    encode = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    encode.encode_special_tokens = True
    files = token_files.write_tokens(docs, default_path("word_bpe_49k.json"), scratch_path(spark, "tokens"))
    got = sorted(token_files.read_tokens(files, with_ids=True).collect(), key=lambda r: r["start"])
    ids = lambda t: [*encode.encode(t or "", add_special_tokens=False).ids, 1]
    data = sorted(fixtures.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in got] == [r[0] for r in data]
    start = 0
    for r, want in zip(got, data):
        own = ids(want[1])
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(own), own)
        assert r["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())
        start += len(own)


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bits_and_random_access(tmp_path, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    rng = np.random.default_rng(bits)
    data = [rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4") for n in (0, 5, 64, 300, 1, 0)]
    with fs.LocalFileSystem().open_output_stream(str(tmp_path / "x")) as stream:
        writer = token_files.Writer(stream, bits)
        for i, ids in enumerate(data):
            writer.add(None if i == 1 else i, ids)
        writer.close()
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as file:
        reader = token_files.Reader(file)
        for i in (3, 0, 5, 1, 4, 2):
            assert np.array_equal(reader.document(i), data[i])
        assert [d for d, _ in reader.documents()] == [0, None, 2, 3, 4, 5]
    packed = token_files.pack_bits(data[3], bits)
    assert len(packed) == -(-300 * bits // 8)


def test_mixing(spark, docs):
    data = fixtures.rows()
    got = mixing.mix(docs, block_words=16, shard_blocks=5)
    again = sorted(map(tuple, mixing.mix(docs.repartition(7), block_words=64).drop("shards").collect()), key=str)
    rows = got.collect()
    assert sorted(map(tuple, got.drop("shards").collect()), key=str) == again  # neither blocks, shards nor tasks matter
    assert len(rows) == len(data) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    sizes = defaultdict(int)
    for doc_id, text, _, source, _ in data:
        sizes[source] += len((text or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in over:
            target[s], left, open_ = 3.0 * sizes[s], left - 3 * sizes[s], open_ - {s}
    taken = defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]])
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)


def test_splitting_tree_is_exact(spark):
    quotas = spark.createDataFrame([(1, 300), (2, 0), (3, 41), (4, 1)], "_rank int, blocks long")
    rows = mixing.shard_quotas(quotas, 10).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        assert r["blocks"] >= 0
        by_source[r["_rank"]] += r["blocks"]
        by_shard[r["shard"]] += r["blocks"]
    assert by_source == Counter({1: 300, 2: 0, 3: 41, 4: 1}) and sorted(by_shard.values()) == [9] * 8 + [10] * 27
    spread = [r["blocks"] for r in rows if r["_rank"] == 3]
    assert 0.5 < np.var(spread) < 2.0  # hypergeometric: about 1.0


def test_shards_take_disjoint_blocks(spark, docs):
    placed = mixing.cut_lineage(mixing.placed_documents(docs), "test-placed")
    rows = mixing.draws(placed, block_words=16, shard_blocks=5).collect()
    seen = Counter()
    for r in rows:
        for w in range(r["from_word"], r["from_word"] + r["words"]):
            seen[(r["_rank"], r["_range"], r["_row"], r["pass"], w)] += 1
    assert max(seen.values()) == 1
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["position"])
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())


def test_mixed_documents(spark, docs, monkeypatch):
    """Whole documents as often as the mix starts them, in the order of the shards that draw their first blocks."""
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    rows, texts = mixed.collect(), Counter((r[0], r[1], r[3]) for r in fixtures.rows())
    words, longest, times = Counter(), Counter(), Counter()
    for r in rows:
        words[r["source"]] += len(r["text"].encode().split())
        times[r["doc_id"], r["text"], r["source"]] += 1
    assert all(n <= mixing.MOST_PASSES * texts[k] for k, n in times.items())
    for _, text, _, source, _ in fixtures.rows():
        longest[source] = max(longest[source], len((text or "").encode().split()))
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["source"]] += r["taken"]
    assert all(taken[s] <= words[s] < taken[s] + max(longest[s], 1) for s in taken)
    placed = mixing.cut_lineage(mixing.placed_documents(docs), "test-placed")
    first = mixing.draws(placed).where("from_word = 0").orderBy("shard", "position").select("doc_id", "size").collect()
    assert [(r["doc_id"], len(r["text"].encode().split())) for r in rows] == [tuple(r) for r in first]


def test_classifier(spark):
    rng = random.Random(9)
    data, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = fixtures.sentences(rng, 12)
        text = " ".join(w + "###" for w in text.split()) if bad else text
        data.append((i, text, "en", "junk" if bad and i % 8 else "web", len(text)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(not bad), 0))
    labels += [(None, 1, 0), (5000, None, 1), (0, 0, 0)]
    docs = fixtures.documents(spark, data + [(500, None, None, None, None), (501, "", "en", "web", 0), data[1]])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in cotraining.quality_scores(docs, marks).collect()}
    known = {x[0] for x in labels}
    held = [i for i in range(400) if i not in known]
    right = sum(got[i]["kept"] == (i % 4 != 0) for i in held)
    assert right >= 0.97 * len(held)
    assert 0 <= got[500]["score"] <= 1
    kept = cotraining.good_documents(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i, r in got.items() if r["kept"]] + [1])


def test_classifier_learns_every_word_of_long_texts(spark):
    rng = np.random.default_rng(6)
    place = lambda w: int(cotraining.text_features(w)[0][0])
    names = sorted({place(f"w{i}"): f"w{i}" for i in range(60_000)}.items())
    good, bad = names[-1][1], names[-2][1]  # hashed above all other words
    data = []
    for i in range(120):
        own = [names[k][1] for k in rng.choice(len(names) - 2, 700, replace=False)]
        data.append((i, " ".join([*own, good if i % 2 else bad]), "en", "a", 1))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    model = cotraining.train(fixtures.documents(spark, data), labels)["text"]
    assert model[place(good)] > 0 > model[place(bad)]


def test_classifier_without_two_classes(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert cotraining.good_documents(docs, none).count() == docs.count()
    bad = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert cotraining.good_documents(docs, bad).count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((700, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[3].tolist()) for i in range(9)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0]), (None, vectors[5].tolist()), (2005, [float("inf")] * 16), rows[8]]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, shard string")
    got = defaultdict(list)
    asked = df.where("vec_id % 50 = 0 or vec_id = 3 or vec_id >= 1000")
    for r in prefix_forest.nearest_neighbours(df, asked, shard_rows=200, candidates=120).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    good = [(i, np.array(v)) for i, v in rows if i is not None and (i < 2000)]
    hits = total = 0
    for q, found in got.items():
        own = np.array(dict(rows)[q])
        exact = sorted((-float(v @ own / math.sqrt((v @ v) * (own @ own))), i) for i, v in good if i != q)[:5]
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert all(math.isclose(f[2], float(np.array(dict(rows)[f[1]]) @ own / math.sqrt((own @ own) * (np.array(dict(rows)[f[1]]) ** 2).sum())), rel_tol=1e-12) for f in found)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hits += len({f[1] for f in found} & {i for _, i in exact})
        total += 5
    assert not set(got) & set(range(2000, 2006))
    assert [f[1] for f in got[3]] == [1000, 1001, 1002, 1003, 1004]
    assert hits >= 0.9 * total


def test_ties_among_hundreds_of_equal_vectors(spark):
    rng = np.random.default_rng(8)
    copy = rng.standard_normal(64).astype(np.float32)
    rows = [(i, rng.standard_normal(64).astype(np.float32).tolist()) for i in range(600)]
    rows += [(i, copy.tolist()) for i in range(1000, 1300)]
    rows += [(2000 + i, (copy + 0.05 * rng.standard_normal(64)).astype(np.float32).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(list)
    asked = df.where("vec_id >= 2000 or vec_id = 1100")
    for r in prefix_forest.nearest_neighbours(df, asked, shard_rows=230, candidates=200).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert len(got) == 21
    held = {i: np.array(v) for i, v in rows}
    for q, found in got.items():
        own = held[q]
        for i, s in found:
            v = held[i]
            assert s == float(np.cumsum(v * own)[-1] / (np.sqrt((v**2).sum()) * np.sqrt((own**2).sum())))
        copies = [i for i, _ in found if 1000 <= i < 1300]
        assert copies == list(range(1000, 1000 + len(copies)))
        assert len({s for i, s in found if 1000 <= i < 1300}) == 1
    assert [i for i, _ in got[1100]] == [1000, 1001, 1002, 1003, 1004]


def test_counted_collisions_find_neighbours_among_a_quarter_of_the_rows():
    """Isotropic vectors, the hardest: a shard much larger than what is scored; without the counts recall is lost."""
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((4000, 64))
    forest = prefix_forest.Forest(np.arange(4000), vectors, prefix_forest.TREES, prefix_forest.BITS)
    unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    queries, hits, scored, chance = vectors[:60], 0, 0, 0
    for i, rows in forest.candidates(queries, 1000):
        exact = np.argsort(-(unit @ unit[i]), kind="stable")[1:6]
        hits += len(set(rows.tolist()) & set(exact.tolist()))
        scored += len(rows)
        chance += len(set(range(0, 4000, 4)) & set(exact.tolist()))
    assert hits >= 0.9 * 300 and scored <= 60 * 1000 * 1.1 and chance < 0.5 * 300


def test_neighbours_among_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 1.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r)[:3] for r in prefix_forest.nearest_neighbours(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 7)] or got == [(0, 1, 50), (0, 2, 7), (50, 1, 7), (50, 2, 0)]


def test_empty_tables(spark):
    none = fixtures.documents(spark, [])
    path = default_path("byte_bpe_50k.json")
    assert subword_lattice.score_documents(none).count() == 0
    assert packing.pack_documents(none, path).count() == 0
    assert token_files.read_tokens(token_files.write_tokens(none, default_path("word_bpe_49k.json"), scratch_path(spark, "tokens"))).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert cotraining.quality_scores(none, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert prefix_forest.nearest_neighbours(vectors, vectors).count() == 0
