"""Near-duplicates by tensored MinHash bands, confirmed on full shingle sets.

Two collections of ``collection`` short bands are computed per document, each band the minima of ``band_rows`` hash
functions. A table key combines band i of the first collection with band j of the second: ``collection`` squared tables
of twice the rows out of ``2 * collection * band_rows`` hash functions, where independent tables would need
``collection`` squared times as many. Two sets of similarity s meet in some table with probability
(1 - (1 - s^band_rows)^collection)^2: with 10 bands of two rows, a pair exactly at 0.8 is missed 7 times in 100 000.

Equal sets are one node from the start, so copies cost nothing. Buckets with the same members count once. Candidates are
confirmed on their whole sets and joined to components in rounds: first every set against the smallest set it shares a
bucket with, then, in buckets that still hold several components, the members in a few random orders, each against the
next. At last the members of such buckets are brought together in blocks of bounded size. There all pairs of different
components are looked at that have sizes that allow the similarity and agree in most of 256 further minima, each pair in
one bucket. The members of such pairs come together once more, with their whole shingle sets; pairs are confirmed on the
spot until a block's components are known, and a block tells only which components it joined, fewer rows than it has
members. The members of a bucket's largest component are not compared with each other. So no pair of a large group of near
copies leaves the task that looks at it.

Documents with fewer words than a shingle have one shingle, their words. Documents without words, also NULL texts, have
none and are linked with nothing. Repeated rows have the same result. A NULL ``doc_id`` is never the smallest of others;
alone, it is its own component with a NULL id, which is kept. Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import matched, mix64, text_or_empty, whole_row
from panelwright.llm.components import components
from panelwright.session import cut_lineage

SHINGLE_WORDS = 4
COLLECTION = 10
BAND_ROWS = 2
NUMERATOR, DENOMINATOR = 80, 100
CHUNK = 1 << 14
SECOND = np.uint64(0x5851F42D4C957F2D)
SPREAD_ROUNDS = 2
PARTNERS = 4
CHUNK_MEMBERS = 1000
BLOCK_MEMBERS = 2000
BLOCK_SHINGLES = 1_000_000
KEYS_PER_TASK = 1_000_000
SKETCH = 256
ROWS_AT_ONCE = 1000


def shingle_set(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    found = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(words, len(found))
    factors = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total += mix64(hashes[i : len(found) - width + 1 + i] * (factors[i] | np.uint64(1)) + np.uint64(i))
    return np.unique(mix64(total))


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return seeds[:count] | np.uint64(1), seeds[count:]


def minima(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, CHUNK // 8)
    for at in range(0, len(shingles), step):
        part = shingles[at : at + step][None, :] * factors[:, None] + terms[:, None]
        np.minimum(low, (part ^ (part >> np.uint64(29))).min(axis=1), out=low)
    return low


def agreements(similarity: float) -> int:
    """How many of ``SKETCH`` minima a pair of this similarity shares at least, but for one time in 100 000."""
    return int(SKETCH * similarity - 4.4 * (SKETCH * similarity * (1 - similarity)) ** 0.5)


def signatures(docs: DataFrame, words: int, collection: int, band_rows: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands): s1 and s2 identify the set, bands has both collections."""
    factors, terms = hash_functions(2 * collection * band_rows)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def sign(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingle_set(text.as_py(), words)
                s1, s2 = own.sum(dtype=np.uint64), mix64(own ^ SECOND).sum(dtype=np.uint64)
                bands = []
                if len(own):
                    low = minima(own, factors, terms).reshape(2 * collection, band_rows)
                    key = np.zeros(2 * collection, dtype=np.uint64)
                    for i in range(band_rows):
                        key = mix64(key * np.uint64(31) + low[:, i])
                    bands = key.astype(np.int64)
                rows.append((doc_id, len(own), np.int64(s1.astype(np.int64)), np.int64(s2.astype(np.int64)), bands))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        sign, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
    )


def table_keys(collection: int):
    """(key, table) of all pairs of a band of the first collection and one of the second."""
    one = F.slice("bands", 1, collection)
    two = F.slice("bands", collection + 1, collection)
    return F.flatten(F.transform(one, lambda a, i: F.transform(two, lambda b, j: F.struct(F.xxhash64(i, j, a, b).alias("key"), (i * collection + j).alias("table")))))


def buckets(sets: DataFrame, collection: int) -> tuple[DataFrame, DataFrame]:
    """Buckets with several members: their rows (key, sid), and (key, tables) with the tables that have these members.

    Buckets with equal members are one.
    """
    # Adaptive execution leaves few files of the narrow sets, of which each row becomes many.
    tasks = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sets.count() * collection**2 // KEYS_PER_TASK))
    keyed = sets.select("sid", "bands").repartition(tasks, "sid").select("sid", F.explode(table_keys(collection)).alias("_k")).select("_k.key", "_k.table", "sid")
    shared = cut_lineage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "minhash-shared")
    rows = cut_lineage(keyed.join(shared, "key", "left_semi"), "minhash-shared-rows")
    members = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("sid")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(7), "sid")).alias("x2")]
    same = rows.groupBy("key").agg(*members, F.first("table").alias("table")).groupBy("n", "x1", "x2")
    chosen = cut_lineage(same.agg(F.min("key").alias("key"), F.collect_list("table").alias("tables")).select("key", "tables"), "minhash-keys")
    return cut_lineage(rows.join(chosen, "key", "left_semi").select("key", "sid"), "minhash-buckets"), chosen


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, numerator: int, denominator: int) -> DataFrame:
    """The pairs (u, v) whose whole shingle sets are similar enough."""

    def check(batches):
        last, left = None, None
        for batch in batches:
            u, v, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i in range(len(u)):
                if u[i] != last:
                    last, left = u[i], shingle_set(batch.column(2)[i].as_py(), words)
                right = shingle_set(batch.column(3)[i].as_py(), words)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if denominator * shared >= numerator * (len(left) + len(right) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({"u": pa.array([u[i] for i in keep], pa.int64()), "v": pa.array([v[i] for i in keep], pa.int64())})

    both = pairs.join(texts.select(F.col("sid").alias("v"), F.col("text").alias("right")), "v")
    both = both.join(texts.select(F.col("sid").alias("u"), F.col("text").alias("left")), "u")
    return both.select("u", "v", "left", "right").mapInArrow(check, "u long, v long")


def _texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(sid, text): one text for each wanted set (sid, low, s1, s2)."""

    def same(batches):
        for batch in batches:
            keep = []
            for i, (s1, n) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                own = shingle_set(batch.column(1)[i].as_py(), words)
                if len(own) == n and int(own.sum(dtype=np.uint64).astype(np.int64)) == s1:
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select(["sid", "text"])

    own = docs.select(F.col("doc_id").cast("long").alias("low"), text_or_empty().alias("text"))
    found = matched(own, wanted, ["low"]).select("sid", "text", "s1", "n_shingles")
    return found.mapInArrow(same, "sid long, text string").dropDuplicates(["sid"])


def in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")


class Rounds:
    """Finds the links among the members of buckets until every bucket's components are settled."""

    def __init__(self, rows: DataFrame, chosen: DataFrame, sets: DataFrame, texts: DataFrame, words: int, collection: int, numerator: int, denominator: int):
        self.rows, self.chosen, self.texts, self.words, self.collection = rows, chosen, texts, words, collection
        self.numerator, self.denominator = numerator, denominator
        self.info = cut_lineage(sets.join(rows.select("sid").distinct(), "sid", "left_semi").select("sid", F.col("n_shingles").alias("n"), "bands"), "minhash-info")
        self.labels: DataFrame | None = None

    def plausible(self, n, m, a, b):
        """Sizes that allow the similarity, and as many equal bands as a similar pair has but once in 100 000 times."""
        fits = F.lit(self.denominator) * F.least(n, m) >= F.lit(self.numerator) * F.greatest(n, m)
        equal = sum((F.get(a, F.lit(i)) == F.get(b, F.lit(i))).cast("int") for i in range(2 * self.collection))
        return fits & (equal >= self.collection // 2)

    def merge(self, pairs: DataFrame) -> None:
        """Joins the components of the candidate pairs that are confirmed."""
        self.join(confirmed(pairs, self.texts, self.words, self.numerator, self.denominator))

    def join(self, links: DataFrame) -> None:
        """Joins the components of linked sets."""
        labels = self.labels
        if labels is not None:
            as_u, as_v = labels.toDF("u", "_u"), labels.toDF("v", "_v")
            links = links.join(as_u, "u", "left").join(as_v, "v", "left").select(F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v"))
        new = components(links)
        if labels is None:
            self.labels = new
        else:
            moved = labels.join(new.toDF("label", "_to"), "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
            self.labels = cut_lineage(moved.unionByName(new.join(labels, "node", "left_anti")), "minhash-labels")

    def active(self) -> DataFrame:
        """The rows of buckets that hold several components, with these."""
        marked = self.rows.join(self.labels.toDF("sid", "label"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
        several = marked.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("size")).where("a < b").select("key", "size")
        return cut_lineage(marked.join(several, "key"), "minhash-active")

    def filtered(self, pairs: DataFrame) -> DataFrame:
        both = pairs.join(self.info.toDF("u", "_n", "_a"), "u").join(self.info.toDF("v", "_m", "_b"), "v")
        return both.where(self.plausible(F.col("_n"), F.col("_m"), F.col("_a"), F.col("_b"))).select("u", "v")

    def smallest(self) -> None:
        """Every set against the smallest set it shares a bucket with."""
        first = self.rows.groupBy("key").agg(F.min("sid").alias("low"))
        lowest = self.rows.join(first, "key").groupBy("sid").agg(F.min("low").alias("low")).where("low < sid")
        self.merge(self.filtered(lowest.select(F.col("low").alias("u"), F.col("sid").alias("v"))))

    def spread(self, left: DataFrame, turn: int) -> None:
        """Members of a bucket in a new random order, each against the next; at most a few pairs for a set."""
        part = F.pmod(F.xxhash64(F.lit(turn), "sid"), F.col("size") / CHUNK_MEMBERS + 1).cast("int")
        order = Window.partitionBy("key", "part").orderBy(F.xxhash64(F.lit(turn), "key", "sid"), "sid")
        nexts = left.withColumn("part", part).withColumns({"_sid": F.lead("sid").over(order), "_label": F.lead("label").over(order)})
        pairs = nexts.where(F.col("label") != F.col("_label")).select(F.least("sid", "_sid").alias("u"), F.greatest("sid", "_sid").alias("v")).distinct()
        rank = lambda c: F.row_number().over(Window.partitionBy(c).orderBy(F.xxhash64(F.lit(turn), "u", "v")))
        few = pairs.withColumns({"_ru": rank("u"), "_rv": rank("v")}).where((F.col("_ru") <= PARTNERS) | (F.col("_rv") <= PARTNERS))
        self.merge(self.filtered(few.select("u", "v")))

    def rest(self, left: DataFrame) -> None:
        """Every likely pair of different components in a bucket, each pair in one bucket only.

        One side leaves out the bucket's largest component, so its members are not compared with each other. Likely are
        pairs whose sketches agree as often as those of a similar pair do but once in 100 000 times. Large buckets are
        compared in blocks of bounded size.
        """
        left = left.drop("size").join(self.info, "sid")
        sizes = [F.count(F.lit(1)).alias("c"), F.sum("n").alias("w")]
        most = left.groupBy("key", "label").agg(*sizes).groupBy("key").agg(F.max(F.struct("c", "label", "w")).alias("m"), F.sum("c").alias("all"), F.sum("w").alias("whole"))
        blocks = lambda c, w: F.greatest(F.ceil(c / BLOCK_MEMBERS), F.ceil(w / BLOCK_SHINGLES)).cast("int")
        main = most.select("key", F.col("m.label").alias("main"), blocks(F.col("all") - F.col("m.c"), F.col("whole") - F.col("m.w")).alias("few"), blocks(F.col("all"), F.col("whole")).alias("many"))
        marked = left.join(self.sketches(left), "sid").join(main.join(self.chosen, "key"), "key")
        marked = marked.withColumn("is_main", F.col("label") == F.col("main"))
        deal = lambda c: F.pmod(F.xxhash64("sid"), F.col(c).cast("long")).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        small = marked.where("not is_main").withColumns({"side": F.lit(0), "i": deal("few")}).withColumn("j", every("many"))
        other = marked.withColumns({"side": F.lit(1), "j": deal("many")}).withColumn("i", every("few"))
        columns = ["key", "i", "j", "side", "sid", "label", "is_main", "n", "bands", "sketch", "tables"]
        both = small.select(columns).unionByName(other.withColumn("tables", F.lit(None).cast("array<int>")).select(columns))
        likely = cut_lineage(in_blocks(both).mapInArrow(self.comparison(False), both.schema), "minhash-likely")
        if likely.isEmpty():
            return
        whole = in_blocks(likely.join(self.whole_sets(likely), "sid").select(*columns, "own"))
        self.join(cut_lineage(whole.mapInArrow(self.comparison(True), "u long, v long"), "minhash-joined"))

    def sketches(self, left: DataFrame) -> DataFrame:
        """(sid, sketch): a byte of each of ``SKETCH`` more minima."""
        factors, terms = hash_functions(SKETCH)
        words = self.words
        return self.drawn(left, "sketch", lambda text: (minima(shingle_set(text, words), factors, terms) & np.uint64(255)).astype(np.uint8).tobytes())

    def whole_sets(self, left: DataFrame) -> DataFrame:
        """(sid, own): the sorted shingle hashes."""
        words = self.words
        return self.drawn(left, "own", lambda text: shingle_set(text, words).tobytes())

    def drawn(self, left: DataFrame, name: str, make) -> DataFrame:
        """(sid, name): what ``make`` makes of the texts of the sets in ``left``."""

        def draw(batches):
            for batch in batches:
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    part = batch.slice(at, ROWS_AT_ONCE)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([make(t.as_py()) for t in part.column(1)], pa.binary())], names=["sid", name])

        wanted = self.texts.join(left.select("sid").distinct(), "sid", "left_semi")
        return cut_lineage(wanted.select("sid", "text").mapInArrow(draw, f"sid long, {name} binary"), f"minhash-{name}")

    def comparison(self, whole: bool):
        """Compares the two sides of each block; a block's rows come one after the other, the smaller side first.

        Without the ``whole`` sets it keeps the rows that are part of a likely pair, with them it joins their components.
        """
        least = agreements(self.numerator / self.denominator)
        numerator, denominator, width = self.numerator, self.denominator, self.collection

        def candidates(at, end, sides, sid, label, main, n, bands, sketch, tables):
            cut = at + int(np.searchsorted(sides[at:end], 1))
            left, right = slice(at, cut), slice(cut, end)
            if at == cut or cut == end:
                return
            known = set(tables[at].as_py())
            a, b = n[left][:, None], n[right][None, :]
            open_ = (label[left][:, None] != label[right][None, :]) & (main[right][None, :] | (sid[left][:, None] < sid[right][None, :]))
            i, j = np.nonzero(open_ & (denominator * np.minimum(a, b) >= numerator * np.maximum(a, b)))
            for start in range(0, len(i), 100_000):
                x, y = i[start : start + 100_000] + at, j[start : start + 100_000] + cut
                agree = (sketch[x] == sketch[y]).sum(axis=1)
                near = np.flatnonzero(agree >= least)
                near = near[np.argsort(-agree[near], kind="stable")]  # the surest first: they join most
                x, y = x[near], y[near]
                same = bands[x] == bands[y]
                table = same[:, :width].argmax(axis=1) * width + same[:, width:].argmax(axis=1)  # the first that they share
                mine = np.fromiter((t in known for t in table.tolist()), dtype=bool, count=len(table))
                yield x[mine].tolist(), y[mine].tolist()

        def joined(found, sid, label, sets):
            """The pairs that join two components, as far as the block knows; all that are linked lie in one then."""
            parent: dict[int, int] = {}

            def root(x):
                while (up := parent.get(x, x)) != x:
                    parent[x] = parent.get(up, up)
                    x = parent[x]
                return x

            for left, right in found:
                for x, y in zip(left, right, strict=True):
                    a, b = root(label[x]), root(label[y])
                    if a != b:
                        one, two = (np.frombuffer(sets[i].as_buffer(), dtype=np.uint64) for i in (x, y))
                        shared = len(np.intersect1d(one, two, assume_unique=True))
                        if denominator * shared >= numerator * (len(one) + len(two) - shared):
                            parent[a] = b
                            yield sid[x], sid[y]

        def compare(batches):
            held = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                if len(held) >= BLOCK_MEMBERS:
                    held = yield from work(held, False)
            if held is not None and len(held):
                yield from work(held, True)

        def work(table, last):
            """The pairs of all blocks in ``table`` but the last one, which may go on; returns that one's rows."""
            table = table.combine_chunks()
            column = lambda c: table.column(c).combine_chunks()
            key, i, j, sides, sid, label, n = (column(c).to_numpy() for c in ("key", "i", "j", "side", "sid", "label", "n"))
            main = column("is_main").to_numpy(zero_copy_only=False)
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begins = [*np.flatnonzero(new).tolist(), len(key)]
            done = begins[-1] if last else begins[-2]
            if done:
                bands = column("bands").flatten().to_numpy().reshape(len(key), -1)
                sketch = np.frombuffer(b"".join(column("sketch").to_pylist()), dtype=np.uint8).reshape(len(key), -1)
                tables = column("tables")
                found = lambda at, end: candidates(at, end, sides, sid, label, main, n, bands, sketch, tables)
                whole_blocks = [(at, end) for at, end in zip(begins, begins[1:]) if end <= done]
                if whole:
                    names, labels, sets = sid.tolist(), label.tolist(), column("own")
                    pairs = [p for at, end in whole_blocks for p in joined(found(at, end), names, labels, sets)]
                    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])
                else:
                    rows = np.unique(np.array([r for at, end in whole_blocks for x, y in found(at, end) for r in (*x, *y)], dtype=np.int64))
                    yield from table.take(pa.array(rows)).to_batches()
            return table.slice(done)

        return compare

    def run(self) -> DataFrame:
        """(node, label) for the sets that are linked to another."""
        self.smallest()
        for turn in range(SPREAD_ROUNDS):
            left = self.active()
            if left.isEmpty():
                return self.labels
            self.spread(left, turn)
        left = self.active()
        if not left.isEmpty():
            self.rest(left)
        return self.labels


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    collection: int = COLLECTION,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, s1, s2, component) for every row of ``docs``; s1 and s2 identify its
    shingle set, ``component`` its component also where several have equal smallest ids."""
    signed = cut_lineage(signatures(docs, words, collection, band_rows), "minhash-signatures")
    key = ["n_shingles", "s1", "s2"]
    sets = signed.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"))
    sets = cut_lineage(sets.withColumn("sid", F.monotonically_increasing_id()), "minhash-sets")
    rows, chosen = buckets(sets, collection)
    wanted = sets.join(rows.select("sid").distinct(), "sid", "left_semi").select("sid", "low", "s1", "n_shingles")
    texts = cut_lineage(_texts(docs, wanted, words), "minhash-texts")
    labels = Rounds(rows, chosen, sets, texts, words, collection, numerator, denominator).run()
    labelled = sets.select("sid", "low", *key).join(labels.toDF("sid", "label"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    lows = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    by_set = cut_lineage(labelled.join(lows, "label").select(*key, "component_id", F.col("label").alias("component")), "minhash-components")
    out = signed.join(by_set, key, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "s1", "s2", "component")


def drop_near_duplicates(docs: DataFrame, words: int = 5, **options) -> DataFrame:
    """The rows of ``docs`` of which one per component stays, with all columns: the one with the smallest ``doc_id``.

    Of several rows with that ``doc_id`` in one component, the one with the first text stays.
    """
    found = cut_lineage(near_duplicates(docs, words, **options), "minhash-found")
    several = cut_lineage(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "minhash-several")
    once = matched(docs, found.where("not kept").select("doc_id").distinct(), ["doc_id"], "left_anti")
    if several.isEmpty():
        return once

    @F.udf("struct<s1: bigint, s2: bigint>")
    def set_of(text):
        own = shingle_set(text, words)
        return int(own.sum(dtype=np.uint64).astype(np.int64)), int(mix64(own ^ SECOND).sum(dtype=np.uint64).astype(np.int64))

    own = matched(docs.select(whole_row(docs), "doc_id", "text"), several, ["doc_id"], "left_semi")
    own = own.withColumn("_set", set_of(text_or_empty())).select("_row", "doc_id", "text", "_set.s1", "_set.s2")
    stay = found.where("kept").groupBy("doc_id", "s1", "s2").agg(F.max("n_shingles").alias("n"), F.max("component").alias("component"))
    own = matched(own, stay, ["doc_id", "s1", "s2"])
    # Texts without words are linked with nothing: each stays.
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id", "component").orderBy("text")))
    own = own.where("rank = 1 or n = 0").select("_row.*")
    return matched(once, several, ["doc_id"], "left_anti").unionByName(own)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("s1", "s2", "component")
