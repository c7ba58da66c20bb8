"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's words form a stream: its documents in an order permuted by a hash, read up to three times over. The stream is
cut into blocks of ``block_words``; the source's target is its exact quota of blocks (the last one may be short). The
quotas of all sources are handed down a binary tree over the output shards: at every node the blocks of each source that
go to the left half are drawn from the multivariate hypergeometric distribution, so every shard receives an exact number
of blocks of each source, distributed as if all blocks had been shuffled. A shard takes its blocks from the permuted
streams in turn, so that no two shards share one, and orders what it got by a hash. All draws are hashes of the seed
and the place in the tree: reruns and recomputed tasks agree.

Prefix sums over a stream run inside 4 096 ranges of its hash order, so a source with most of the rows is no single task.

NULL texts have no words; a NULL source is a source of its own and comes last; documents without words take nothing;
repeated rows are documents of their own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import WORD, matched, text_or_empty, whole_row
from panelwright.session import cut_lineage

BLOCK_WORDS = 4096
SHARD_BLOCKS = 256
MOST_PASSES = 3
SEED = "mix"


def targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources (source, source_size, target) from ``sizes`` (source, source_size).

    Weights 1, 2, 3, repeating by code point order, share all words. A target stops at three times its source's size;
    the sources that stop first are those with the least words per weight, so the level that the others reach follows
    from running sums in that order.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name)).withColumn("_w", ((F.col("_rank") - 1) % 3 + 1).cast("double"))
    ranked = ranked.withColumns({"_cap": F.lit(float(MOST_PASSES)) * F.col("source_size"), "_ratio": F.lit(float(MOST_PASSES)) * F.col("source_size") / F.col("_w")})
    order = Window.orderBy("_ratio", "_rank")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everyone = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    ranked = ranked.withColumn("_level", level)
    # The common level is that of the first source that does not stop at it.
    free = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(everyone)
    ranked = ranked.withColumn("_common", free["_level"])
    target = F.least(F.col("_cap"), F.col("_w") * F.coalesce("_common", F.lit(0.0)))
    return ranked.select("source", "source_size", target.alias("target"), "_rank")


def _ratio(k: Column, marked: Column, drawn: Column, total: Column) -> Column:
    """P(k + 1) / P(k) of the hypergeometric distribution."""
    return (marked - k) * (drawn - k) / ((k + 1.0) * F.greatest(total - marked - drawn + k + 1.0, F.lit(1.0)))


def _hypergeometric(marked: Column, drawn: Column, total: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by inversion of ``u``.

    The sums run over 12 standard deviations to either side; what lies beyond is below the precision of a double.
    """
    m, n, t = (c.cast("double") for c in (marked, drawn, total))
    share = m / F.greatest(t, F.lit(1.0))
    spread = F.sqrt(F.greatest(n * share * (1.0 - share) * (t - n) / F.greatest(t - 1.0, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0.0), n - (t - m), F.floor(n * share - 12.0 * spread) - 2.0)
    high = F.least(m, n, F.ceil(n * share + 12.0 * spread) + 2.0)
    steps = F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))
    zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
    mass = F.aggregate(steps, zero, lambda a, k: F.struct((a["w"] * _ratio(k.cast("double"), m, n, t)).alias("w"), (a["s"] + a["w"]).alias("s")))["s"]
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), low.cast("long").alias("at"))
    return F.aggregate(
        steps,
        start,
        lambda a, k: F.struct(
            (a["w"] * _ratio(k.cast("double"), m, n, t)).alias("w"),
            (a["s"] + a["w"]).alias("s"),
            F.when(a["s"] + a["w"] <= u * mass, F.least(k + 1, high.cast("long"))).otherwise(a["at"]).alias("at"),
        ),
        lambda a: a["at"],
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _left_counts(counts: Column, blocks: Column, left: Column, node: Column) -> Column:
    """Blocks of each source that go to the left half: one hypergeometric draw after another on what is left."""
    start = F.struct(blocks.alias("t"), left.alias("n"), F.array().cast("array<bigint>").alias("out"))

    def step(a, i):
        own = F.element_at(counts, (i + 1).cast("int"))
        u = F.pmod(F.xxhash64(F.lit(SEED), node, i), F.lit(1 << 52)).cast("double") / float(1 << 52)
        return _bound(
            _hypergeometric(own, a["n"], a["t"], u),
            lambda d: F.struct((a["t"] - own).alias("t"), (a["n"] - d).alias("n"), F.concat(a["out"], F.array(d)).alias("out")),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, step, lambda a: a["out"])


def shard_quotas(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(_rank, shard, blocks): the blocks of each source that each output shard takes. ``quotas``: (_rank, blocks)."""
    total = quotas.agg(F.sum("blocks")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    upto = lambda s: F.expr(f"({s} * {total}L) div {shards}L")  # noqa: E731  blocks in the shards before s
    tree = quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "blocks"))), lambda x: x["blocks"]).alias("counts"))
    tree = tree.select("counts", F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi")).where(F.size("counts") > 0)
    for _ in range((shards - 1).bit_length()):
        middle = tree.withColumn("mid", F.expr("(lo + hi) div 2"))
        node = F.xxhash64("lo", "hi")
        middle = middle.withColumn("left", F.when(F.col("mid") > F.col("lo"), _left_counts(F.col("counts"), upto("hi") - upto("lo"), upto("mid") - upto("lo"), node)))
        halves = F.array(
            F.struct(F.col("left").alias("counts"), F.col("lo"), F.col("mid").alias("hi")),
            F.struct(F.zip_with("counts", "left", lambda c, d: c - d).alias("counts"), F.col("mid").alias("lo"), F.col("hi")),
        )
        whole = F.array(F.struct("counts", "lo", "hi"))
        tree = middle.select(F.explode(F.when(F.col("left").isNotNull(), halves).otherwise(whole)).alias("x")).select("x.*")
        tree = cut_lineage(tree, "mix-tree")
    return tree.select(F.col("lo").alias("shard"), F.posexplode("counts").alias("_p", "blocks")).select((F.col("_p") + 1).alias("_rank"), "shard", "blocks")


def placed_documents(docs: DataFrame) -> DataFrame:
    """Documents with their size, their source's target and the words ahead of them in their source's stream."""
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), key.alias("_key"))
    sized = cut_lineage(sized.withColumn("_range", F.substring("_key", 1, 3)), "mix-sizes")
    per_range = sized.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    goals = cut_lineage(targets(per_range.groupBy("source").agg(F.sum("_words").alias("source_size"))), "mix-targets")
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_range.withColumn("_ahead", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    ahead = cut_lineage(matched(ahead, goals, ["source"]), "mix-ranges")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "size")
    ranked = sized.withColumns(
        {"_row": F.row_number().over(inside), "_before": F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    )
    joined = matched(ranked, ahead, ["source", "_range"])
    return joined.withColumn("_before", F.col("_before") + F.col("_ahead")).drop("_ahead", "_key")


def draws(placed: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """What each shard takes: rows of ``placed`` with (shard, position, pass, from_word, words), one per block touched."""
    sources = placed.groupBy("_rank").agg(F.first("target").alias("target"))
    quotas = sources.select("_rank", F.ceil(F.round("target") / block_words).cast("long").alias("blocks"))
    split = cut_lineage(shard_quotas(cut_lineage(quotas, "mix-quotas"), shard_blocks), "mix-shards")
    upto = Window.partitionBy("_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ranges = split.withColumn("_end", F.sum("blocks").over(upto)).where("blocks > 0")
    owners = ranges.select("_rank", "shard", F.explode(F.sequence(F.col("_end") - F.col("blocks"), F.col("_end") - 1)).alias("_block"))
    passes = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))))
    passes = passes.withColumn("_a", F.col("pass") * F.col("source_size") + F.col("_before"))
    passes = passes.withColumn("_b", F.least(F.col("_a") + F.col("size"), F.round("target").cast("long"))).where("_b > _a")
    pieces = passes.withColumn("_block", F.explode(F.sequence(F.expr(f"_a div {block_words}"), F.expr(f"(_b - 1) div {block_words}"))))
    begin, end = F.greatest(F.col("_a"), F.col("_block") * block_words), F.least(F.col("_b"), (F.col("_block") + 1) * block_words)
    pieces = pieces.withColumns({"from_word": begin - F.col("_a"), "words": end - begin}).drop("_a", "_b")
    owned = pieces.join(owners, ["_rank", "_block"])
    mixed = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED), "shard", "_rank", "pass", "_range", "_row"), "_rank", "pass", "_range", "_row", "from_word")
    return owned.withColumn("position", F.row_number().over(mixed)).drop("_block")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row per document: how many of its words the mix takes and in how many shards they lie."""
    placed = cut_lineage(placed_documents(docs), "mix-placed")
    row = ["_rank", "_range", "_row"]
    got = draws(placed, block_words, shard_blocks).groupBy(*row).agg(F.sum("words").alias("taken"), F.countDistinct("shard").alias("shards"))
    return placed.join(got, row, "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("shards", F.lit(0)).alias("shards")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix with all columns of ``docs``, shard by shard and in each shard's shuffled order.

    A document comes as often as its source's stream passes it before the source's target is reached, each time into the
    shard that drew the block it starts in, at the place of its first word there. Texts stay whole: the last document of
    each source ends behind the target.
    """
    key = ["doc_id", "source", "_size"]
    placed = cut_lineage(placed_documents(docs), "mix-placed")
    row = ["_rank", "_range", "_row"]
    starts = draws(placed).where("from_word = 0").groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("shard", "position"))).alias("_places"))  # a few passes
    taken = placed.join(starts, row, "left").withColumnRenamed("size", "_size").withColumn("_places", F.coalesce("_places", F.array().cast(starts.schema["_places"].dataType)))
    taken = taken.groupBy(*key).agg(F.sort_array(F.collect_list("_places")).alias("_taken"))
    own = docs.select(whole_row(docs), "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("_size"), *[F.xxhash64(F.lit(i), text_or_empty()).alias(f"_h{i}") for i in (1, 2)])
    same = Window.partitionBy(*key).orderBy("_h1", "_h2")
    rows = matched(own.withColumn("_at", F.row_number().over(same)).drop("_h1", "_h2"), taken, key)
    rows = rows.select("_row", F.explode(F.element_at("_taken", F.col("_at"))).alias("_place"))
    return rows.repartitionByRange(F.col("_place.shard"), F.col("_place.position")).sortWithinPartitions("_place.shard", "_place.position").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source", "shards")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, ((r - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / w AS ratio,
             (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
c AS (SELECT arg_min(lvl, ratio) AS common FROM l WHERE lvl <= ratio),
t AS (SELECT source, source_size, least(cap, w * coalesce(common, 0)) AS target FROM l, c),
p AS (SELECT d.doc_id, size, source_size, target, round(target)::BIGINT AS goal,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(size, greatest(0, goal - before)) + least(size, greatest(0, goal - source_size - before))
        + least(size, greatest(0, goal - 2 * source_size - before)))::BIGINT AS taken FROM p
"""
