"""Exact duplicates by naming blocks: equal texts, and only those, get the same name.

Texts without white space are cut into blocks of fixed size. The distinct blocks are sorted and numbered; then the
names of adjacent blocks form pairs, the distinct pairs are sorted and numbered, and so on until each text has one
name. Names stand for sorted content, not for hash values, so they cannot collide.

Numbers are dense ranks inside buckets of a hash of the content: the bucket only says which task sorts, and a rank
depends on nothing but the bucket's content, so a recomputed task gives the same names. Content that makes up more than
a thousandth of all rows (fewer than 1 000 blocks or pairs, hence broadcast) is named first, and its rows are spread.

NULL texts count as empty; empty texts are equal to each other; rows that repeat as a whole count as several rows of
which one stays; a NULL ``doc_id`` comes after all others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import matched, text_or_empty, whole_row, without_white
from panelwright.session import cut_lineage

BLOCK_CHARS = 2048
HOT_SHARE = 1000
BUCKETS = 1 << 20
KEY = ["doc_id", "n_points", "sha"]


def _named(rows: DataFrame, content: Sequence[str], hot: DataFrame) -> DataFrame:
    """``rows`` with ``_name`` for their content; ``hot`` has the names of the frequent content."""
    rows = matched(rows, F.broadcast(hot.withColumnRenamed("_name", "_hot")), content, "left")
    is_hot = F.col("_hot").isNotNull()
    spread = F.when(is_hot, F.xxhash64("doc_id", "_i")).otherwise(F.xxhash64(*content))
    rows = rows.withColumn("_bucket", F.pmod(spread, F.lit(BUCKETS)))
    rows = rows.withColumns({c: F.when(~is_hot, F.col(c)) for c in content})
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*content)).cast("long")
    name = F.col("_bucket") * F.lit(1 << 32) + rank
    return rows.withColumn("_name", F.coalesce("_hot", name)).drop("_hot", "_bucket", *content)


def _hot_names(contents: DataFrame, content: Sequence[str]) -> DataFrame:
    """Negative names, below those of any bucket, for fewer than ``HOT_SHARE`` frequent contents."""
    order = Window.orderBy(*content)
    return contents.select(*content, (-F.row_number().over(order)).cast("long").alias("_name"))


def _frequent(rows: DataFrame, by: Sequence[str], total: int) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * HOT_SHARE > total)


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per different (doc_id, n_points, sha) with its number of ``copies`` and its identity (level, name)."""
    base = docs.select("doc_id", text_or_empty().alias("text"))
    bare = base.select("doc_id", F.length("text").cast("long").alias("n_points"), without_white(F.col("text")).alias("_bare"))
    bare = bare.withColumn("sha", F.unhex(F.sha2(F.col("_bare").cast("binary"), 256)))
    pieces = F.regexp_extract_all("_bare", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))

    hashes = F.transform(pieces, lambda b: F.xxhash64(b))
    meta = cut_lineage(
        bare.select(*KEY, hashes.alias("_hashes")).groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.first("_hashes").alias("_hashes")),
        "naming-meta",
    )
    exploded = meta.select(*KEY, F.explode("_hashes").alias("_hash"))
    total, longest = meta.select(F.sum(F.size("_hashes")), F.max(F.size("_hashes"))).first()
    total, longest = total or 0, longest or 0
    example = matched(exploded, F.broadcast(_frequent(exploded, ["_hash"], total)), ["_hash"]).groupBy("_hash").agg(F.min(F.struct(*KEY)).alias("_k"))
    example = example.select("_hash", "_k.*")
    sources = matched(bare, F.broadcast(example.select(*KEY).distinct()), KEY)
    seen = sources.select(F.explode(F.transform(pieces, lambda b: F.struct(b.alias("_block"), F.xxhash64(b).alias("_hash")))).alias("_b")).select("_b.*").distinct()
    hot = _hot_names(matched(seen, F.broadcast(example), ["_hash"], "left_semi"), ["_block"])

    blocks = bare.select(*KEY, F.posexplode(pieces).alias("_i", "_block"))
    names = cut_lineage(_named(blocks, ["_block"], hot), "naming-0")
    done, level = [], 0
    while longest > 1:
        pairs = cut_lineage(
            names.groupBy(*KEY, F.expr("_i div 2").alias("_i")).agg(
                F.max(F.when(F.col("_i") % 2 == 0, F.col("_name"))).alias("_a"), F.max(F.when(F.col("_i") % 2 == 1, F.col("_name"))).alias("_b")
            ),
            f"naming-pairs-{level}",
        )
        # A text with one name left is finished: it is its own pair without a second half.
        single = (F.col("_i") == 0) & F.col("_b").isNull()
        done.append(pairs.where(single).select(*KEY, F.lit(level).alias("level"), F.col("_a").alias("name")))
        rest = pairs.where(~single).withColumn("_b", F.coalesce("_b", F.lit(0)))
        hot = _hot_names(_frequent(rest, ["_a", "_b"], rest.count()), ["_a", "_b"])
        names = cut_lineage(_named(rest, ["_a", "_b"], hot), f"naming-{level + 1}")
        level, longest = level + 1, (longest + 1) // 2
    last = names.groupBy(*KEY).agg(F.max("_name").alias("name")).select(*KEY, F.lit(level).alias("level"), "name")
    found = last
    for part in done:
        found = found.unionByName(part)
    return matched(meta.drop("_hashes"), found, KEY, "left").withColumns({"level": F.coalesce("level", F.lit(-1)), "name": F.coalesce("name", F.lit(0))})


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays, and the group's size.

    Of equal texts the row with the most code points stays, then the smallest ``doc_id``.
    """
    named = cut_lineage(identities(docs, block_chars), "naming-identities")
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d")))
    groups = cut_lineage(
        named.groupBy("level", "name").agg(best.alias("_best"), F.sum("copies").alias("group_size")).where("group_size > 1"), "naming-groups"
    )
    joined = named.join(groups, ["level", "name"], "left")
    alone = F.col("_best").isNull()
    rows = joined.withColumns(
        {
            "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("_best.d")),
            "group_size": F.coalesce("group_size", F.lit(1)).cast("long"),
            "_first": alone | (F.col("_best.d").eqNullSafe(F.col("doc_id")) & (F.col("_best.p") == -F.col("n_points"))),
        }
    )
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("_first") & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "n_points", "copies",
    )


def drop_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = cut_lineage(exact_duplicates(docs, block_chars), "naming-found").withColumn("sha", F.unhex("text_sha256"))
    gone = found.groupBy(*KEY).agg(F.max(F.col("kept").cast("int")).alias("_stays"), F.max("copies").alias("_copies"))
    own = docs.select(
        whole_row(docs), "doc_id", F.length(text_or_empty()).cast("long").alias("_n"), F.unhex(F.sha2(without_white(text_or_empty()).cast("binary"), 256)).alias("_sha")
    )
    match = lambda right: [F.col(a).eqNullSafe(right[b]) for a, b in (("doc_id", "_d"), ("_n", "_p"), ("_sha", "_s"))]
    renamed = gone.toDF("_d", "_p", "_s", "_stays", "_copies")
    dropped, several = renamed.where("_stays = 0"), renamed.where("_stays = 1 and _copies > 1")
    single = own.join(dropped, match(dropped), "left_anti")
    if several.isEmpty():
        return single.select("_row.*")
    once = own.join(several, match(several), "left_semi").dropDuplicates(["doc_id", "_n", "_sha"])
    return single.join(several, match(several), "left_anti").unionByName(once).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).drop("n_points", "copies")


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS p, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
r AS (SELECT doc_id, t, count(*) OVER g AS group_size, first_value(doc_id) OVER o AS keep_id, row_number() OVER o AS rn
      FROM d WINDOW g AS (PARTITION BY t), o AS (PARTITION BY t ORDER BY p DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(t) AS text_sha256 FROM r
"""
