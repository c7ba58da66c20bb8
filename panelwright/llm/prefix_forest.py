"""Nearest neighbours by a forest of sorted hash prefixes.

A tree hashes every vector to a string of ``bits`` signs of random projections (around the median of the index rows) and
keeps the strings sorted. A query descends to the longest prefix it shares with any string by binary search; then all
trees ascend together, one bit at a time, until the ranges of rows with the shorter prefix are wide enough. A row counts
once for every bit it shares beyond that prefix, in every tree: near rows share long prefixes in many trees. The rows with
the highest counts are the candidates, a quarter of the shard unless ``candidates`` says how many (all rows of a shard of
250 or fewer; rows of equal count stay together). They are compared by their exact cosine in double precision.

The index is cut into shards of about ``shard_rows`` rows by a hash of the row, each a forest of its own; the stated
query set is cut into groups, and every group meets every shard once. What a task holds is one shard and one group of
queries. Each returns the best few of its shard, of which the best of all are taken.

Vectors that are NULL, zero, hold NULL or non-finite components, or have another length than most, take no part. Equal
vectors are candidates each; ties go to the smaller id, and a repeated row competes as often as it occurs. A query is
never its own candidate (all rows with its id are left out). Rows with a NULL id take no part. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import cut_lineage

TREES = 32
BITS = 32
SHARD_ROWS = 8192
GROUP_ROWS = 4096
CANDIDATE_SHARE = 4
LEAST_CANDIDATES = 50
ASCENT = 32
NEAREST = 5
EXACT_ROWS = 1024


def usable(embedding: Column) -> Column:
    """Whether a vector has only finite components, not all of them zero."""
    numbers = F.transform(embedding, lambda x: x.cast("double"))
    good = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & good & F.exists(numbers, lambda x: x != 0), F.lit(False))


def projections(dims: int, trees: int, bits: int) -> np.ndarray:
    """Random directions, orthogonal within a tree as far as there are dimensions; the same for every shard."""
    rng = np.random.default_rng(20240607)
    blocks = []
    for _ in range(trees):
        parts, have = [], 0
        while have < bits:
            parts.append(np.linalg.qr(rng.standard_normal((dims, dims)))[0])
            have += dims
        blocks.append(np.concatenate(parts, axis=1)[:, :bits])
    return np.concatenate(blocks, axis=1)


class Forest:
    """Sorted hash strings of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int, bits: int):
        self.ids, self.vectors, self.trees, self.bits = ids, vectors, trees, bits
        self.unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
        self.directions = projections(vectors.shape[1], trees, bits)
        self.middle = np.median(self.unit @ self.directions, axis=0)
        strings = self._strings(self.unit)
        self.order = np.argsort(strings, axis=0, kind="stable").T
        self.sorted = np.sort(strings, axis=0).T

    def _strings(self, unit: np.ndarray) -> np.ndarray:
        """One integer per row and tree: the string of its signs, first sign highest."""
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        out = np.empty((len(unit), self.trees), dtype=np.uint64)
        for t in range(self.trees):
            at = slice(t * self.bits, (t + 1) * self.bits)
            out[:, t] = ((unit @ self.directions[:, at] > self.middle[at]).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return out

    def candidates(self, queries: np.ndarray, wanted: int):
        """For each query the rows that share a prefix with it in some tree, from long prefixes to short ones."""
        strings = self._strings(queries / np.sqrt((queries**2).sum(axis=1, keepdims=True)))
        n = len(self.ids)
        low = np.zeros((self.bits + 1, self.trees, len(queries)), dtype=np.int32)
        high = np.full_like(low, n)
        for length in range(1, self.bits + 1):
            tail = np.uint64((1 << (self.bits - length)) - 1)
            for t in range(self.trees):
                low[length, t] = np.searchsorted(self.sorted[t], strings[:, t] & ~tail, side="left")
                high[length, t] = np.searchsorted(self.sorted[t], strings[:, t] | tail, side="right")
        enough = min(wanted, n)
        for i in range(len(queries)):
            sizes = (high[:, :, i] - low[:, :, i]).sum(axis=1)
            level = self.bits
            while level and sizes[level] < min(ASCENT * enough, self.trees * n):  # all trees ascend together
                level -= 1
            count = np.zeros(n, dtype=np.int32)
            for t in range(self.trees):
                begin, end = low[level, t, i], high[level, t, i]
                shared = np.ones(end - begin, dtype=np.int32)
                for longer in range(level + 1, self.bits + 1):
                    if low[longer, t, i] == high[longer, t, i]:
                        break
                    shared[low[longer, t, i] - begin : high[longer, t, i] - begin] += 1
                count[self.order[t, begin:end]] += shared
            found = np.flatnonzero(count)
            if len(found) > enough:
                found = found[count[found] >= np.partition(count[found], -enough)[-enough]]
            yield i, found

    def search(self, query_ids: np.ndarray, queries: np.ndarray, nearest: int, wanted: int | None):
        """(query_id, vec_id, score) of the best candidates of each query in this shard."""
        wanted = max(LEAST_CANDIDATES * nearest, len(self.ids) // CANDIDATE_SHARE) if wanted is None else wanted
        norms = np.sqrt((queries**2).sum(axis=1))
        own = np.sqrt((self.vectors**2).sum(axis=1))
        for start in range(0, len(queries), 512):
            part = queries[start : start + 512]
            for i, rows in self.candidates(part, wanted):
                rows = rows[self.ids[rows] != query_ids[start + i]]
                score = (self.vectors[rows] @ part[i]) / (own[rows] * norms[start + i])
                if len(rows) > nearest:  # ties at the border stay
                    keep = score >= np.partition(score, -nearest)[-nearest] - 1e-9
                    rows, score = rows[keep], score[keep]
                # The exact measure once more for all that are left, summed in the order of the components.
                blocks = [rows[k : k + EXACT_ROWS] for k in range(0, len(rows), EXACT_ROWS)]
                sums = [np.cumsum(self.vectors[block] * part[i], axis=1)[:, -1] for block in blocks]
                exact = np.concatenate([score[:0], *sums]) / (own[rows] * norms[start + i])
                best = np.lexsort((self.ids[rows], -exact))[:nearest]
                for b in best:
                    yield int(query_ids[start + i]), int(self.ids[rows[b]]), float(exact[b])


def nearest_neighbours(
    index: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    trees: int = TREES,
    bits: int = BITS,
    shard_rows: int = SHARD_ROWS,
    candidates: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``index`` and ``queries``, both (vec_id, embedding)."""
    clean = lambda df: df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows, asked = clean(index), clean(queries)
    usual = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return index.sparkSession.createDataFrame([], schema)
    dims = usual["d"]
    rows, asked = rows.where(F.size("embedding") == dims), asked.where(F.size("embedding") == dims)
    total, queries_total = rows.count(), asked.count()
    shards, groups = max(1, -(-total // shard_rows)), max(1, -(-queries_total // GROUP_ROWS))
    # A row's shard is its hash, salted by a number so that copies of one row spread too.
    shard = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    rows = cut_lineage(rows.withColumn("shard", shard), "forest-rows")
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(groups)).cast("int"))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def arrays(table):
        table = table.combine_chunks()
        vectors = table.column("embedding").combine_chunks()
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        return ids[order], flat.reshape(len(ids), dims)[order]

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not len(mine) or not len(theirs):
            return out.empty_table()
        found = list(Forest(*arrays(mine), trees, bits).search(*arrays(theirs), nearest, candidates))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), out, strict=True)], schema=out) if found else out.empty_table()

    met = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))
