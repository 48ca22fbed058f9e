"""Exact top-k search by Hamming distance: incremental multi-index hashing (operator 9).

Codes have 64 bits. A block of codes is indexed by each of m segments of the code. A
query probes the segments with all values at 0, 1, 2 ... flipped bits; what it finds is
verified by its full distance. When segments 0..j have been probed with r flips and the
others with r - 1, every code up to distance m r + j has been found (one that was not
differs by more than r bits in j + 1 segments and by r or more in the others), so the
search stops as soon as the kth verified distance is no larger than that: the result is
exact, and a block that the query isn't near is left after the radii that prove it.

Rows with equal codes are one entry with their k + 1 smallest ids, so a vector that a
third of the rows share is one entry; equal queries are searched once. Entries and
queries go into a grid of blocks (by hash): each pair of an entry block and a query block
is one task's work, with memory bounded by the two block sizes. The k + 1 best of the
entry blocks of a query are merged by a window whose limit is applied before the shuffle.

Defined results
* neighbours are ordered by distance, then id; the query's own row is no neighbour, other
  rows with the same code are, at distance 0;
* rows repeated verbatim count once; an id on several vectors is several rows;
* a null id or a null or empty vector takes no part, as query or as neighbour; null
  elements count as 0;
* fewer than k other rows: all of them; an empty table gives an empty result; other columns
  are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from churnlens.llm.common import col_of, staged

BITS = 64
ENTRY_BLOCK, QUERY_BLOCK = 1 << 16, 1 << 12

_CODES = T.StructType([T.StructField("id", T.LongType()), T.StructField("code", T.LongType())])
_FOUND = T.StructType([T.StructField("q", T.LongType()), T.StructField("d", T.IntegerType()), T.StructField("id", T.LongType())])


def sign_codes(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, code: bit j tells whether the elements at j, j + 64, ... add up to more than 0
    (with up to 64 dimensions: the sign of element j)."""

    def batches(rows):
        for rec in rows:
            ids, codes = [], []
            for i, vec in zip(rec.column(0).to_pylist(), rec.column(1)):
                v = None if not vec.is_valid else np.nan_to_num(vec.values.fill_null(0).to_numpy(zero_copy_only=False))
                if i is not None and v is not None and len(v):
                    folded = np.pad(v, (0, -len(v) % BITS)).reshape(-1, BITS).sum(axis=0)
                    ids.append(i)
                    codes.append(np.packbits(folded > 0, bitorder="little").view("<i8")[0])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(codes, pa.int64())], names=_CODES.names)

    picked = df.select(col_of(id_col).cast("bigint"), col_of(vec_col).cast("array<float>"))
    return picked.mapInArrow(batches, _CODES).distinct()


class MultiIndex:
    """One block of codes, indexed by segments."""

    def __init__(self, codes: np.ndarray, members: np.ndarray):
        self.codes, self.members = codes, members
        width = min(16, max(4, int(np.log2(max(len(codes), 2)))))  # about one code for each segment value
        self.cuts = [*range(0, BITS, width), BITS]
        if len(self.cuts) > 2 and BITS - self.cuts[-2] < 4:  # no tiny last segment
            del self.cuts[-2]
        self.order, self.starts, self.masks = [], [], []
        for a, b in zip(self.cuts, self.cuts[1:]):
            value = self._segment(codes, a, b)
            self.order.append(np.argsort(value, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (b - a)))]))

    @staticmethod
    def _segment(codes, a: int, b: int):
        return ((codes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)

    def nearest(self, query: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of all codes that the k nearest rows can be among."""
        m = len(self.order)
        seen = np.zeros(len(self.codes), dtype=bool)
        found, dist = [], []
        rows_at = np.zeros(BITS + 1, dtype=np.int64)
        for r in range(BITS + 1):
            for j, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
                if r <= b - a:
                    probes = self._segment(query, a, b) ^ flips(b - a, r)
                    lo, n = self.starts[j][probes], self.starts[j][probes + 1] - self.starts[j][probes]
                    hit = n > 0
                    lo, n = lo[hit], n[hit]
                    at = self.order[j][np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)]
                    at = at[~seen[at]]
                    if len(at):
                        seen[at] = True
                        d = np.bitwise_count(self.codes[at] ^ query).astype(np.int64)
                        found.append(at)
                        dist.append(d)
                        rows_at += np.bincount(d, weights=self.members[at], minlength=BITS + 1).astype(np.int64)
                covered = m * r + j
                if rows_at[: covered + 1].sum() >= k or covered >= BITS:
                    at, d = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, dist))
                    near = d <= covered
                    return at[near], d[near]
        raise AssertionError("a radius of all bits covers everything")


_flips: dict[tuple[int, int], np.ndarray] = {}


def flips(width: int, r: int) -> np.ndarray:
    """All masks of ``width`` bits with r bits set."""
    if (width, r) not in _flips:
        _flips[width, r] = np.array([sum(1 << b for b in c) for c in combinations(range(width), r)], dtype=np.int64)
    return _flips[width, r]


def _search(k: int):
    def search(key: tuple, queries: pa.Table, entries: pa.Table) -> pa.Table:
        out_q, out_d, out_id = [], [], []
        if queries.num_rows and entries.num_rows:
            ids = entries.column("ids").combine_chunks()
            offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            index = MultiIndex(entries.column("code").to_numpy().view(np.uint64), np.diff(offsets))
            for q in queries.column("code").to_numpy():
                at, d = index.nearest(q.view(np.uint64), k)
                members = index.members[at]
                rows = np.arange(members.sum()) + np.repeat(offsets[at] - np.cumsum(members) + members, members)
                d, near = np.repeat(d, members), flat[rows]
                best = np.lexsort((near, d))[:k]
                out_q.append(np.full(len(best), q))
                out_d.append(d[best])
                out_id.append(near[best])
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        return pa.table([pa.array(cat(out_q), pa.int64()), pa.array(cat(out_d).astype(np.int32)), pa.array(cat(out_id), pa.int64())], names=_FOUND.names)

    return search


def _block(code: str, seed: int, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), code), F.lit(n))


def top_k(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id, distance: the k rows nearest to each row for which
    ``is_query`` (over the column ``id``) holds."""
    rows = staged(sign_codes(df, id_col, vec_col), "codes")
    by_code = Window.partitionBy("code").orderBy("id")
    entries = (
        rows.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k + 1)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most k + 1
    )
    entries = staged(entries, "entries")
    queries = rows.where(is_query)
    codes = staged(queries.select("code").distinct(), "queries")

    n_entry = max(1, -(-entries.count() // ENTRY_BLOCK))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_query = max(1, -(-codes.count() // QUERY_BLOCK), -(-tasks // n_entry))
    each = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    left = codes.select("code", _block("code", 1, n_query).alias("qb"), each(n_entry).alias("eb"))
    right = entries.select("code", "ids", _block("code", 2, n_entry).alias("eb"), each(n_query).alias("qb"))
    found = left.groupBy("qb", "eb").cogroup(right.groupBy("qb", "eb")).applyInArrow(_search(k + 1), _FOUND)

    order = Window.partitionBy("q").orderBy("d", "id")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    pairs = queries.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(best, "q")
    # a neighbour with the query's id and code is the query itself
    others = pairs.where((F.col("d") != 0) | (F.col("id") != F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("d", "id"))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "id", F.col("d").cast("long").alias("distance"))
