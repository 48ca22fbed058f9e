"""Near-duplicate groups: circulant MinHash, banding, exact Jaccard (operator 3).

A document's set holds its distinct 5-word shingles (``shingles.shingle_sets``); two
documents are linked if 100 |A & B| >= 75 |A | B|, and the groups are the connected
components of the links.

1. One pass over the texts gives each document its set's 128-bit digest and the keys of
   32 bands of 4 circulant MinHash coordinates. Two sets at exactly 0.75 share no band
   with probability (1 - 0.75**4)**32 = 5e-6; more similar ones far less.
2. Documents with equal sets are one class, the vertex of all that follows: thousands of
   copies are one row.
3. Each bucket (a band key with several classes; of buckets with the same members, which
   near copies have by the dozen, one) compares its members with its most popular one, on
   full sets; linked classes contract to components. A bucket whose
   members are in one component is done, for no link in it can change the result: a bucket
   with thousands of near copies costs one pass over its members.
4. The members of all other buckets, most of them texts that share a passage and are no
   copies, go through an exact prefix filter: with the shingles of a set ordered from rare
   to common, two linked sets share one of the first |A| - ceil(0.75 |A|) + 1. The common
   passage is at the end of that order. These finer buckets are worked off in rounds: those
   with up to ``SMALL`` members outside their largest component compare all members of
   different components, the others one pivot. A member leaves a bucket when what it has
   from the bucket's shingle on can no longer reach the overlap that the bucket's smallest
   set asks for. Each round takes on buckets ``MORE`` times as large as the one before, so
   the number of rounds follows the logarithm of the largest bucket. They go on until every
   bucket is done: nothing is capped.

No bucket is ever collected: pivots and counts are aggregates, pairs are joins whose
condition holds the sizes and places that rule a link out, and a round with one pivot makes
one pair for each member. Sets are compared only for classes in some bucket.

Defined results
* null or empty texts and texts of white space only have no set: n_shingles 0, linked
  with nothing, their own component;
* one to four words: the whole sequence is the one shingle;
* equal sets (also in equal texts) are one component; its id is the smallest doc_id, a
  null id only if it has no other;
* repeated rows: each gives a row of the result; the same id with different texts joins
  nothing by itself;
* a very long text is a slice of its own, its distinct shingles held once as numbers;
* an empty table gives an empty result; other columns are not touched, whatever their names
  (``keep_one`` returns them).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm import shingles as S
from churnlens.llm.common import bounded_broadcast, col_of, free_name, staged, text_slices, tidy
from churnlens.llm.components import relabel, roots

BANDS, BAND_ROWS = 32, 4
SMALL, MORE = 128, 4
FEW_PAIRS = 200_000  # pairs of two digests that are broadcast

_SIGNED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("h", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("v", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])
_SETS = T.StructType([
    T.StructField("v", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("items", T.ArrayType(T.LongType())),
])


def signed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h (the text's 64-bit hash), n (set size), v (the set's digest; null if empty),
    bands (keys)."""

    def sign(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = S.shingle_sets(part.column(2).to_pylist())
        some = [s for s in sets if len(s)]
        keys = S.band_keys(S.signatures(some, BANDS * BAND_ROWS), BAND_ROWS)
        ends, at = [], 0
        for s in sets:
            ends.append(at)
            at += BANDS * bool(len(s))
        return pa.record_batch([
            part.column(0), part.column(1), pa.array([len(s) for s in sets]), pa.array([S.digest(s) for s in sets], pa.binary()),
            pa.ListArray.from_arrays(pa.array([*ends, at], pa.int32()), pa.array(keys.ravel())),
        ], names=_SIGNED.names)

    def batches(rows):
        with tidy():
            for rec in rows:
                for part in text_slices(rec, 2):
                    yield sign(part)

    text = col_of(text_col).cast("string")
    return df.select(col_of(id_col).cast("bigint"), F.xxhash64(text), text).mapInArrow(batches, _SIGNED)


def _of_ids(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id (null too) is one of ``wanted``'s, without a shuffle of wide rows:
    the ids are broadcast as bits, 64 neighbours in one row, unless that is too much."""
    word = F.shiftright(F.coalesce("id", F.lit(0)), 6)
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    marks = wanted.groupBy(word.alias("_word")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0)).alias("_bits"), F.max(F.col("id").isNull()).alias("_null"))
    hit = F.when(F.col("id").isNull(), F.col("_null")).otherwise(F.col("_bits").bitwiseAND(bit) != 0)
    return rows.join(bounded_broadcast(marks), word == F.col("_word")).where(hit).select(rows["*"])


def sets_of(df: DataFrame, docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """v, size, items of the classes in ``wanted`` (v, id of one of its documents), each
    once; also of other texts that share an id with them. ``docs``: id and v of all rows."""

    def batches(rows):
        with tidy():
            for rec in rows:
                for part in text_slices(rec, 0):
                    sets = S.shingle_sets(part.column(0).to_pylist())
                    yield pa.record_batch([
                        pa.array([S.digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets]),
                        pa.array([s.view("int64") for s in sets], pa.list_(pa.int64())),
                    ], names=_SETS.names)

    texts = df.select(col_of(id_col).cast("bigint").alias("id"), col_of(text_col).cast("string").alias("t"))
    found = _of_ids(texts, wanted).select("t").mapInArrow(batches, _SETS)
    met = _of_ids(docs.select("id", "v"), wanted).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    if met.where("n > 1").isEmpty():
        return found
    return found.join(wanted.select("v"), "v", "left_semi").dropDuplicates(["v"])  # an id stands on several rows


def _reaches(overlap, a, b):
    """Whether an overlap can make 100 i >= 75 (a + b - i)."""
    return overlap * 7 >= (a + b) * 3


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) whose full sets are similar enough."""
    few = pairs.count() <= FEW_PAIRS

    def side(x: str) -> DataFrame:
        items = sets.select(F.col("v").alias(x), F.col("items").alias(f"{x}_items"))
        return items.join(F.broadcast(pairs.select(x)), x, "left_semi") if few else items  # shuffle only what is compared

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("a_items", "b_items"))
    return both.where(_reaches(overlap, F.size("a_items"), F.size("b_items"))).select(pairs.columns)


class _Rounds:
    """Works off buckets: members (key, v, size, rest) with rest the largest overlap that
    a member can have with one that shares the key; labels (v, c, pop) with the component
    and the popularity, the number of others in a class's buckets. The most popular member
    of a bucket is its pivot: the text that most copies in it were made from."""

    def __init__(self, members: DataFrame, labels: DataFrame, sets: DataFrame):
        self.members, self.labels, self.sets = members, labels, sets

    def left(self) -> DataFrame:
        """Members of buckets that still hold several components, with their bucket's
        pivot, its largest component and how many members that one doesn't have."""
        m = self.members.join(self.labels, "v")
        parts = m.groupBy("key", "c").agg(
            F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max(F.struct("pop", "v", "c", "size", "rest")).alias("pivot"))
        stats = parts.groupBy("key").agg(
            (F.sum("n") - F.max("n")).alias("minor"), F.max_by("c", "n").alias("major"),
            F.min("least").alias("least"), F.max("pivot").alias("pivot")).where("minor > 0")
        stats = staged(stats, "buckets")  # both sides of the join are then shuffles, which can be split at a hot bucket
        return m.join(stats, "key").where(_reaches(F.col("rest"), F.col("size"), F.col("least")))

    def run(self, small: int) -> bool:
        """One round: all pairs of different components in buckets with up to ``small``
        members outside their largest component, one star in each other one. Leaves the
        members that aren't done. False if all were done before."""
        live = staged(self.left(), "live")
        if live.isEmpty():
            return False
        star = live.where(F.col("minor") > small).where(
            (F.col("v") != F.col("pivot.v")) & (F.col("c") != F.col("pivot.c"))
            & _reaches(F.least("rest", "pivot.rest"), F.col("size"), F.col("pivot.size"))
        ).select(F.col("v").alias("a"), F.col("c").alias("ca"), F.col("pivot.v").alias("b"), F.col("pivot.c").alias("cb"))
        few = live.where(F.col("minor") <= small)
        other = few.where("c != major").select("key", *[F.col(x).alias(f"o_{x}") for x in ("v", "c", "size", "rest")])
        cross = few.join(other, "key").where(
            (F.col("c") != F.col("o_c")) & _reaches(F.least("rest", "o_rest"), F.col("size"), F.col("o_size"))
        ).select(F.col("v").alias("a"), F.col("c").alias("ca"), F.col("o_v").alias("b"), F.col("o_c").alias("cb"))
        pairs = star.unionByName(cross).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb"))
        pairs = staged(pairs.dropDuplicates(["a", "b"]), "pairs")
        left = live.where((F.col("minor") > small) & (F.col("v") != F.col("pivot.v")))
        self.members = left.select("key", "v", "size", "rest")
        if not pairs.isEmpty():
            links = linked(pairs, self.sets).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
            self.labels = staged(relabel(self.labels, roots(links)), "labels")
        return True


def _prefixes(sets: DataFrame) -> DataFrame:
    """Members of the prefix buckets of ``sets``: key (a shingle), v, size, rest. Shingles
    of one set only come first in the order and make no bucket: they are only counted."""
    items = sets.select("v", "size", F.explode("items").alias("key"))
    common = items.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = items.join(common, "key").groupBy("v", "size").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("o"))
    alone = F.col("size") - F.size("o")
    ordered = ordered.withColumn("alone", alone).withColumn("n", F.expr("cast(size - ceil(0.75 * size) + 1 - alone as int)"))
    head = ordered.where("n > 0").select("v", "size", "alone", F.posexplode(F.slice("o", F.lit(1), F.col("n"))))
    return head.select("col.key", "v", "size", (F.col("size") - F.col("alone") - F.col("pos")).alias("rest"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``df``: id, n_shingles, component_id, kept, text_hash."""
    docs = staged(signed(df, id_col, text_col), "signed")
    names = [f"b{i}" for i in range(BANDS)]  # as longs: an aggregate without a sort
    classes = docs.where("v IS NOT NULL").groupBy("v").agg(
        F.min("id").alias("id"), F.first("n").alias("size"), *[F.first(F.col("bands")[i]).alias(x) for i, x in enumerate(names)])
    classes = staged(classes.select("v", "id", "size", F.array(*names).alias("bands")), "classes")
    marks = classes.select(F.xxhash64("v").alias("x"), F.xxhash64("v", F.lit(1)).alias("y"), F.explode("bands").alias("key"))
    shared = marks.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    shared = shared.where("m > 1").groupBy("m", "x", "y").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("same"))
    member = classes.select("v", "id", "size", F.explode("bands").alias("key"))
    members = staged(member.join(shared.select("key", (F.col("m") * F.col("same")).alias("m")), "key"), "members")
    wanted = staged(members.groupBy("v").agg(F.min("id").alias("id"), F.sum("m").alias("pop")), "wanted")
    sets = staged(sets_of(df, docs, wanted, id_col, text_col), "sets")

    rounds = _Rounds(
        members.select("key", "v", "size", F.col("size").alias("rest")),
        wanted.select("v", F.col("v").alias("c"), "pop"), sets)
    if rounds.run(small=0):
        rest = staged(rounds.left().select("v").distinct(), "rest")
        rounds.members = staged(_prefixes(sets.join(bounded_broadcast(rest, FEW_PAIRS), "v", "left_semi")), "prefixes")
        small = SMALL
        while rounds.run(small):
            small *= MORE

    group = staged(rounds.labels.join(wanted.select("v", "id"), "v"), "group")
    least = staged(group.groupBy("c").agg(F.min("id").alias("least")), "least")  # so that a hot component's join can be split
    component = group.join(least, "c").select("v", "least")
    # classes in no bucket are their own component; hot classes: partial minimum, then a join
    alone = docs.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("own"))
    known = alone.join(component, "v", "left").select("v", F.coalesce("least", "own").alias("component_id"))
    with_set = docs.where("v IS NOT NULL").select("id", "h", "n", "v").join(staged(known, "known"), "v")
    no_set = docs.where("v IS NULL").select("id", "h", "n", "v", F.col("id").alias("component_id"))
    out = with_set.select(no_set.columns).unionByName(no_set)
    return out.select(
        "id", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("h").alias("text_hash"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of each component the row
    whose id names it (one of them, if it is repeated), and all rows without words."""
    key, text_hash = (free_name(df, x) for x in ("_id", "_hash"))
    found = near_duplicates(df, id_col, text_col).groupBy("id", "text_hash").agg(
        F.max("kept").alias("kept"), F.sum((F.col("kept") & (F.col("n_shingles") > 0)).cast("int")).alias("copies"))
    # what goes or is repeated is the lesser part and has no text: the rows need no shuffle if it is small
    other = staged(found.where(~F.col("kept") | (F.col("copies") > 1)).select("id", "text_hash", "kept"), "other")
    rows = df.withColumn(key, col_of(id_col).cast("bigint")).withColumn(text_hash, F.xxhash64(col_of(text_col).cast("string")))
    named = bounded_broadcast(other, FEW_PAIRS)
    met = rows.join(named, rows[key].eqNullSafe(named["id"]) & (rows[text_hash] == named["text_hash"]), "left")
    out = met.where(named["kept"].isNull()).select(rows["*"])
    if not other.where("kept").isEmpty():
        out = out.unionByName(met.where(named["kept"]).select(rows["*"]).dropDuplicates([key, text_hash]))
    return out.select(*[col_of(c) for c in df.columns])
