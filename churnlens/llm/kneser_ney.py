"""Quality classifier: interpolated modified Kneser-Ney model of trusted text (operator 7).

Trusted text is what labels call good (quality 1, not toxic). The model is of order 4
over UTF-16 code units, one for each language: an n-gram is one 64-bit integer, so all
of Unicode is covered without a vocabulary.

Training, all of it joins and aggregates sharded by n-gram: tasks count the n-grams of
their texts (numpy, one row for each distinct n-gram of a task), a shuffle adds them up;
lower orders count the distinct left extensions; discounts D1, D2, D3+ come from the
counts of counts of each language and order; the probability of an n-gram joins its
count with its context's total and its suffix's probability of the order below.

Scoring: the tables go to the tasks in shards of at most ``SHARD_ROWS`` rows. A shard
holds all n-grams whose last but one unit hashes to it, so each text position is scored
wholly by one shard, and a text's log probability is the sum over shards. With one
shard there is one pass over the texts; a model k times as large takes k passes, the
scores so far being written to the shared folder between them. What is broadcast never
exceeds ``SHARD_ROWS`` rows.

Thresholds: one trusted document in ``HELD_OUT`` (by hash of its id) is kept out of
training. On those, for each language, the median and the 90 % quantile of a figure
give the fence median + ``FENCE`` * (q90 - median). Two figures have one:
* the score: the mean negative log probability of a unit, drawn towards the language's
  mean by ``PRIOR_UNITS`` units, so that a text of two words isn't judged by its noise;
* the unevenness: the distance between the quartiles of that mean over the text's
  windows of ``WINDOW`` units (from four windows on). Prose is even; single words
  repeated for lines aren't, though their perplexity may be common.
The spread is at least that of all languages together and a fixed least one: few
held-out texts can't make a tight fence.

Defined results
* a null or empty text has no perplexity and stays;
* a language without trusted held-out text has no threshold: its documents stay; a null
  language is a language of its own;
* an id that labels call both good and bad isn't trusted; null labels are ignored;
* an n-gram never seen backs off; a unit never seen gets the uniform share;
* a score equal to its threshold stays; equal counts have equal discounts, so nothing
  depends on the order of rows;
* a very long text is scored whole, in slices of its units;
* repeated rows are scored alike; an empty table gives an empty result; with no trusted
  text everything stays; other columns are not read (``keep_good`` returns them), whatever
  their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import bounded_broadcast, col_of, free_name, staged, text_slices, tidy

ORDER = 4
SHARD_ROWS = 2_000_000  # some 30 MB in a worker
HELD_OUT = 5
FENCE, PRIOR_UNITS, WINDOW = 6.0, 200.0, 128
LEAST_SPREAD = {"score": 0.05, "uneven": 0.045}
FLUSH_GRAMS = 1 << 19
SLICE_BYTES = 1 << 19  # text scored at once: each unit takes some 100 bytes in numpy
U64 = np.uint64

_COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("g", T.LongType()), T.StructField("c", T.LongType())])


# ---- units and n-grams of a batch ---------------------------------------------------
def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every unit of the texts, one after another, the 64-bit n-gram that ends there
    (units before a text's start are 0), and the texts' lengths in units."""
    pad = "\0" * (ORDER - 1)
    raw = np.frombuffer((pad + pad.join(texts)).encode("utf-16-le", "surrogatepass"), dtype="<u2").astype(U64)
    lens = np.array([len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in texts], dtype=np.int64)
    grams = raw[ORDER - 1 :].copy()
    for j in range(1, ORDER):
        grams |= raw[ORDER - 1 - j : len(raw) - j] << U64(16 * j)
    at = np.ones(len(grams), dtype=bool)
    ends = np.cumsum(lens + ORDER - 1) - (ORDER - 1)
    for j in range(ORDER - 1):
        at[ends[:-1] + j] = False
    return grams[at], lens


def _by_lang(rec: pa.RecordBatch, text: int, lang: int) -> dict:
    found: dict = {}
    for i, (t, name) in enumerate(zip(rec.column(text).to_pylist(), rec.column(lang).to_pylist())):
        if t:
            found.setdefault(name, []).append((i, t))
    return found


def gram_counts(trusted: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, g, c: how often each n-gram of the highest order occurs."""

    def batches(rows):
        held: dict = {}
        size = 0

        def flushed():
            for name, parts in held.items():
                grams, which = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                counts = np.bincount(which, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.record_batch([pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)], names=_COUNTS.names)

        with tidy():
            for rec in rows:
                for part in text_slices(rec, 0, SLICE_BYTES):
                    for name, texts in _by_lang(part, 0, 1).items():
                        grams, counts = np.unique(_units([t for _, t in texts])[0], return_counts=True)
                        held.setdefault(name, []).append((grams, counts))
                        size += len(grams)
                    if size > FLUSH_GRAMS:
                        yield from flushed()
                        held, size = {}, 0
            yield from flushed()

    picked = trusted.select(col_of(text_col).cast("string"), col_of(lang_col).cast("string"))
    return picked.mapInArrow(batches, _COUNTS).groupBy("lang", "g").agg(F.sum("c").alias("c"))


# ---- the model as tables ------------------------------------------------------------
def _low(units: int) -> int:
    return (1 << (16 * units)) - 1


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on lang (null is a language) and other keys, right's other columns added."""
    right = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = left["lang"].eqNullSafe(right["r_lang"])
    for k in keys[1:]:
        on = on & (left[k] == right[f"r_{k}"])
    return left.join(right, on).drop(*[f"r_{k}" for k in keys])


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 from the counts of counts (Chen and Goodman)."""
    n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def d(i: int) -> Column:
        raw = F.when(F.col(f"n{i}") > 0, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(0.5 * i)
        return F.greatest(F.lit(0.0), F.least(raw, F.lit(float(i)))).alias(f"d{i}")

    return counts.groupBy("lang").agg(*n).select("lang", d(1), d(2), d(3))


def _order_table(counts: DataFrame, units: int, below: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(lang, g, p) and the back-off weights (lang, h, w) of one order."""
    d = F.when(F.col("c") >= 3, F.col("d3")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d1"))
    rows = _null_safe(counts, _discounts(counts), ["lang"]).select(
        "lang", "g", "c", d.alias("d"), F.shiftrightunsigned("g", 16).alias("h"))
    context = rows.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("left"), F.count(F.lit(1)).alias("types"))
    weights = context.select("lang", "h", (F.col("left") / F.col("total")).alias("w"), "total", "types")
    rows = _null_safe(rows, weights, ["lang", "h"])
    first = (F.col("c") - F.col("d")) / F.col("total")
    if below is None:  # uniform over the seen units and one that stands for all others
        return rows.select("lang", "g", (first + F.col("w") / (F.col("types") + 1)).alias("p")), weights
    rows = rows.withColumn("s", F.col("g").bitwiseAND(F.lit(_low(units - 1))))
    rows = _null_safe(rows, below.select("lang", F.col("g").alias("s"), F.col("p").alias("q")), ["lang", "s"])
    return rows.select("lang", "g", (first + F.col("w") * F.col("q")).alias("p")), weights


def train(trusted: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """The model: lang, kind (``p1``..``p4`` log probabilities, ``w1``..``w3`` log back-off
    weights of contexts of so many units, ``unk``), key, value, unit (the last but one)."""
    counts = {ORDER: staged(gram_counts(trusted, text_col, lang_col), "grams")}
    for units in range(ORDER - 1, 0, -1):
        s = F.col("g").bitwiseAND(F.lit(_low(units)))
        counts[units] = staged(counts[units + 1].groupBy("lang", s.alias("g")).agg(F.count(F.lit(1)).alias("c")), "grams")
    below, out = None, []
    for units in range(1, ORDER + 1):
        probs, weights = _order_table(counts[units], units, below)
        below = staged(probs, "probs")
        last_but_one = F.shiftrightunsigned("g", 16).bitwiseAND(F.lit(_low(1))) if units > 1 else F.lit(-1)
        out.append(below.select("lang", F.lit(f"p{units}").alias("kind"), F.col("g").alias("key"), F.log("p").alias("value"), last_but_one.cast("long").alias("unit")))
        if units == 1:
            out.append(weights.select("lang", F.lit("unk"), F.lit(0).cast("long"), F.log(F.col("w") / (F.col("types") + 1)), F.lit(-1).cast("long")))
        else:
            out.append(weights.select("lang", F.lit(f"w{units - 1}"), F.col("h"), F.log("w"), F.col("h").bitwiseAND(F.lit(_low(1)))))
    model = out[0]
    for part in out[1:]:
        model = model.union(part)
    return staged(model, "model")


# ---- scoring ------------------------------------------------------------------------
def _spread(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return key ^ (key >> U64(32))


class Lookup:
    """64-bit keys to values, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values.astype(np.float64)
        self.mask = U64((1 << max(4, int(2 * len(keys)).bit_length())) - 1)
        self.slots = np.full(int(self.mask) + 1, -1, dtype=np.int32)
        todo, at = np.arange(len(keys)), _spread(keys) & self.mask
        while len(todo):
            free = np.flatnonzero(self.slots[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.slots[at[won]] = todo[won]
            rest = np.ones(len(todo), dtype=bool)
            rest[won] = False
            todo, at = todo[rest], (at[rest] + U64(1)) & self.mask

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value); values of keys that aren't there are 0."""
        value, found = np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
        if not len(self.keys):
            return found, value
        todo, at = np.arange(len(keys)), _spread(keys) & self.mask
        while len(todo):
            slot = self.slots[at]
            hit = (slot >= 0) & (self.keys[slot] == keys[todo])
            won = todo[hit]
            value[won], found[won] = self.values[slot[hit]], True
            go = (slot >= 0) & ~hit
            todo, at = todo[go], (at[go] + U64(1)) & self.mask
        return found, value


class Scorer:
    """One language's part of a model shard."""

    def __init__(self, tables: dict[str, tuple[np.ndarray, np.ndarray]]):
        none = (np.zeros(0, dtype=U64), np.zeros(0))
        self.prob = {n: Lookup(*tables.get(f"p{n}", none)) for n in range(1, ORDER + 1)}
        self.back = {n: Lookup(*tables.get(f"w{n}", none)) for n in range(1, ORDER)}
        self.unk = float(tables["unk"][1][0])

    def surprise(self, grams: np.ndarray) -> np.ndarray:
        """Negative log probability of the last unit of each n-gram."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for n in range(ORDER, 0, -1):
            key = grams[todo] & U64(_low(n))
            found, value = self.prob[n].find(key)
            out[todo] += value
            todo, key = todo[~found], key[~found]
            if not len(todo):
                break
            out[todo] += self.back[n - 1].find(key >> U64(16))[1] if n > 1 else self.unk
        return -out


def _shard_of(unit, n: int):
    return F.pmod(F.xxhash64(unit), F.lit(n))


def _tables(rows: pa.Table) -> dict:
    """{lang: {kind: (keys, values)}} of collected model rows. Names stay dictionary codes:
    as Python strings they would take far more of the driver than the numbers."""
    lang, kind = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "kind"))
    langs, kinds = lang.dictionary.to_pylist() + [None], kind.dictionary.to_pylist()
    lang_at = lang.indices.fill_null(len(langs) - 1).to_numpy()  # a null language is one of its own
    code = lang_at.astype(np.int64) * len(kinds) + kind.indices.to_numpy()
    keys, values = rows.column("key").to_numpy().view(U64), rows.column("value").to_numpy()
    found: dict = {}
    for c in np.unique(code).tolist():
        mine = code == c
        found.setdefault(langs[c // len(kinds)], {})[kinds[c % len(kinds)]] = (keys[mine], values[mine])
    return found


def score(df: DataFrame, model: DataFrame, text_col: str, lang_col: str, nll: str, units: str, windows: str) -> DataFrame:
    """``df`` with three more columns: the text's negative log probability, its units, and
    the sums over its whole windows. All are null where the text is empty or its language
    has no model."""
    sc = df.sparkSession.sparkContext
    shards = max(1, -(-model.count() // SHARD_ROWS))
    out = df.withColumns({nll: F.lit(None).cast("double"), units: F.lit(None).cast("long"), windows: F.lit(None).cast("array<double>")})
    text_at, lang_at, *new_at = (out.columns.index(c) for c in (text_col, lang_col, nll, units, windows))
    # which shard scores a position, for all 65536 units that may stand before it
    owner = df.sparkSession.range(1 << 16).select("id", _shard_of("id", shards).alias("s")).orderBy("id").toArrow()
    owner = owner.column("s").to_numpy()
    for shard in range(shards):
        rows = model.where((F.col("unit") < 0) | (_shard_of("unit", shards) == shard))
        with tidy():  # at most SHARD_ROWS and the single units pass the driver
            shared = sc.broadcast(_tables(rows.select("lang", "kind", "key", "value").toArrow()))

        def scored(part: pa.RecordBatch, scorers: dict, tables: dict, shard: int) -> pa.RecordBatch:
            total, length, sums = (part.column(i).to_pylist() for i in new_at)
            for name, texts in _by_lang(part, text_at, lang_at).items():
                if name not in tables:
                    continue
                if name not in scorers:
                    scorers[name] = Scorer(tables[name])
                grams, lens = _units([t for _, t in texts])
                mine = owner[(grams >> U64(16)) & U64(0xFFFF)] == shard
                surprise = np.zeros(len(grams))
                surprise[mine] = scorers[name].surprise(grams[mine])
                at = 0
                for (i, _), n in zip(texts, lens.tolist()):
                    own = surprise[at : at + n]
                    at += n
                    wide = own[: n - n % WINDOW].reshape(-1, WINDOW).sum(axis=1)
                    sums[i] = wide if sums[i] is None else wide + sums[i]
                    total[i], length[i] = (total[i] or 0.0) + float(own.sum()), n
            cols = part.columns
            for i, values, kind in zip(new_at, (total, length, sums), (pa.float64(), pa.int64(), pa.list_(pa.float64()))):
                cols[i] = pa.array(values, kind)
            return pa.record_batch(cols, names=part.schema.names)

        def batches(recs, shared=shared, shard=shard):
            scorers: dict = {}
            with tidy(scorers):
                for rec in recs:
                    for part in text_slices(rec, text_at, SLICE_BYTES):
                        yield scored(part, scorers, shared.value, shard)

        out = out.mapInArrow(batches, out.schema)
        if shards > 1:
            out = staged(out, "scores")
    quartile = lambda x, q: F.element_at(x, (F.size(x) * q).cast("int") + 1)
    ordered = F.sort_array(col_of(windows))
    uneven = F.when(F.size(col_of(windows)) >= 4, (quartile(ordered, 0.75) - quartile(ordered, 0.25)) / WINDOW)
    return out.withColumn(windows, uneven)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    good = labels.select(col_of(id_col).cast("bigint").alias("id"), "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return good.where("id IS NOT NULL").groupBy("id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 AND t = 0").select("id")


def _held_out(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("held out"), id_col), F.lit(HELD_OUT)) == 0


def judged(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           carry: bool = False) -> DataFrame:
    """id, language, units, perplexity, score, threshold, kept for each row of ``df``; with
    ``carry``, the columns of ``df`` and ``kept`` (under the first free name like it)."""
    df = df if carry else df.select(*[col_of(c) for c in dict.fromkeys([id_col, lang_col, text_col])])
    trusted = staged(trusted_ids(labels), "trusted")
    key = col_of(id_col).cast("bigint")
    source = df.select(key.alias("id"), col_of(text_col).alias("t"), col_of(lang_col).alias("l"))
    model = train(source.join(bounded_broadcast(trusted.where(~_held_out(F.col("id")))), "id", "left_semi"), "t", "l")

    nll, units, uneven = (free_name(df, x) for x in ("_nll", "_units", "_uneven"))
    scored = score(df, model, text_col, lang_col, nll, units, uneven)
    scored = staged(scored if carry else scored.drop(text_col), "scored")

    lang = col_of(lang_col).cast("string").alias("lang")
    held = scored.select(key.alias("id"), lang, col_of(nll).alias("x"), col_of(units).alias("n"), col_of(uneven).alias("uneven")).where("n > 0")
    held = held.join(bounded_broadcast(trusted.where(_held_out(F.col("id")))), "id", "left_semi")
    means = held.groupBy("lang").agg((F.sum("x") / F.sum("n")).alias("mean"))
    points = staged(_null_safe(held, means, ["lang"]).select(
        "lang", "mean", "uneven", ((F.col("x") + PRIOR_UNITS * F.col("mean")) / (F.col("n") + PRIOR_UNITS)).alias("score")), "held")
    at, fence = free_name(df, "_fence_lang"), free_name(df, "_fence")
    fences = bounded_broadcast(staged(_fences(points).select(F.col("lang").alias(at), F.struct("mean", "score", "uneven").alias(fence)), "fences"))

    out = scored.join(fences, col_of(lang_col).cast("string").eqNullSafe(col_of(at)), "left")
    fence = col_of(fence)
    value = (col_of(nll) + PRIOR_UNITS * fence["mean"]) / (col_of(units) + PRIOR_UNITS)
    kept = F.coalesce(value <= fence["score"], F.lit(True)) & F.coalesce(col_of(uneven) <= fence["uneven"], F.lit(True))
    if carry:
        return out.select(*[col_of(c) for c in df.columns], kept.alias(free_name(df, "kept")))
    return out.select(
        key.alias("id"), lang, col_of(units).alias("n_units"), F.exp(col_of(nll) / col_of(units)).alias("perplexity"),
        value.alias("score"), fence["score"].alias("threshold"), col_of(uneven).alias("unevenness"),
        fence["uneven"].alias("unevenness_threshold"), kept.alias("kept"))


def _fences(points: DataFrame) -> DataFrame:
    """lang, mean, score, uneven: the language-specific thresholds of both figures."""
    names = list(LEAST_SPREAD)
    quantiles = points.groupBy("lang").agg(
        F.first("mean").alias("mean"), *[F.percentile_approx(x, [0.5, 0.9], 10_000).alias(f"q_{x}") for x in names])
    off = _null_safe(points, quantiles.drop("mean"), ["lang"])
    pooled = off.agg(*[F.percentile_approx(F.col(x) - F.col(f"q_{x}")[0], 0.9, 10_000).alias(f"p_{x}") for x in names])
    fence = lambda x: F.col(f"q_{x}")[0] + FENCE * F.greatest(
        F.col(f"q_{x}")[1] - F.col(f"q_{x}")[0], f"p_{x}", F.lit(LEAST_SPREAD[x]))
    return quantiles.crossJoin(F.broadcast(pooled)).select(  # one row on the right
        "lang", "mean", *[fence(x).alias(x) for x in names])


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` that the classifier keeps, with all their columns."""
    marked = judged(df, labels, id_col, text_col, lang_col, carry=True)
    flag = marked.columns[-1]
    return marked.where(col_of(flag)).drop(flag)
