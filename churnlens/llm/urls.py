"""URL filter: rules, and gradient-boosted trees on lexical features (operator 10).

A rule (host, path, verdict) fits its host and all subdomains, if the url's path starts
with the rule's; of the rules that fit, the longest decides. All other urls are judged by
Spark ML's gradient-boosted trees over lexical features: lengths, depth, digit and symbol
ratios, entropies, parameter counts, and statistics of the host's suffixes (of one, two
and three labels): how often a suffix occurs and which share of its labelled urls is bad.

Labelled urls come from the caller as a condition that is true (bad), false (good) or null
(not labelled) for each url. They are cut by hash of the host and path into two halves:
suffix statistics are counted on one half and the trees are fitted on the other, so a url's
own label is not in its features. A third of the domains (last two labels of a host) is not
counted at all: their urls are fitted without statistics of their own, as urls of a domain
met for the first time will be judged. The fit takes a hash sample of about
``FIT_ROWS`` rows (a documented bound); everything else covers all rows.

Suffix tables are broadcast up to a checked number of rows, else joined by a shuffle that
adaptive execution can split at a hot host; the features of a url are made in the task
that reads it.

Defined results
* null, or no ``://``: host and path are empty, no rule fits;
* a path is empty without a ``/`` after the host; a rule's path starts with ``/``;
* two rules of the same length can't both fit unless they are equal: the first counts;
* without labelled urls of both kinds in each half there is no model: ``allow``;
* a very long url has its features counted over all of it;
* repeated rows get the same verdict; an empty table gives an empty result; other columns
  are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import bounded_broadcast, col_of, staged
from churnlens.session import ensure_checkpoint_dir

FIT_ROWS = 40_000
TREES, DEPTH, SEED = 20, 4, 10
PRIOR = 10.0  # labelled urls that a suffix's share is drawn towards the mean by
SUFFIXES = (1, 2, 3)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PAGES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("bad", T.BooleanType()), T.StructField("x", T.ArrayType(T.DoubleType())),
    *[T.StructField(f"s{k}", T.StringType()) for k in SUFFIXES],
])


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: tuple[str, str, str]) -> Column:
    host, path, _ = rule
    return ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))


def rule_of(rules: list[tuple[str, str, str]], value) -> Column:
    """``value(rule)`` of the longest rule that fits the columns host and path, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r[0] + r[1]))):
        out = F.when(_fits(rule), F.lit(value(rule))).otherwise(out)
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def lexical(host: str, path: str, url: str) -> list[float]:
    """The features that need nothing but the url."""
    rest = url[url.find("://") + 3 + len(host) + len(path) :] if "://" in url else ""
    query = rest[1:].split("#")[0] if rest.startswith("?") else ""
    params = [p for p in query.split("&") if p]
    letters = max(1, len(host))
    return [float(v) for v in (
        len(url), len(host), len(path), len(query), host.count(".") + 1, sum(1 for p in path.split("/") if p),
        sum(c.isdigit() for c in host) / letters, host.count("-"), sum(c.isdigit() for c in path) / max(1, len(path)),
        _entropy(host), _entropy(path), max(map(len, host.split("."))), len(params), max(map(len, params), default=0),
        "#" in rest, "%" in url, "@" in host, ":" in host, url.startswith("https"),
    )]


def _features(pages: DataFrame) -> DataFrame:
    def batches(rows):
        for rec in rows:
            ids, urls, hosts, paths, bad = (rec.column(i) for i in range(5))
            x, suffixes = [], [[] for _ in SUFFIXES]
            for url, host, path in zip(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist()):
                x.append(lexical(host, path, url or ""))
                labels = host.split(".")
                for k, held in zip(SUFFIXES, suffixes):
                    held.append(".".join(labels[-k:]))
            yield pa.record_batch([ids, hosts, paths, bad, pa.array(x, pa.list_(pa.float64())), *map(pa.array, suffixes)], names=_PAGES.names)

    return pages.mapInArrow(batches, _PAGES)


def _with_suffixes(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """``rows`` with the statistics of their suffixes in ``counted`` added to ``x``."""
    mean = F.lit(float(counted.agg(F.avg(F.col("bad").cast("double"))).first()[0]))
    extra = []
    for k in SUFFIXES:
        share = (F.sum(F.col("bad").cast("double")) + PRIOR * mean) / (F.count(F.lit(1)) + PRIOR)
        table = counted.groupBy(f"s{k}").agg(share.alias(f"share{k}"), F.log1p(F.count(F.lit(1)).cast("double")).alias(f"n{k}"))
        rows = rows.join(bounded_broadcast(staged(table, "suffixes")), f"s{k}", "left")
        extra += [F.coalesce(f"share{k}", mean), F.coalesce(f"n{k}", F.lit(0.0))]
    return rows.withColumn("x", F.concat("x", F.array(*extra)))


def _probability(rows: DataFrame) -> DataFrame:
    """``rows`` with ``p``, the probability that the url is bad (null without a model)."""
    half = F.pmod(F.xxhash64(F.lit(SEED), "host", "path"), F.lit(2))
    new = F.pmod(F.xxhash64(F.lit(SEED + 2), "s2"), F.lit(3)) == 0  # domains treated as not met before
    labelled = rows.where("bad IS NOT NULL").where((half == 1) | ~new)
    kinds = labelled.groupBy(half.alias("half"), "bad").agg(F.count(F.lit(1)).alias("n")).collect()  # at most four rows
    if len(kinds) < 4:
        return rows.withColumn("p", F.lit(None).cast("double"))
    rows = staged(_with_suffixes(rows, labelled.where(half == 0)), "features")
    to_fit = sum(r.n for r in kinds if r.half == 1)
    drawn = F.pmod(F.xxhash64(F.lit(SEED + 1), "host", "path", "id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, FIT_ROWS / to_fit)))
    fit = rows.where("bad IS NOT NULL").where((half == 1) & drawn).select(
        array_to_vector("x").alias("features"), F.col("bad").cast("double").alias("label"))
    ensure_checkpoint_dir(rows.sparkSession)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=10).fit(fit)
    judged = trees.transform(rows.withColumn("features", array_to_vector("x")))
    return judged.withColumn("p", vector_to_array("probability")[1])


def judge(df: DataFrame, rules: list[tuple[str, str, str]], bad: Column, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, p for each row of ``df``; rules are (host, path,
    ``allow`` or ``block``), ``bad`` labels urls by the columns host and path."""
    url = col_of(url_col).cast("string")
    pages = df.select(col_of(id_col).cast("bigint").alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = staged(_features(pages.withColumn("bad", bad)), "urls")
    own = F.when(F.col("p") >= 0.5, "block").otherwise("allow")
    return _probability(rows).select(
        "id", "host", "path", rule_of(rules, lambda r: r[0] + r[1]).alias("rule"),
        F.coalesce(rule_of(rules, lambda r: r[2]), own).alias("verdict"), "p")
