"""Mixing sources to target weights: iterative proportional fitting (operator 4).

The documents' tokens are summed into cells (source, language, topic). Raking scales the
cells in turn to the target share of each source, of each language and of each topic; a
fixed number of sweeps, ending with the topics. A cell's raked weight over its tokens is
the factor that its documents need. A document is drawn with probability
p = min(1, ``rate`` * factor), by the hash of its id and the seed, and carries the weight
factor / p, so that weight * tokens over the sample has the raked totals as expectation,
also where a cell can't supply more than all it has.

Rows without weights (``sample``) can't make up for that cap, so there the raking itself
is bounded: no cell gets more than ``max_repeats`` copies of each of its documents (1 by
default: a sample without repeats). Targets that a marginal's values can't supply within
that bound go to the values that can, in proportion; then each step scales the cells of a
value to its target and cuts what goes beyond a cell's bound, which later sweeps give to
cells with supply, until every marginal is within ``TOLERANCE`` of the whole, or a sweep
leaves over ``STALLED`` of the error before it, as when the marginals contradict each other
(``MOST_SWEEPS`` at most). A document is taken
floor(``rate`` * factor) times, and once more by the hash with the rest as probability.
``shares`` tells goal, reachable goal and raked share of every value.

Targets of a marginal are either its observed shares to a power (0 gives each value the
same, 1 leaves them as they are), so no list of sources is needed, or a table of wanted
shares, in which a value that the table doesn't name gets its least share. Only values
that have tokens take part; shares are normalised over them.

All is DataFrame work. Cells are as many as the combinations that occur; after each
marginal (bounded: each sweep) they are staged, so plans stay short. A marginal is an aggregate over the cells,
joined back by its value; sums are pre-aggregated, so a source with a third of the rows
is no hot task. Texts are never shuffled as long as the cells can be broadcast (their
number is checked); beyond that the join is a shuffle that adaptive execution can split.

Defined results
* null is a value like any other of source, language or topic;
* a null or empty text has no tokens; a cell without tokens has factor 1;
* repeated rows with one id are drawn or left together; a null id counts as one id;
* a very long text counts its words in the JVM and is not moved; a document beyond a cell's
  share is drawn or left as a whole;
* an empty table gives an empty result; no column of the input is changed, and columns with
  the names used here clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from churnlens.llm.common import bounded_broadcast, col_of, free_name, staged, text_or_empty

SWEEPS = 6
TOLERANCE, STALLED, MOST_SWEEPS = 0.002, 0.9, 15
CELL_ROWS = 200_000  # cells that are broadcast
MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def _named(value: Column) -> Column:
    """A value as a non-null string that no other value has."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def uniform(value: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed: 48 bits of an MD5."""
    text = F.concat(_named(value), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def _targets(cells: DataFrame, margin: str, power: float, wanted: dict[str, float]) -> DataFrame:
    """(margin, goal), up to a common factor."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    return sums.select(margin, _goal(margin, F.col("t"), power, wanted).alias("goal"))


def _goal(margin: str, tokens: Column, power: float, wanted: dict[str, float]) -> Column:
    if not wanted:
        return F.pow(tokens, F.lit(power))
    table = F.create_map(*[F.lit(x) for k, v in wanted.items() for x in (f"={k}", float(v))])
    return F.coalesce(table[F.col(margin)], F.lit(float(min(wanted.values()))))


def rake(cells: DataFrame, goals: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``w``, their raked weights: they add up
    to the tokens, and after the last sweep each topic has its share exactly."""
    mass = cells.agg(F.sum("tokens").cast("double").alias("mass"))
    scaled = {}
    for margin, goal in goals.items():
        whole = goal.agg(F.sum("goal").alias("whole"))
        one = goal.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(mass))  # one row each
        scaled[margin] = staged(one.select(margin, (F.col("goal") / F.col("whole") * F.col("mass")).alias("goal")), f"goal-{margin}")
    now = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for margin in MARGINS:
            sums = now.groupBy(margin).agg(F.sum("w").alias("had")).join(scaled[margin], margin)
            factor = sums.select(margin, (F.col("goal") / F.col("had")).alias("f"))
            now = now.join(factor, margin, "left").select(
                *MARGINS, "tokens", (F.col("w") * F.coalesce("f", F.lit(1.0))).alias("w"))
            now = staged(now, "raked")
    return now


def mixed(df: DataFrame, topic: Column, rate: float, seed: int = 0, powers: dict[str, float] | None = None,
          wanted: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """A row for each row of ``df``: id, source, lang, topic, n_tokens, factor, p, sampled,
    weight."""
    powers, wanted = powers or {}, wanted or {}
    names = {k: free_name(df, f"_{k}") for k in (*MARGINS, "f")}
    keys = {"source": _named(col_of(source_col)), "lang": _named(col_of(lang_col)), "topic": _named(topic)}
    narrow = staged(df.select(
        col_of(id_col).alias("id"), col_of(source_col).alias("source_value"), col_of(lang_col).alias("lang_value"),
        topic.alias("topic_value"), *[v.alias(k) for k, v in keys.items()], n_tokens(text_col).alias("tokens")), "tokens")
    cells = staged(narrow.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, {m: _targets(cells, m, powers.get(m, 1.0), wanted.get(m, {})) for m in MARGINS})
    factor = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(1.0)
    factors = staged(raked.select(*[F.col(m).alias(names[m]) for m in MARGINS], factor.alias(names["f"])), "factors")
    factors = bounded_broadcast(factors, CELL_ROWS)
    f = col_of(names["f"])
    p = F.least(F.lit(1.0), F.lit(float(rate)) * f)
    on = [narrow[m] == factors[names[m]] for m in MARGINS]
    return narrow.join(factors, on).select(
        "id", F.col("source_value").alias("source"), F.col("lang_value").alias("lang"), F.col("topic_value").alias("topic"),
        narrow["tokens"].alias("n_tokens"), f.alias("factor"), p.alias("p"),
        (uniform(F.col("id"), seed) < p).alias("sampled"), (f / p).alias("weight"))


def _reachable(cells: DataFrame, margin: str, power: float, wanted: dict[str, float]) -> DataFrame:
    """(margin, goal, reach) as shares of the mass: what a value's cells can't supply goes
    to the others in proportion. By supply over goal, the values that stay below the common
    level come first; the level is the greatest of (mass - supply before) / (goals left).
    One aggregate of the cells, whose rows (one a value) then meet in windows."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("n"), F.sum("cap").alias("supply")).where("n > 0")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = _goal(margin, F.col("n").cast("double"), power, wanted)
    mass = F.sum("n").over(everything).cast("double")
    rows = sums.select(margin, "supply", share.alias("goal"), mass.alias("mass"))
    rows = rows.withColumn("goal", F.col("goal") / F.sum("goal").over(everything) * F.col("mass"))
    order = Window.orderBy(F.col("supply") / F.col("goal"), margin)  # a row a value
    before = F.coalesce(F.sum("supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("goal").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.max("level").over(everything)
    rows = rows.withColumn("level", (F.col("mass") - before) / left).withColumn("level", level)
    return rows.select(margin, F.col("goal").alias(f"goal_{margin}"), F.least("supply", F.col("goal") * F.col("level")).alias(f"reach_{margin}"))


def rake_bounded(cells: DataFrame, powers: dict[str, float], wanted: dict[str, dict[str, float]]) -> DataFrame:
    """``cells`` (source, lang, topic, tokens, cap) with ``w``, their raked weights of at
    most ``cap``, and each marginal's goal and reachable goal. A sweep is one job: its error
    is observed while its cells are written."""
    now = cells.where("tokens > 0").withColumn("w", F.least(F.col("tokens").cast("double"), "cap"))
    for margin in MARGINS:
        now = now.join(_reachable(cells, margin, powers.get(margin, 1.0), wanted.get(margin, {})).hint("merge"), margin)
    columns = [*MARGINS, "tokens", "cap", *[f"{kind}_{m}" for m in MARGINS for kind in ("goal", "reach")]]
    now = staged(now.select(*columns, "w"), "bounded")
    last = float("inf")
    for _ in range(MOST_SWEEPS):
        swept = now.withColumn("error", F.lit(0.0))
        for m in MARGINS:
            swept = swept.withColumn("had", F.sum("w").over(Window.partitionBy(m))).withColumn(
                "error", F.greatest("error", F.abs(F.col("had") - F.col(f"reach_{m}")))).withColumn(
                "w", F.least("cap", F.col("w") * F.col(f"reach_{m}") / F.col("had")))
        seen = Observation()
        swept = swept.select(*columns, "w", "error").observe(seen, F.max("error").alias("most"), F.sum("tokens").alias("mass"))
        now = staged(swept, "bounded")
        most, mass = seen.get["most"], seen.get["mass"]
        if most is None or most <= TOLERANCE * mass or most > STALLED * last:
            break
        last = most
    return now


def bounded_cells(df: DataFrame, topic: Column, rate: float, max_repeats: int = 1, powers: dict[str, float] | None = None,
                  wanted: dict[str, dict[str, float]] | None = None, text_col: str = "text",
                  source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The cells of ``df`` after bounded raking (see ``rake_bounded``)."""
    powers, wanted = powers or {}, wanted or {}
    cap = (F.col("tokens") * F.lit(max_repeats / float(rate))).cast("double")
    cells = df.groupBy(
        _named(col_of(source_col)).alias("source"), _named(col_of(lang_col)).alias("lang"), _named(topic).alias("topic")
    ).agg(F.sum(n_tokens(text_col)).alias("tokens")).withColumn("cap", cap)
    cells = staged(cells, "cells")
    return rake_bounded(cells, powers, wanted)


def shares(cells: DataFrame) -> DataFrame:
    """margin, value, goal, reachable, raked: shares of the mass for every value."""
    out = None
    for m in MARGINS:
        mass = F.sum("tokens").over(Window.partitionBy())
        rows = cells.select(m, "w", f"goal_{m}", f"reach_{m}", mass.alias("mass")).groupBy(m).agg(
            *[(F.max(f"{kind}_{m}") / F.max("mass")).alias(name) for kind, name in (("goal", "goal"), ("reach", "reachable"))],
            (F.sum("w") / F.max("mass")).alias("raked"))
        rows = rows.select(F.lit(m).alias("margin"), F.col(m).alias("value"), "goal", "reachable", "raked")
        out = rows if out is None else out.unionByName(rows)
    return out


def sample(df: DataFrame, topic: Column, rate: float, seed: int = 0, max_repeats: int = 1, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source", lang_col: str = "lang", **targets) -> DataFrame:
    """The drawn rows of ``df``, with all their columns, each at most ``max_repeats`` times.
    A row without tokens has the factor 1."""
    names = {k: free_name(df, f"_{k}") for k in (*MARGINS, "f", "again")}
    keys = {"source": _named(col_of(source_col)), "lang": _named(col_of(lang_col)), "topic": _named(topic)}
    cells = bounded_cells(df, topic, rate, max_repeats, text_col=text_col, source_col=source_col, lang_col=lang_col, **targets)
    factors = cells.select(*[F.col(m).alias(names[m]) for m in MARGINS], (F.col("w") / F.col("tokens")).alias(names["f"]))
    rows = df.join(bounded_broadcast(factors, CELL_ROWS), [keys[m] == col_of(names[m]) for m in MARGINS], "left")
    wish = F.least(F.lit(float(max_repeats)), F.lit(float(rate)) * F.coalesce(col_of(names["f"]), F.lit(1.0)))
    copies = (F.floor(wish) + (uniform(col_of(id_col), seed) < wish - F.floor(wish)).cast("int")).cast("int")
    again = F.explode(F.array_repeat(F.lit(True), copies)).alias(names["again"])
    return rows.select(*[col_of(c) for c in df.columns], again).drop(names["again"])
