"""Hard-negative mining (operator 11): an STR-packed R-tree under inner products.

Vectors are taken as integers, floor(256 x), so scores are exact. Rows with equal
integers and label are one entry with its smallest ids, so a vector that a third of the
rows share is one entry, and anchors with equal integers and label are one query.

Entries are dealt to *units* by sort-tile-recursive cuts, fitted on a bounded sample
(``FIT_ROWS`` entries; it decides about speed only, every entry is indexed), and a unit
that comes out too large is divided by hash. Each unit packs its entries of each label by
sort-tile-recursion into pages with minimum bounding boxes, and pages into a tree. A box
[lo, hi] bounds each coordinate's part of the inner product, min(q lo, q hi) to
max(q lo, q hi); their sums bound every score inside. A best-first queue opens boxes by
their bound and leaves those outside the score window or strictly below the kth score
found, so ties by id stay exact.

1. Positives: a query goes to the unit with the best bound, then with the kth score from
   there to every unit whose box reaches it (same-label trees only).
2. Negatives: the windows [low/100 s, high/100 s] of the positives' scores s go to all
   units whose box meets one; the trees of other labels are searched, a queue a window.

Units and chunks of queries form tasks of bounded size; unit boxes (at most
``2 * MOST_UNITS``) are the only thing broadcast. Results of units are merged by windows
whose limit is applied before the shuffle.

Defined results
* rows with a null id, label or vector, or a null or non-finite component take no part;
* an empty vector scores 0 with all; a shorter vector is filled up with zeros;
* components beyond 2**26 in size (x beyond 262,144) are cut to that, so sums fit 64 bits;
* higher scores come first, ties by smaller id; repeated rows count each, and rows with an
  anchor's id and vector are other rows, only one is the anchor itself;
* fewer positives or negatives than asked: all of them; an anchor without a positive, or a
  positive without a negative in its window, gives no row; an empty table an empty result;
* other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import col_of, staged

SCALE, MOST = 256, 1 << 26
PAGE, FANOUT = 256, 8
UNIT_ROWS, MOST_UNITS, QUERY_BLOCK = 1 << 14, 1 << 12, 1 << 11
FIT_ROWS = 1 << 14

_long, _int, _bytes = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(**kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


_ROWS = _schema(id=_long, label=_long, code=_bytes, norm=_long)
_PAGES = _schema(unit=_long, label=_long, lo=_bytes, hi=_bytes, codes=T.ArrayType(_bytes),
                 ids=T.ArrayType(T.ArrayType(_long)), unit_lo=_bytes, unit_hi=_bytes)
_ROUTED = _schema(unit=_long, qid=_long, code=_bytes, label=_long, floor=_long, tops=T.ArrayType(_long))
_FOUND = _schema(qid=_long, top=_long, score=_long, id=_long)


def integer_rows(df: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """id, label, code (32-bit integers without zeros at the end), norm (with itself)."""

    def batches(rows):
        for rec in rows:
            out = []
            for i, label, vec in zip(rec.column(0).to_pylist(), rec.column(1).to_pylist(), rec.column(2)):
                if i is None or label is None or not vec.is_valid or vec.values.null_count:
                    continue
                x = vec.values.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all():
                    q = np.trim_zeros(np.clip(np.floor(SCALE * x), -MOST, MOST).astype("<i4"), "b")
                    out.append((i, label, q.tobytes(), int((q.astype(np.int64) ** 2).sum())))
            yield pa.RecordBatch.from_pydict(
                {n: [r[k] for r in out] for k, n in enumerate(_ROWS.names)},
                pa.schema([("id", pa.int64()), ("label", pa.int64()), ("code", pa.binary()), ("norm", pa.int64())]))

    picked = df.select(col_of(id_col).cast("bigint").alias("id"), col_of(label_col).cast("bigint").alias("label"),
                       col_of(vec_col).cast("array<double>").alias("vec"))
    return picked.mapInArrow(batches, _ROWS)


def matrix(codes: list[bytes], width: int = 0) -> np.ndarray:
    """Codes as rows of 64-bit integers, filled up with zeros."""
    width = max([width, *(len(c) // 4 for c in codes)])
    flat = b"".join(c.ljust(4 * width, b"\0") for c in codes)
    return np.frombuffer(flat, "<i4").reshape(len(codes), width).astype(np.int64)


def fit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices with equally many columns."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: by doubles where all sums are below 2**53."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def intervals(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product of each query with anything in each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def str_cuts(sample: np.ndarray, depth: int) -> tuple[list[int], np.ndarray]:
    """The coordinate of each level and, in heap order, each node's cut: halves by the
    coordinates of greatest variance, each used for as many levels in a row as needed."""
    width = sample.shape[1]
    order = np.argsort(-sample.var(axis=0), kind="stable") if width else []
    used = min(width, depth)
    dims = [int(order[level * used // depth]) for level in range(depth)] if used else []
    cuts = np.zeros(1 << max(len(dims), 1), dtype=np.int64)
    at = np.ones(len(sample), dtype=np.int64)
    for level, dim in enumerate(dims):
        for node in range(1 << level, 2 << level):
            inside = sample[at == node, dim]
            cuts[node] = int(np.median(inside)) if len(inside) else 0
        at = 2 * at + (sample[:, dim] > cuts[at])
    return dims, cuts


def block_of(x: np.ndarray, dims: list[int], cuts: np.ndarray) -> np.ndarray:
    at = np.ones(len(x), dtype=np.int64)
    for dim in dims:
        value = x[:, dim] if dim < x.shape[1] else np.zeros(len(x), dtype=np.int64)
        at = 2 * at + (value > cuts[at])
    return at


def str_pages(x: np.ndarray, page: int) -> Iterator[np.ndarray]:
    """Row numbers of each page: sort by a coordinate, cut into slabs, tile each slab by
    the next coordinate (those of greatest variance first)."""
    order = np.argsort(-x.var(axis=0), kind="stable") if x.shape[1] else []

    def tile(rows: np.ndarray, k: int) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // page)
        if pages <= 1 or k == len(order):
            yield from (rows[a : a + page] for a in range(0, len(rows), page))
            return
        slabs = int(np.ceil(pages ** (1 / (len(order) - k)) - 1e-9))
        size = -(-pages // slabs) * page
        rows = rows[np.argsort(x[rows, order[k]], kind="stable")]
        for a in range(0, len(rows), size):
            yield from tile(rows[a : a + size], k + 1)

    yield from tile(np.arange(len(x)), 0)


def _raw(v: np.ndarray) -> bytes:
    return v.astype("<i4").tobytes()


def _pack(key: tuple, entries: pa.Table) -> pa.Table:
    """One unit's pages; the first has the unit's box too."""
    codes, ids = entries.column("code").to_pylist(), entries.column("ids").to_pylist()
    x, labels = matrix(codes), entries.column("label").to_numpy()
    out = []
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        for rows in str_pages(x[mine], PAGE):
            rows = mine[rows]
            out.append({"unit": key[0].as_py(), "label": int(label), "lo": _raw(x[rows].min(axis=0)), "hi": _raw(x[rows].max(axis=0)),
                        "codes": [codes[r] for r in rows], "ids": [ids[r] for r in rows], "unit_lo": None, "unit_hi": None})
    out[0] |= {"unit_lo": _raw(x.min(axis=0)), "unit_hi": _raw(x.max(axis=0))}
    b, i = pa.binary(), pa.int64()
    kinds = [i, i, b, b, pa.list_(b), pa.list_(pa.list_(i)), b, b]
    return pa.Table.from_pylist(out, schema=pa.schema(list(zip(_PAGES.names, kinds))))


class RTree:
    """The trees of one unit, one for each label: pages, and boxes over ``FANOUT`` boxes."""

    def __init__(self, pages: pa.Table, width: int):
        pages = pages.to_pylist()
        width = max([width, *(len(p["hi"]) // 4 for p in pages)])
        self.codes = [matrix(p["codes"], width) for p in pages]
        self.ids = [p["ids"] for p in pages]
        lo, hi = (list(matrix([p[n] for p in pages], width)) for n in ("lo", "hi"))
        self.children: list[list[int]] = [[] for _ in pages]  # none: a page
        self.roots: dict[int, int] = {}
        level: dict[int, list[int]] = {}
        for n, p in enumerate(pages):  # a label's pages come in the order they were tiled
            level.setdefault(p["label"], []).append(n)
        for label, nodes in level.items():
            while len(nodes) > 1:
                above = []
                for a in range(0, len(nodes), FANOUT):
                    part = nodes[a : a + FANOUT]
                    lo.append(np.min([lo[n] for n in part], axis=0))
                    hi.append(np.max([hi[n] for n in part], axis=0))
                    self.children.append(part)
                    above.append(len(lo) - 1)
                nodes = above
            self.roots[label] = nodes[0]
        self.lo, self.hi = np.array(lo), np.array(hi)


class Query:
    """One query in one unit: bounds of all boxes, and the scores of the pages opened."""

    def __init__(self, tree: RTree, vector: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.tree, self.vector, self.least, self.most = tree, vector, least.tolist(), most.tolist()
        self.opened: dict[int, np.ndarray] = {}

    def scores(self, page: int) -> np.ndarray:
        if page not in self.opened:
            self.opened[page] = products(self.tree.codes[page], self.vector[None])[:, 0]
        return self.opened[page]

    def best(self, roots: list[int], want: int, bottom: int | None, top: int | None) -> list[tuple[int, int]]:
        """The ``want`` best (-score, id) of the rows with bottom <= score <= top (None: no
        bound), in order."""
        reach = lambda n: self.most[n] if top is None else min(self.most[n], top)
        queue = [(-reach(n), n) for n in roots]
        heapq.heapify(queue)
        found: list[tuple[int, int]] = []
        least = bottom  # what a row must score: the window's bottom, then the kth best
        while queue:
            bound, node = heapq.heappop(queue)
            if least is not None and -bound < least:
                break
            if top is not None and self.least[node] > top:
                continue
            if self.tree.children[node]:
                for child in self.tree.children[node]:
                    if least is None or reach(child) >= least:
                        heapq.heappush(queue, (-reach(child), child))
                continue
            s = self.scores(node)
            fits = np.ones(len(s), dtype=bool) if top is None else s <= top
            if least is not None:
                fits &= s >= least
            at = np.flatnonzero(fits)
            if len(at) > want:  # entries tied with the want-th best stay
                at = at[s[at] >= np.partition(s[at], len(at) - want)[len(at) - want]]
            if len(at):
                found = heapq.nsmallest(want, found + [(-int(s[a]), i) for a in at for i in self.tree.ids[node][a]])
                if len(found) == want:
                    least = -found[-1][0]
        return found


def _search(positives: bool, want: int, low: int, high: int):
    def search(key: tuple, queries: pa.Table, pages: pa.Table) -> pa.Table:
        rows = []
        if queries.num_rows and pages.num_rows:
            vectors = matrix(queries.column("code").to_pylist())
            tree = RTree(pages, vectors.shape[1])
            vectors, _ = fit(vectors, tree.lo)
            least, most = intervals(vectors, tree.lo, tree.hi)
            for n, q in enumerate(queries.select(["qid", "label", "floor", "tops"]).to_pylist()):
                one = Query(tree, vectors[n], least[n], most[n])
                if positives:
                    roots = [tree.roots[q["label"]]] if q["label"] in tree.roots else []
                    rows += [(q["qid"], None, -s, i) for s, i in one.best(roots, want, q["floor"], None)]
                    continue
                roots = [r for label, r in tree.roots.items() if label != q["label"]]
                for s in q["tops"]:
                    bottom, top = window(s, low, high)
                    rows += [(q["qid"], s, -x, i) for x, i in one.best(roots, want, bottom, top)]
        columns = list(zip(*rows)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=_FOUND.names)

    return search


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The integers n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def _route(boxes, which: str, low: int, high: int):
    """Queries with each unit they must go to."""

    def route(batches):
        units, lo, hi = boxes.value
        for rec in batches:
            if not rec.num_rows or not len(units):
                continue
            q, lo_ = fit(matrix(rec.column("code").to_pylist()), lo)
            least, most = intervals(q, lo_, fit(q, hi)[1])
            best = most.argmax(axis=1)
            if which == "best":
                go = np.arange(len(units)) == best[:, None]
            elif which == "others":
                floor = [-(1 << 62) if f is None else f for f in rec.column("floor").to_pylist()]
                go = (np.arange(len(units)) != best[:, None]) & (most >= np.array(floor)[:, None])
            else:
                spans = [[window(s, low, high) for s in tops] for tops in rec.column("tops").to_pylist()]
                bottom = np.array([min((a for a, _ in w), default=1 << 62) for w in spans])
                top = np.array([max((b for _, b in w), default=-(1 << 62)) for w in spans])
                go = (most >= bottom[:, None]) & (least <= top[:, None])
            at, unit = np.nonzero(go)
            picked = rec.take(pa.array(at))
            yield pa.record_batch([pa.array(units[unit]), *picked.columns], names=_ROUTED.names)

    return route


def _best_rows(found: DataFrame, keys: list[str], want: int) -> DataFrame:
    """The best rows of each key over all units, as an array of (minus score, id) in order."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    kept = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= want)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("rows"))


def _units(entries: DataFrame, total: int) -> DataFrame:
    """Entries with their unit."""
    spark = entries.sparkSession
    size = max(UNIT_ROWS, -(-total // MOST_UNITS))
    depth = max(0, int(np.ceil(np.log2(max(1, total / size)))))
    if depth:
        share = F.lit(min(1.0, FIT_ROWS / total))
        picked = F.pmod(F.xxhash64(F.lit(11), "code", "label"), F.lit(1 << 20)) < share * (1 << 20)
        dims, cuts = str_cuts(matrix([r.code for r in entries.where(picked).select("code").limit(2 * FIT_ROWS).collect()]), depth)
    else:
        dims, cuts = [], np.zeros(1, dtype=np.int64)

    def blocks(batches):
        for rec in batches:
            if rec.num_rows:
                at = block_of(matrix(rec.column("code").to_pylist()), dims, cuts)
                yield pa.record_batch([*rec.columns, pa.array(at)], names=[*rec.schema.names, "block"])

    placed = staged(entries.mapInArrow(blocks, T.StructType([*entries.schema.fields, T.StructField("block", _long)])), "placed")
    sizes = placed.groupBy("block").count().collect()  # at most 2 * MOST_UNITS
    parts = spark.createDataFrame([(r.block, -(-r["count"] // size)) for r in sizes], "block long, parts long")
    sub = F.pmod(F.xxhash64(F.lit(12), "code", "label"), F.col("parts"))
    return placed.join(F.broadcast(parts), "block").withColumn("unit", F.col("block") * (1 << 32) + sub)


def mine(df: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
         id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor (``is_anchor`` over the column ``id``) its best rows of the same label, and for
    each of them the best rows of other labels scoring from low to high per cent of it."""
    spark = df.sparkSession
    rows = staged(integer_rows(df, id_col, label_col, vec_col), "vectors")
    held = max(n_positives + 1, n_negatives)  # the anchor itself is among its own best rows
    smallest = Window.partitionBy("code", "label").orderBy("id")
    entries = (
        rows.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= held)
        .groupBy("code", "label").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    entries = staged(entries, "entries")
    total = entries.count()
    anchors = rows.where(is_anchor)
    queries = anchors.select("code", "label").distinct().select(F.monotonically_increasing_id().alias("qid"), "code", "label")
    queries = staged(queries, "queries")  # ids stay

    pages = staged(_units(entries, total).select("unit", "code", "label", "ids").groupBy("unit").applyInArrow(_pack, _PAGES), "pages")
    units = pages.where(F.col("unit_lo").isNotNull()).select("unit", "unit_lo", "unit_hi").collect()  # at most 2 * MOST_UNITS
    boxes = spark.sparkContext.broadcast((
        np.array([u.unit for u in units], dtype=np.int64),
        matrix([bytes(u.unit_lo) for u in units]), matrix([bytes(u.unit_hi) for u in units])))
    tasks = spark.sparkContext.defaultParallelism
    chunks = max(1, -(-queries.count() // QUERY_BLOCK), -(-2 * tasks // max(1, len(units))))
    chunk = F.pmod(F.xxhash64(F.lit(13), "qid"), F.lit(chunks)).cast("int").alias("chunk")
    trees = pages.drop("unit_lo", "unit_hi").withColumn("chunk", F.explode(F.expr(f"sequence(0, {chunks - 1})")))

    def searched(asked: DataFrame, which: str, want: int) -> DataFrame:
        asked = asked.select("qid", "code", "label", "floor", "tops")
        routed = asked.mapInArrow(_route(boxes, which, low, high), _ROUTED).withColumn("chunk", chunk)
        return routed.groupBy("unit", "chunk").cogroup(trees.groupBy("unit", "chunk")).applyInArrow(
            _search(which != "windows", want, low, high), _FOUND)

    none = F.lit(None)
    want = n_positives + 1
    first = staged(searched(queries.select("*", none.cast("bigint").alias("floor"), none.cast("array<bigint>").alias("tops")), "best", want), "first")
    floors = first.groupBy("qid").agg(F.when(F.count("*") >= want, F.min("score")).alias("floor"))
    asked = queries.join(floors, "qid", "left").withColumn("tops", none.cast("array<bigint>"))
    positives = _best_rows(first.unionByName(searched(asked, "others", want)), ["qid"], want)
    positives = staged(queries.join(positives, "qid"), "positives")
    tops = F.array_distinct(F.transform("rows", lambda r: -r.s))
    found = searched(positives.select("qid", "code", "label", none.cast("bigint").alias("floor"), tops.alias("tops")), "windows", n_negatives)
    negatives = _best_rows(found, ["qid", "top"], n_negatives).groupBy("qid").agg(
        F.map_from_entries(F.collect_list(F.struct("top", "rows"))).alias("negatives"))
    answers = staged(positives.select("qid", "code", "label", F.col("rows").alias("positives")).join(negatives, "qid"), "answers")

    own = F.array_position("positives", F.struct((-F.col("norm")).alias("s"), "id"))
    others = F.slice(F.filter("positives", lambda _, i: i != own - 1), 1, n_positives)
    pairs = anchors.join(answers.drop("qid"), ["code", "label"]).select(
        F.col("id").alias("anchor_id"), F.explode(others).alias("p"), "negatives")
    ranked = pairs.select("anchor_id", "p", F.posexplode(F.col("negatives")[-F.col("p.s")]).alias("at", "n"))
    return ranked.select(
        "anchor_id", F.col("p.id").alias("positive_id"), (F.col("at") + 1).alias("rank"), F.col("n.id").alias("negative_id"),
        (-F.col("p.s")).alias("positive_score"), (-F.col("n.s")).alias("negative_score"))
