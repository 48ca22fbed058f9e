"""Main text of web pages (operator 6).

Structure first: a page's markup is read once into blocks (text between block-level
tags, character references decoded, white space made one space). Blocks inside menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
(by element, role, a whole class or id, hidden style) go; where only a part of a class or
id gives a container away, the share of links in it and its length decide. If the page has
an ``article`` (else a ``main``) element, its blocks are the main text, whole: what holds
the article is no boilerplate, a header in it is its title, articles inside it are
comments unless it has no text of its own.

Host suffix array for what stands outside of the articles, on every page: the token
streams are concatenated by host; neighbours in the suffix order with ``LONG`` tokens in
common come from how many distinct pages? In a page without an article nothing but
repetition tells text from boilerplate: the tokens that a substring of two such pages
covers are removed and the unique runs stay. What stands around the articles, and what the
markup names as boilerplate on any page, is evidence: a substring of it counts as well if
two pages and half of the host's have it there (fewer may be teasers of a text). The array
is built by prefix doubling up to ``LONG`` tokens, which is all of the order that this
needs: a longer repeat is the union of repeats of ``LONG``.

A host may have a third of all pages, so a host is cut into shards of about
``SHARD_PAGES`` pages (by hash of the page's row). Each shard's arrays yield its distinct
substrings of ``LONG`` tokens and in how many pages they stand; an aggregate by
(host, substring) adds up the shards; each shard then removes what is
boilerplate on its host. So the result doesn't depend on the shards.

Repetition doesn't decide inside an ``article``: an article that a host carries twice
would vanish, and menus that differ from page to page would stay (README).

Defined results
* null or empty html, or a page of boilerplate only: empty text;
* tags without end, crossed tags, ``<`` in text and unclosed comments don't stop the
  reader; what follows an unclosed comment or script is part of it;
* what is hidden, and readers' comments, are no evidence;
* a very long page is read in one pass, its blocks held once; other columns are not read,
  whatever their names;
* repeated rows each give a row, and count as distinct pages for repetition;
* an empty table gives an empty result; a null url is a host of its own.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import bounded_broadcast, col_of, staged, text_slices

LONG = 12  # tokens of a repeat that counts
SHARD_PAGES = 256
SMALL_ROWS = 100_000  # hosts whose sizes are broadcast; more are joined by a shuffle

# fixed values: elements that break blocks, have no end tag, hold raw text, or are no main text
BREAKS = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol option p pre section summary table tbody tfoot thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe svg math select button".split())
DROP = RAW | frozenset("head title nav header footer aside form dialog menu object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# names that mark an element wholly (as a whole class or id) or as a part of a longer one:
# readers' comments always, the sure ones unless much text without links stands inside,
# the others only if links make up the text
COMMENTS = frozenset("comment comments disqus reply replies".split())
SURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr newsletter popup masthead "
    "navbar breadcrumb breadcrumbs".split())
NAMES = COMMENTS | SURE | frozenset(
    "promo promotion banner consent notice modal overlay subscribe signup sidebar menu nav navigation footer header "
    "share sharing social related widget toolbar".split())
MANY_WORDS, LINK_SHARE = 80, 0.4  # of a container that only a part of its name gives away

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
# one attribute, its value whole; a quoted string that no name owns is passed over
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?|"[^"]*"|'[^']*'""")
_WORDS = re.compile(r"[a-z0-9]+")


def _attributes(tag_rest: str) -> dict[str, str]:
    """Full lower-cased attribute names to lower-cased values; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag_rest):
        if m[1]:
            found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return found


_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

KEEP, DENSE, LINKED, SOFT, HARD = range(5)


def _verdict(tag: str, attributes: str, in_article: bool) -> int:
    """What an element is by itself: HARD (no text of it counts, whatever it holds), SOFT
    (boilerplate, unless it holds the article), DENSE or LINKED (its content decides, when
    it ends), KEEP. A header inside an article is the article's title."""
    has = _attributes(attributes) if attributes else {}
    names = {x for k in ("class", "id") for x in has.get(k, "").split()}
    parts = {w for x in names for w in _WORDS.findall(x)}
    if tag in RAW or "hidden" in has or has.get("aria-hidden") == "true" or _HIDDEN.search(has.get("style", "")):
        return HARD
    if parts & COMMENTS and tag not in ("body", "html"):
        return HARD
    if tag in DROP and not (tag == "header" and in_article) or has.get("role") in ROLES:
        return SOFT
    if tag in ("body", "html", "article", "main"):
        return KEEP
    if names & NAMES:
        return SOFT
    return DENSE if parts & SURE else LINKED if parts & NAMES else KEEP


class Block:
    """A block's text, where it stands, and how much of it is links."""

    __slots__ = ("article", "links", "main", "nested", "text", "tier")

    def __init__(self, text: str, article: int, main: int, tier: int, links: int):
        self.text, self.article, self.main, self.nested = text, article > 0, main > 0, article > 1
        self.tier, self.links = tier, links


def _is_boilerplate(kind: int, inside: list[Block]) -> bool:
    chars = sum(len(b.text) for b in inside)
    linked = sum(min(b.links, len(b.text)) for b in inside) >= LINK_SHARE * chars
    return linked or (kind == DENSE and sum(len(b.text.split()) for b in inside) < MANY_WORDS)


def _chosen(found: list[Block]) -> list[str]:
    """Of the blocks in articles (or main elements): those of the least doubtful place, and
    without the articles inside articles (comments, as a rule) if they leave anything."""
    least = min((b.tier for b in found), default=0)
    near = [b for b in found if b.tier == least]
    return [b.text for b in [b for b in near if not b.nested] or near]


def blocks(page: str, gone: list[str] | None = None) -> tuple[list[str], list[str], list[str]]:
    """The page's blocks outside boilerplate: in articles, in main elements, anywhere.
    ``gone`` gets the text around them: what the markup names as boilerplate, a piece
    between two tags each, and blocks outside of the articles, if there are any.

    An article or main element counts also inside an element that is boilerplate by its
    name (a form around the page, a class like with-sidebar), but after those that stand
    free; only hidden elements and readers' comments rule out what they hold."""
    found: list[Block] = []
    pieces: list[str] = []
    links = 0
    # open elements: name, verdict, place in ``found`` where it began, state outside of it
    stack: list[tuple[str, int, int, tuple[int, int] | None]] = []
    opened: Counter[str] = Counter()
    soft = hard = tier = 0

    def close() -> str:
        nonlocal soft, hard, tier
        name, verdict, began, outside = stack.pop()
        opened[name] -= 1
        if outside:
            soft, tier = outside
        soft -= verdict == SOFT
        hard -= verdict == HARD
        if verdict in (DENSE, LINKED) and _is_boilerplate(verdict, found[began:]):
            if gone is not None:
                gone.extend(b.text for b in found[began:])
            del found[began:]
        return name

    def end_block() -> None:
        nonlocal links
        text = " ".join(entities.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            found.append(Block(text, opened["article"], opened["main"], tier, links))
        links = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not (soft or hard):
            piece = page[at : m.start() if m else n]
            pieces.append(piece)
            if opened["a"]:
                links += len(piece)
        elif gone is not None and not hard:
            piece = page[at : m.start() if m else n]
            if piece and not piece.isspace():
                gone.append(" ".join(entities.unescape(piece).split()))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        stray = bool(m[1]) and not opened[tag] and tag != "p"
        if tag in BREAKS and not (soft or hard) and not stray:
            end_block()
        elif tag in ("br", "td", "th", "img") and not (soft or hard):
            pieces.append(" ")
        if m[1]:
            while opened[tag]:
                name = close()
                if name == tag:
                    break
        elif tag not in VOID and not m[3].endswith("/"):
            if tag in ("script", "style", "textarea", "noscript", "iframe"):
                end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
                continue
            if tag in BREAKS and stack and stack[-1][0] == "p":  # a paragraph ends where the next block begins
                close()
            verdict = _verdict(tag, m[3], opened["article"] > 0)
            if verdict in (DENSE, LINKED) and tag not in BREAKS:
                verdict = KEEP
            outside = None
            if tag in ("article", "main") and not opened[tag] and not hard and verdict == KEEP:
                outside = (soft, tier)
                soft, tier = 0, tier + (soft > 0)
            stack.append((tag, verdict, len(found), outside))
            opened[tag] += 1
            soft += verdict == SOFT
            hard += verdict == HARD
    end_block()
    while stack:  # elements without an end
        close()
    free = [b.text for b in found if not b.tier]
    articles, mains = [b for b in found if b.article], [b for b in found if b.main]
    if gone is not None and (articles or mains):
        gone.extend(b.text for b in found if not (b.article if articles else b.main))
    return _chosen(articles), _chosen(mains), free


PARSED = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("loose", T.ArrayType(T.StringType())),
    T.StructField("gone", T.ArrayType(T.StringType())),
])


def parsed(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, text (if the page has an article or main element; null: it has other
    blocks only), loose (those blocks), gone (the text around: evidence)."""

    def batches(rows):
        for rec in rows:
            for part in text_slices(rec, 2):
                texts, loose, gone = [], [], []
                for page in part.column(2).to_pylist():
                    named: list[str] = []
                    article, main, body = blocks(page or "", named)
                    whole = article or main
                    texts.append("\n\n".join(whole) if whole or not body else None)
                    loose.append(None if whole or not body else body)
                    gone.append(named or None)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), *[pa.array(x, pa.list_(pa.string())) for x in (loose, gone)]], names=PARSED.names)

    return df.select(col_of(id_col).cast("bigint"), col_of(url_col).cast("string"), col_of(html_col).cast("string")).mapInArrow(batches, PARSED)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to /, ?, # or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(url, r"^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- host suffix array --------------------------------------------------------------
def _stream(pages: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All tokens of the pages, with their page and their block."""
    tokens, page_of, block_of, block = [], [], [], 0
    for i, page in enumerate(pages):
        for text in page:
            words = text.split()
            tokens += words
            page_of += [i] * len(words)
            block_of += [block] * len(words)
            block += 1
    return tokens, np.array(page_of, dtype=np.int64), np.array(block_of, dtype=np.int64)


def suffix_ranks(tokens: list[str], page_of: np.ndarray, long: int = LONG) -> np.ndarray:
    """The rank of each position among all suffixes, by their first ``long`` tokens; equal
    ranks, equal tokens. -1 where fewer than ``long`` tokens of the page are left.
    Prefix doubling: ranks by w tokens give ranks by up to 2 w."""
    place = {t: i for i, t in enumerate(sorted(set(tokens)))}
    rank, width, n = np.array([place[t] for t in tokens], dtype=np.int64), 1, len(tokens)
    while width < long:
        step = min(width, long - width)
        follow = np.full(n, -1, dtype=np.int64)
        follow[: n - step] = rank[step:]
        _, rank = np.unique(rank * (rank.max() + 2) + follow + 1, return_inverse=True)
        width += step
    whole = np.zeros(n, dtype=bool)
    if n >= long:
        whole[: n - long + 1] = page_of[long - 1 :] == page_of[: n - long + 1]
    return np.where(whole, rank, -1)


def repeats(pages: list[list[str]]) -> tuple[list[int], list[int]]:
    """Hashes of the distinct substrings of ``LONG`` tokens, and in how many pages each of
    them stands: neighbours in suffix order."""
    tokens, page_of, _ = _stream(pages)
    if not tokens:
        return [], []
    rank = suffix_ranks(tokens, page_of)
    order = np.lexsort((page_of, rank))
    order = order[rank[order] >= 0]
    new = np.diff(rank[order], prepend=-1) != 0
    first = np.flatnonzero(new)
    if not len(first):
        return [], []
    counts = np.add.reduceat((new | (np.diff(page_of[order], prepend=-1) != 0)).astype(np.int64), first)
    # of equal substrings, any stands for them
    return [_hash(tokens, i) for i in order[first].tolist()], counts.tolist()


def _hash(tokens: list[str], at: int) -> int:
    return xxhash.xxh64_intdigest(" ".join(tokens[at : at + LONG]).encode()) - (1 << 63)


def unique_runs(pages: list[list[str]], boilerplate: set[int]) -> list[str]:
    """Each page's text without the tokens that boilerplate substrings cover."""
    tokens, page_of, block_of = _stream(pages)
    n = len(tokens)
    cover = np.zeros(n + 1, dtype=np.int64)
    for i in range(n - LONG + 1):
        if page_of[i] == page_of[i + LONG - 1] and _hash(tokens, i) in boilerplate:
            cover[i] += 1
            cover[i + LONG] -= 1
    stays = np.cumsum(cover[:n]) == 0
    out: list[dict[int, list[str]]] = [{} for _ in pages]
    for i in np.flatnonzero(stays).tolist():
        out[page_of[i]].setdefault(block_of[i], []).append(tokens[i])
    return ["\n\n".join(" ".join(words) for words in page.values()) for page in out]


def without_repeats(pages: DataFrame) -> DataFrame:
    """page_id, url, text of those pages (page_id, url, loose, gone) that have loose blocks:
    without what their host repeats, by the arrays over the loose and the gone text of all
    its pages."""
    host = F.coalesce(host_of(F.col("url")), F.lit(""))
    pages = pages.where("loose IS NOT NULL OR gone IS NOT NULL").select(
        "page_id", "url", "loose", "gone", host.alias("host"), F.monotonically_increasing_id().alias("row"))
    pages = staged(pages, "loose")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.ceil(F.count(F.lit(1)) / SHARD_PAGES).alias("shards"))
    pages = pages.join(bounded_broadcast(sizes, SMALL_ROWS), "host").select(
        "host", F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard"), "page_id", "url", "loose", "gone")
    # dealt by host, a host's shards would stay in one task
    pages = pages.repartition("host", "shard")
    undecided = pages.where("loose IS NOT NULL").drop("gone")
    windows = T.StructType([
        T.StructField("host", T.StringType()), T.StructField("shard", T.LongType()), T.StructField("h", T.LongType()),
        T.StructField("own", T.LongType()), T.StructField("named", T.LongType())])

    def arrays(key: tuple, rows: pa.Table) -> pa.Table:
        name, shard = key[0].as_py(), key[1].as_py()
        out = []
        for column in ("loose", "gone"):
            h, n = repeats([x or [] for x in rows.column(column).to_pylist()])
            counts = [pa.array(n, pa.int64()), pa.array([0] * len(h), pa.int64())]
            out.append(pa.table([pa.array([name] * len(h), pa.string()), pa.array([shard] * len(h), pa.int64()), pa.array(h, pa.int64()),
                                 *(counts if column == "loose" else counts[::-1])], names=windows.names))
        return pa.concat_tables(out)

    found = staged(pages.groupBy("host", "shard").applyInArrow(arrays, windows), "substrings")
    known = found.groupBy("host", "h").agg(F.sum("own").alias("own"), F.sum("named").alias("named")).where("own > 0").join(sizes, "host")
    known = known.where("own > 1 OR named > 1 AND 2 * named >= pages")
    mine = found.where("own > 0").select("host", "shard", "h").join(known.select("host", "h"), ["host", "h"])
    result = T.StructType([*PARSED.fields[:3]])

    def removed(key: tuple, rows: pa.Table, substrings: pa.Table) -> pa.Table:
        texts = unique_runs(rows.column("loose").to_pylist(), set(substrings.column("h").to_pylist()))
        return pa.table([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string())], names=result.names)

    return undecided.groupBy("host", "shard").cogroup(mine.groupBy("host", "shard")).applyInArrow(removed, result)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text for each row of ``df``."""
    pages = staged(parsed(df, id_col, url_col, html_col), "parsed")
    whole = pages.where("loose IS NULL").select("page_id", "url", "text")
    return whole.unionByName(without_repeats(pages))
