"""Token counts (operator 13): two-tier lookup of pre-token lengths.

A word-end BPE tokenizer (lower case, white space dropped, BPE inside each pre-token)
gives a text as many tokens as its pre-tokens have together, and a pre-token's number
depends on its characters alone. So nothing is encoded twice and nothing is shuffled:

* tier one is a table of frequent pre-tokens with their lengths, found in a bounded sample
  of the input (``SAMPLE_ROWS`` rows, ``SAMPLE_CHARS`` characters of each, ``FREQUENT``
  entries), encoded once and broadcast as two flat buffers;
* tier two is a cache in each Python worker: a pre-token that the table lacks is encoded
  by the library once and kept, up to ``CACHED`` entries.

The sample decides about speed only; every text is counted whole, in windows cut at
white space. Pre-tokens are cut here where the rule is beyond doubt: in runs of ASCII and
of Latin letters with accents. A run between blanks that holds any other character
(composition, case and classes by other Unicode tables) or the string of an added token
goes to the library as it is, through the same cache, so its defaults decide there.

A ``.json`` file whose normaliser or pre-tokenizer is of another form, and a sentencepiece
``.model``, are applied to whole texts by their library: right, but without the table.

Defined results
* a null text is empty: no bytes, no tokens; an empty text too;
* no begin, end or other added token is counted that the text doesn't contain itself;
* every row gives a row, repeated ids and repeated rows too; a null id stays null;
* an empty table gives an empty result; other columns are not read, whatever their names;
* a very long text is held once and counted by windows of ``WINDOW`` characters; a run
  without any blank that is longer than that is encoded in one piece.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import col_of, text_or_empty, text_slices, tidy

SAMPLE_ROWS, SAMPLE_CHARS, FREQUENT = 500, 1 << 16, 1 << 16
CACHED, CACHED_CHARS = 1 << 18, 64
WINDOW = 1 << 18

# fixed values: the form of tokenizer whose pre-tokens are cut here
NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

BLANK = " \t\n\r\f\v"
_LATIN = "ß-öø-ÿĀ-ſ"  # lower-case text: letters with accents, composed, one character each
_PLAIN = re.compile(f"[\x00-\x7fÀ-ÖØ-öø-įı-ſ]*")  # without the dotted capital I, which lower-cases to two
_CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^{BLANK}a-z{_LATIN}0-9]+")
_BLANKS = re.compile(f"[{BLANK}]+")

COUNTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
])


def pre_tokens(text: str, added: re.Pattern | None) -> Iterator[str]:
    """What a text's tokens are counted over: pre-tokens, and whole runs between blanks
    where only the library knows the pre-tokens."""
    if _PLAIN.fullmatch(text) and not (added and added.search(text)):
        return iter(_CUT.findall(text.lower()))
    runs = _BLANKS.split(text)
    odd = [r for r in runs if not _PLAIN.fullmatch(r) or (added and added.search(r))]
    if not odd:
        return iter(_CUT.findall(text.lower()))
    strange = set(odd)
    plain = " ".join(r for r in runs if r not in strange)
    return chain(_CUT.findall(plain.lower()), odd)


def windows(text: str) -> Iterator[str]:
    """Pieces of a text, cut at blanks."""
    start = 0
    while len(text) - start > WINDOW:
        found = _BLANKS.search(text, start + WINDOW)
        if not found:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:] if start else text


class Lengths(dict):
    """Pre-token -> number of tokens: the frequent ones, and those met since."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int]):
        super().__init__(frequent)
        self.frequent, self.encode = frequent, encode

    def __missing__(self, run: str) -> int:
        n = self.encode(run)
        if len(run) <= CACHED_CHARS:
            if len(self) >= len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[run] = n
        return n

    def count(self, text: str, added: re.Pattern | None) -> int:
        return sum(sum(map(self.__getitem__, pre_tokens(w, added))) for w in windows(text))


class Tokenizer:
    """A tokenizer file's content, made ready in a worker."""

    def __init__(self, content: bytes, kind: str):
        self.added = None
        self.by_pre_token = False
        if kind == "model":
            import sentencepiece

            self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.encode = lambda s: len(self._model.encode(s))
            return
        import tokenizers

        model = tokenizers.Tokenizer.from_str(content.decode())
        model.no_truncation()
        model.no_padding()
        self.encode = lambda s: len(model.encode(s, add_special_tokens=False).ids)
        form = json.loads(content)
        self.by_pre_token = _cuts_here(form)
        names = [t["content"] for t in form.get("added_tokens", [])]
        if names:
            self.added = re.compile("|".join(map(re.escape, names)))


def _cuts_here(form: dict) -> bool:
    normal, pre, model = (form.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    steps = pre.get("pretokenizers", [])
    return (
        normal.get("normalizers") == NORMALIZER
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": PRE_TOKEN} and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and model.get("type") == "BPE" and not model.get("dropout")
        # added tokens stand apart from blanks, or a window's edge could change them
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or set(BLANK) & set(t["content"])
                    for t in form.get("added_tokens", []))
    )


def frequent_lengths(df: DataFrame, text_col: str, tokenizer: Tokenizer) -> tuple[bytes, np.ndarray]:
    """Tier one as flat buffers: the pre-tokens, a line feed between, and their lengths."""
    rows = df.select(F.left(text_or_empty(text_col), F.lit(SAMPLE_CHARS))).limit(SAMPLE_ROWS).collect()
    seen: Counter[str] = Counter()
    for (text,) in rows:
        seen.update(r for r in pre_tokens(text, tokenizer.added) if len(r) <= CACHED_CHARS)
    runs = [r for r, _ in seen.most_common(FREQUENT)]  # no run holds a line feed: it is a blank
    return "\n".join(runs).encode(), np.array([tokenizer.encode(r) for r in runs], dtype=np.uint16)


def token_counts(df: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row."""
    kind = "model" if tokenizer_path.endswith(".model") else "json"
    with open(tokenizer_path, "rb") as f:  # on the driver; workers get its content
        content = f.read()
    local = Tokenizer(content, kind)
    table = frequent_lengths(df, text_col, local) if local.by_pre_token else (b"", np.zeros(0, np.uint16))
    shared = df.sparkSession.sparkContext.broadcast((content, kind, *table))

    def count(batches):
        content, kind, runs, lens = shared.value
        model = Tokenizer(content, kind)
        lengths = Lengths(dict(zip(runs.decode().split("\n"), lens.tolist())) if runs else {}, model.encode)
        with tidy(lengths, lengths.frequent):
            for batch in batches:
                for rec in text_slices(batch, 1):
                    texts = rec.column(1).to_pylist()
                    if model.by_pre_token:
                        n = [lengths.count(t, model.added) for t in texts]
                    else:
                        n = [model.encode(t) for t in texts]
                    yield pa.record_batch([rec.column(0), rec.column(2), pa.array(n, pa.int64())], names=COUNTS.names)

    text = text_or_empty(text_col)
    rows = df.select(col_of(id_col).cast("bigint").alias("id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    return rows.mapInArrow(count, COUNTS).withColumn("over_limit", F.col("n_tokens") > limit)
