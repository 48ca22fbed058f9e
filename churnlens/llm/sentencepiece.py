"""SentencePiece encoding and decoding (operator 1).

Unigram Viterbi over a byte-wise double-array trie of the vocabulary's pieces. The
vocabulary is a public SentencePiece model file (a path given by the caller, read on
the driver: its size does not depend on the data). Nothing is trained.

A BPE file stores merge ranks in place of log probabilities. ``zipf_scores`` turns a
rank r into log(1 / ((r + 1) H)), the Zipf law normalised over the vocabulary; a
Unigram file's scores are taken as they are.

Work in a task: texts are cut before each run of whitespace markers. No piece spans
such a cut (checked when the vocabulary is loaded, else texts stay whole), so the best
path of a text is the best paths of its segments one after another. The segments of a
batch that are not in the worker's bounded cache are encoded together: one numpy step
per byte position and trie depth for all of them. Segments longer than ``LANE_BYTES``
go through the same recurrence one by one, so one very long word does not widen the
matrix.

Defined results
* a null text has null ids, n_tokens 0 and decodes to null; an empty text has no ids;
* a character without a piece becomes its UTF-8 bytes' pieces; if the vocabulary has
  no byte pieces, the unknown id (such a text does not round-trip);
* U+2581 in a text is the marker itself and decodes to a space (as the format has it);
  ``round_trip`` is false then;
* equal scores: the path whose last piece starts first wins;
* a very long text is a slice of its own and is encoded whole; a single run without blanks
  takes some 100 bytes of memory a byte of it;
* repeated rows give repeated results; an empty table gives an empty result; other columns
  are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import col_of, text_slices, tidy

MARK = "▁"
MARK_BYTES = MARK.encode()
NORMAL, UNKNOWN, BYTE = 1, 2, 6  # piece types of the public model format
UNK_PENALTY = 10.0  # the format's: an unknown character scores this much below the worst piece
FIXED = float(1 << 20)  # fixed-point unit of a score
LANE_BYTES = 64
CACHE_SEGMENTS = 300_000
LANES = 20_000  # segments encoded at once


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probabilities from merge ranks (0, 1, 2 ...): Zipf's law over the vocabulary."""
    weights = 1.0 / (1.0 + ranks)
    return np.log(weights / weights.sum())


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and log scores; ``byte_ids[b]`` is the piece of byte b, or -1."""

    pieces: tuple[str, ...]
    kinds: tuple[int, ...]
    scores: tuple[float, ...]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = tuple(p.type for p in model.pieces)
        raw = np.array([p.score for p in model.pieces], dtype=np.float64)
        if model.trainer_spec.model_type == 2:  # BPE: score = -rank
            at = np.array([k == NORMAL for k in kinds])
            raw[at] = zipf_scores(-raw[at])
        return cls(tuple(p.piece for p in model.pieces), kinds, tuple(raw.tolist()))


class DoubleArray:
    """A trie over bytes in two arrays: from state s, byte b leads to t = base[s] + b + 1
    if check[t] == s. ``value[t]`` is the piece that ends at t, or -1. Byte slots start
    at 1 so that the slot 0 of padding never matches."""

    def __init__(self, keys: list[bytes], values: list[int]):
        kids: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in zip(keys, values):
            node = 0
            for b in key:
                if b not in kids[node]:
                    kids[node][b] = len(kids)
                    kids.append({})
                    ends.append(-1)
                node = kids[node][b]
            ends[node] = value
        size = 16 * len(kids) + 1024
        base, check, value = (np.full(size, x, dtype=np.int32) for x in (0, -1, -1))
        used = bytearray(size)
        used[0] = 1
        slot = {0: 0}
        resume = [1] * 257  # where the search for a node with so many children goes on
        top = 0
        for node in range(len(kids)):  # parents come before children
            at = slot[node]
            value[at] = ends[node]
            labels = sorted(b + 1 for b in kids[node])
            if not labels:
                continue
            free = used.find(0, max(resume[len(labels)], labels[0]))
            while any(used[free - labels[0] + c] for c in labels):
                free = used.find(0, free + 1)
            resume[len(labels)] = free
            base[at] = free - labels[0]
            for c in labels:
                to = free - labels[0] + c
                used[to] = 1
                check[to] = at
                slot[kids[node][c - 1]] = to
                top = max(top, to)
        top += 258
        self.base, self.check, self.value = base[:top].copy(), check[:top].copy(), value[:top].copy()


class Encoder:
    def __init__(self, vocab: Vocabulary):
        normal = [i for i, k in enumerate(vocab.kinds) if k == NORMAL and vocab.pieces[i]]
        self.trie = DoubleArray([vocab.pieces[i].encode() for i in normal], normal)
        self.score = np.round(np.array(vocab.scores) * FIXED)  # whole numbers: sums are exact, so ties are
        self.longest = max((len(vocab.pieces[i].encode()) for i in normal), default=1)
        self.unk_score = min((self.score[i] for i in normal), default=0.0) - UNK_PENALTY * FIXED
        self.unk_id = next((i for i, k in enumerate(vocab.kinds) if k == UNKNOWN), 0)
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        for i, k in enumerate(vocab.kinds):
            if k == BYTE:
                self.byte_ids[int(vocab.pieces[i][3:5], 16)] = i
        crossing = re.compile(f"[^{MARK}]{MARK}")
        whole = any(crossing.search(vocab.pieces[i]) for i in normal)
        self.cut = re.compile("(?s).+" if whole else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.spell = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k not in (NORMAL, UNKNOWN)
            else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(vocab.pieces, vocab.kinds)
        ]
        self.cache: dict[str, bytes] = {}

    # one segment -------------------------------------------------------------------
    def viterbi(self, seg: bytes) -> list[int]:
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        n = len(seg)
        best = [-np.inf] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if best[i] == -np.inf:
                continue
            width, single, at = _width(seg[i]), False, 0
            for j in range(i, min(n, i + self.longest)):
                nxt = int(base[at]) + seg[j] + 1
                if check[nxt] != at:
                    break
                at = nxt
                piece = int(value[at])
                if piece >= 0:
                    single |= j + 1 - i == width
                    if best[i] + score[piece] > best[j + 1]:
                        best[j + 1], back[j + 1] = best[i] + score[piece], (i, piece)
            if not single and best[i] + self.unk_score > best[i + width]:
                best[i + width], back[i + width] = best[i] + self.unk_score, (i, -1)
        out, i = [], n
        while i:
            start, piece = back[i]
            out.append([piece] if piece >= 0 else self._spelled(seg[start:i]))
            i = start
        return [x for part in reversed(out) for x in part]

    def _spelled(self, char: bytes) -> list[int]:
        ids = self.byte_ids[list(char)].tolist()
        return ids if min(ids) >= 0 else [self.unk_id]

    # many segments at once ---------------------------------------------------------
    def viterbi_many(self, segs: list[bytes]) -> list[bytes]:
        """Best paths of short segments, as little-endian int32 bytes. Lanes are rows of a
        matrix; at each start position all lanes walk the trie together and drop out as
        their walks end."""
        lens = np.array([len(s) for s in segs])
        n, width = len(segs), int(lens.max())
        flat = np.frombuffer(b"".join(segs), dtype=np.uint8)
        text = np.zeros((n, width + 1), dtype=np.int32)
        rows = np.repeat(np.arange(n), lens)
        cols = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        text[rows, cols] = flat.astype(np.int32) + 1
        best = np.full((n, width + 5), -np.inf)
        best[:, 0] = 0.0
        start = np.zeros((n, width + 5), dtype=np.int32)
        piece = np.full((n, width + 5), -1, dtype=np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for i in range(width):
            live = np.flatnonzero((lens > i) & (best[:, i] > -np.inf))
            if not len(live):
                continue
            char = _WIDTHS[text[live, i] - 1]
            single = np.zeros(len(live), dtype=bool)
            lane, at = np.arange(len(live)), np.zeros(len(live), dtype=np.int32)
            for j in range(i, min(width, i + self.longest)):
                byte = text[live[lane], j]
                nxt = base[at] + byte
                ok = (check[nxt] == at) & (byte > 0)
                lane, at = lane[ok], nxt[ok]
                if not len(lane):
                    break
                ends = value[at]
                hit = ends >= 0
                if hit.any():
                    single[lane[hit & (char[lane] == j + 1 - i)]] = True
                    self._relax(best, start, piece, live[lane[hit]], i, j + 1, ends[hit], self.score[ends[hit]])
            for w in (1, 2, 3, 4):
                bare = live[~single & (char == w)]
                if len(bare):
                    self._relax(best, start, piece, bare, i, i + w, -1, self.unk_score)
        return self._paths(segs, lens, start, piece)

    @staticmethod
    def _relax(best, start, piece, lanes, i, j, ids, score) -> None:
        new = best[lanes, i] + score
        better = new > best[lanes, j]
        lanes = lanes[better]
        best[lanes, j] = new[better]
        start[lanes, j] = i
        piece[lanes, j] = ids[better] if isinstance(ids, np.ndarray) else ids

    def _paths(self, segs, lens, start, piece) -> list[bytes]:
        pos, steps = lens.copy(), []
        lane = np.arange(len(segs))
        while len(lane):
            steps.append((lane, start[lane, pos[lane]], piece[lane, pos[lane]]))
            pos[lane] = steps[-1][1]
            lane = lane[pos[lane] > 0]
        lanes = np.concatenate([s[0] for s in steps])
        starts = np.concatenate([s[1] for s in steps])
        ids = np.concatenate([s[2] for s in steps]).astype(np.int32)
        order = np.lexsort((starts, lanes))
        lanes, ids, starts = lanes[order], ids[order], starts[order]
        cuts = np.searchsorted(lanes, np.arange(len(segs) + 1))
        raw = ids.tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for lane in np.unique(lanes[ids < 0]).tolist():  # spell unknown characters in bytes
            seg, ends = segs[lane], [*starts[cuts[lane] + 1 : cuts[lane + 1]].tolist(), len(segs[lane])]
            path = []
            for k, a, b in zip(ids[cuts[lane] : cuts[lane + 1]].tolist(), starts[cuts[lane] : cuts[lane + 1]].tolist(), ends):
                path += [k] if k >= 0 else self._spelled(seg[a:b])
            out[lane] = np.array(path, dtype=np.int32).tobytes()
        return out

    # texts -------------------------------------------------------------------------
    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as int32 bytes; null for null."""
        cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.cache) > CACHE_SEGMENTS:
            self.cache.clear()
        cache = self.cache
        new = [s for s in set().union(*cut) if s not in cache]
        raw = [s.encode() for s in new]
        short = [k for k, b in enumerate(raw) if len(b) <= LANE_BYTES]
        short.sort(key=lambda k: len(raw[k]))
        for a in range(0, len(short), LANES):
            part = short[a : a + LANES]
            for k, ids in zip(part, self.viterbi_many([raw[k] for k in part])):
                cache[new[k]] = ids
        for k, b in enumerate(raw):
            if len(b) > LANE_BYTES:
                cache[new[k]] = np.array(self.viterbi(b), dtype=np.int32).tobytes()
        found = cache.__getitem__
        return [None if t is None else b"".join(map(found, c)) for t, c in zip(texts, cut)]

    def decode(self, ids: list[int]) -> str:
        """Pieces to text: byte pieces become bytes, markers become spaces, and the space
        that encoding put in front goes."""
        raw = b"".join(map(self.spell.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")


def _width(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


_WIDTHS = np.array([_width(b) for b in range(256)])


@lru_cache(maxsize=2)
def encoder(vocab: Vocabulary) -> Encoder:
    """One encoder with its trie for each worker process and vocabulary."""
    return Encoder(vocab)


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, token_ids, n_tokens, n_byte_tokens, round_trip (the ids decode to the text)."""
    vocab = Vocabulary.load(model_path)
    shared = df.sparkSession.sparkContext.broadcast(vocab)  # bounded: the vocabulary file
    schema = T.StructType([
        T.StructField("id", df.schema[id_col].dataType),
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_byte_tokens", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ])

    def coded(enc: Encoder, is_byte: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1).to_pylist()
        packed = enc.encode(texts)
        lens = np.array([len(p) // 4 if p else 0 for p in packed], dtype=np.int64)
        flat = np.frombuffer(b"".join(p or b"" for p in packed), dtype=np.int32)
        cuts = np.concatenate([[0], np.cumsum(lens)])
        ids = pa.ListArray.from_arrays(
            pa.array([None if p is None else int(a) for p, a in zip(packed, cuts)] + [int(cuts[-1])], pa.int32()), pa.array(flat))
        sums = np.concatenate([[0], np.cumsum(is_byte[flat])])
        listed = flat.tolist()
        same = [t is None or enc.decode(listed[a:b]) == t for t, a, b in zip(texts, cuts[:-1].tolist(), cuts[1:].tolist())]
        return pa.record_batch([part.column(0), ids, pa.array(lens), pa.array(sums[cuts[1:]] - sums[cuts[:-1]]), pa.array(same)],
                               names=schema.names)

    def batches(rows):
        enc = encoder(shared.value)
        is_byte = np.zeros(len(enc.spell), dtype=bool)
        is_byte[enc.byte_ids[enc.byte_ids >= 0]] = True
        with tidy(enc.cache):
            for rec in rows:
                for part in text_slices(rec, 1):
                    yield coded(enc, is_byte, part)

    picked = df.select(col_of(id_col).alias("id"), col_of(text_col).cast("string").alias("text"))
    return picked.mapInArrow(batches, schema)


def decode(df: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "token_ids") -> DataFrame:
    """id, text: the inverse of ``encode``; null ids give a null text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def batches(rows):
        enc = encoder(shared.value)
        for rec in rows:
            texts = [None if x is None else enc.decode(x) for x in rec.column(1).to_pylist()]
            yield pa.record_batch([rec.column(0), pa.array(texts, pa.string())], names=schema.names)

    return df.select(col_of(id_col).alias("id"), col_of(ids_col).alias("ids")).mapInArrow(batches, schema)
