"""Word shingles and circulant MinHash signatures of Arrow batches (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
U64, U32 = np.uint64, np.uint32
# odd multipliers of the shingle hash, one for each word of a shingle and one for its length
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=U64)
_LENGTH = _MULT[SHINGLE] * np.arange(SHINGLE + 1, dtype=U64)
SIGMA_SEED = U32(0x5BD1E995)
CHUNK = 1 << 15  # shingles whose signature is made at once: fits a core's cache
LONG_WORD = 64  # bytes from which a word is hashed by itself
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit universe, in place."""
    x ^= x >> U32(16)
    x *= U32(0x85EBCA6B)
    x ^= x >> U32(13)
    x *= U32(0xC2B2AE35)
    x ^= x >> U32(16)
    return x


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each run without ASCII white space, all words at once: eight
    bytes of every word in each step."""
    space = np.ones(len(data) + 2, dtype=bool)
    np.take(_SPACE, np.frombuffer(data, dtype=np.uint8), out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, sizes = edges[0::2], edges[1::2] - edges[0::2]
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data + bytes(8), strides=(1,))  # from any byte on

    def piece(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return eight[at] & (U64(2**64 - 1) >> (U64(64) - U64(8) * np.minimum(left, 8).astype(U64)))

    hashes = _mix64(_mix64(sizes.astype(U64) * _MULT[0]) ^ (piece(starts, sizes) * _MULT[1]))
    done = 8
    more = np.flatnonzero((sizes > done) & (sizes <= LONG_WORD))
    while len(more):
        hashes[more] = _mix64((hashes[more] ^ piece(starts[more] + done, sizes[more] - done)) * _MULT[1])
        done += 8
        more = more[sizes[more] > done]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return starts, hashes


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The set of each text: sorted distinct 64-bit hashes of its shingles. A-Z are
    lower-cased, words are runs without ASCII white space. A text of one to four words
    has one element, its whole sequence; without words the set is empty."""
    raw = [t.encode() if t else b"" for t in texts]
    starts, flat = word_hashes(b"\n".join(raw).lower())  # bytes: ASCII rules only
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    offsets = np.searchsorted(starts, begins)
    full = np.zeros(max(len(flat) - SHINGLE + 1, 0), dtype=U64)
    for j in range(SHINGLE):
        full += flat[j : j + len(full)] * _MULT[j]
    full = _mix64(full + _LENGTH[SHINGLE])
    out = []
    for a, n in zip(offsets.tolist(), np.diff(offsets).tolist()):
        if n >= SHINGLE:
            out.append(_distinct(full[a : a + n - SHINGLE + 1]))
        elif n:
            out.append(_mix64((flat[a : a + n] * _MULT[:n]).sum(keepdims=True) + _LENGTH[n]))
        else:
            out.append(full[:0])
    return out


def digest(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; none for the empty set."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(sets: list[np.ndarray], width: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets, ``width`` coordinates each. ``sigma`` permutes
    the universe once; coordinate k is the minimum of one other permutation ``pi`` that is
    shifted circularly by k: min over the set of pi((sigma(x) - k) mod 2**32)."""
    out = np.empty((len(sets), width), dtype=U32)
    lens = np.array([len(s) for s in sets])
    chunk = np.cumsum(lens) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(sets)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        sigma = _mix32((np.concatenate(sets[a:b]) >> U64(32)).astype(U32) ^ SIGMA_SEED)
        starts = np.concatenate([[0], np.cumsum(lens[a:b])[:-1]])
        shifted, half = np.empty_like(sigma), np.empty_like(sigma)
        for k in range(width):
            np.subtract(sigma, U32(k), out=shifted)
            for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
                np.right_shift(shifted, U32(shift), out=half)
                np.bitwise_xor(shifted, half, out=shifted)
                if factor > 1:
                    np.multiply(shifted, U32(factor), out=shifted)
            out[a:b, k] = np.minimum.reduceat(shifted, starts)
    return out


def band_keys(sigs: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` coordinates (an even number)."""
    n, width = sigs.shape
    pairs = np.ascontiguousarray(sigs).view(U64).reshape(n, width // rows, rows // 2)
    key = _mix64(np.arange(width // rows, dtype=U64) + U64(1))[None, :].repeat(n, axis=0)
    for j in range(rows // 2):
        key = _mix64(key + pairs[:, :, j] * _MULT[j])
    return key.view(np.int64)
