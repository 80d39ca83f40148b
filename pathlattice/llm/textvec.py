"""Vectorised text primitives: words, word hashes, shingles and character n-grams of a block of texts in numpy.

A block is the UTF-8 bytes of several texts behind each other plus their offsets, straight from an Arrow string
column, so no Python object is made per word. A word is a run of bytes outside 0x20 and 0x09-0x0D, which is
``[^\\x20\\x09-\\x0D]+`` on code points too, because every byte of a multi-byte character is above 0x7F. Hashes are
64-bit polynomials over the bytes (prefix sums modulo 2^64, divided by the start's power) with a final mix; they
depend on the bytes alone, never on the block.

Memory: about 40 bytes for each byte of a block. ``blocks`` cuts an Arrow column into blocks of at most
``BLOCK_BYTES``; a longer single text makes a block of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
U = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Between normalised words: every ASCII byte that is no letter or digit.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i for i < n (grown on demand, kept by the worker)."""
    if len(_POW.get("p", ())) < n:
        m = max(n, BLOCK_BYTES + 1)
        for name, base in (("p", _P), ("q", _PINV)):
            a = np.full(m, base, U)
            a[0] = 1
            _POW[name] = np.cumprod(a)
        if m > 4 * BLOCK_BYTES:  # of one very long text: do not keep
            p, q = _POW.pop("p"), _POW.pop("q")
            return p, q
    return _POW["p"], _POW["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


@dataclass
class Block:
    """Words of a block: byte positions, hash, and per text the range ``word_off[i]:word_off[i+1]``."""
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word_off: np.ndarray
    prefix: np.ndarray
    lo: int  # first row of the block in its Arrow batch

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def words_per_text(self) -> np.ndarray:
        return np.diff(self.word_off)

    def hashes(self) -> np.ndarray:
        return span_hash(self.prefix, self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    p, _ = _powers(len(data) + 1)
    out = np.empty(len(data) + 1, U)
    out[0] = 0
    np.cumsum((data.astype(U) + U(1)) * p[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``start:end``."""
    _, q = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * q[start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (from 0) of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    off = off.astype(np.int64)
    return data[off[0]:off[-1]], off - off[0]


def parse(data: np.ndarray, offsets: np.ndarray, lower: bool = False, lo: int = 0, space=SPACE) -> Block:
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~space[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    here = inside[1:-1]
    start = np.flatnonzero(here & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(here & (~inside[2:] | cut[1:])) + 1
    return Block(data, offsets, start, end, np.searchsorted(start, offsets), prefix_sums(data), lo)


def pieces(col, limit: int = BLOCK_BYTES):
    """Consecutive runs of texts of an Arrow string column: bytes, offsets, first row."""
    data, off = buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield data[off[i]:off[j]], off[i:j + 1] - off[i], i
        i = j


def blocks(col, lower: bool = False, limit: int = BLOCK_BYTES, space=SPACE):
    """Consecutive blocks of an Arrow string column; ``space`` marks the bytes between words."""
    for data, off, lo in pieces(col, limit):
        yield parse(data, off, lower, lo, space)


def parts(col, limit: int = BLOCK_BYTES):
    """Like ``pieces``, with texts longer than ``limit`` cut behind a space byte: bytes, offsets, first row, and whether more of that one
    row follows. A word longer than ``limit`` stays whole."""
    data, off = buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        a, end = int(off[i]), int(off[j])
        while end - a > limit:  # one long text
            b = a + limit
            spaces = np.flatnonzero(SPACE[data[a:b]])
            while not len(spaces) and b < end:
                b = min(end, b + limit)
                spaces = np.flatnonzero(SPACE[data[b - limit:b]]) + (b - limit - a)
            if not len(spaces) or a + int(spaces[-1]) + 1 >= end:
                break
            cut = a + int(spaces[-1]) + 1
            yield data[a:cut], np.array([0, cut - a]), i, True
            a = cut
        if j == i + 1:
            yield data[a:end], np.array([0, end - a]), i, False
        else:
            yield data[a:end], off[i:j + 1] - a, i, False
        i = j


def sums_by(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values[off[i]:off[i+1]]`` (rows of a matrix or scalars); an empty range sums to 0."""
    if len(off) == 1:
        return np.zeros((0, *values.shape[1:]), values.dtype)
    out = np.zeros((len(off) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(off) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, off[:-1][full], axis=0)
    return out


_A = [U(x) for x in (0x8CB92BA72F3D8DD7, 0xF1357AEA2E62A9C5, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F,
                     0x165667B19E3779F9)]


def shingles(b: Block, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and their ranges per text; a text of 1..k-1 words has its whole sequence as one."""
    h = b.hashes()
    n = b.words_per_text
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    off = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(b.word_off[:-1] - off[:-1], count) + np.arange(off[-1])
    size = np.repeat(np.minimum(n, k), count)
    hp = np.concatenate([h, np.zeros(k, U)])
    out = size.astype(U) * U(0x27D4EB2F165667C5)
    for j in range(k):
        out = out + np.where(j < size, hp[first + j], U(0)) * (_A[j % 5] + U(2 * (j // 5)))
    return mix(out), off


def char_starts(b: Block) -> np.ndarray:
    """Byte positions at which characters begin, and the end of the block."""
    return np.append(np.flatnonzero((b.data & 0xC0) != 0x80), len(b.data))


def char_grams(b: Block, chars: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams inside each span and their ranges per span (none in a shorter span)."""
    first = np.searchsorted(chars, start)
    count = np.maximum(np.searchsorted(chars, end) - first - n + 1, 0)
    off = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first - off[:-1], count) + np.arange(off[-1])
    return span_hash(b.prefix, chars[at], chars[at + n]), off
