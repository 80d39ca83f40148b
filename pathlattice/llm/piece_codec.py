"""SentencePiece encoding and decoding by vectorised merge rounds, in numpy on blocks of texts.

A block of texts becomes one flat array of characters. It is cut into words wherever two neighbouring characters stand side by
side in no piece: no merge can ever cross such a place, so words are encoded on their own, each distinct word of a block once. A round finds
the least pair rank of every word (a segmented minimum), merges all leftmost pairs of that rank at once, and closes the gaps;
finished words leave the arrays; it ends when no pair remains.

One merge at a time, best rank first and leftmost among equals, is what the library does. Merging all pairs of one rank at once gives the
same result unless a piece just made has a pair of the same or a better rank with a neighbour; then only the merges up to that one
are made in this round. Runs of spaces (pieces of spaces alone come after all others) are merged last, by the run's length.

Decoding gathers the bytes of the pieces, byte pieces included, and takes off the space put before a text.

Cases: a null or empty text has the begin and end ids alone and decodes to ""; ties and repeated rows are encoded like any others; an empty
table gives no row; other columns are ignored. A text longer than a block is encoded part by part, cut between words, so memory
follows the block and the result, not the text (a single word without any cut must fit).
"""

from __future__ import annotations

import codecs
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import map_arrow

BLOCK_CHARS = 1 << 19
SPACE = 0x2581  # stands for a space in pieces
CODES = 0x110000
NONE = np.int32(2**31 - 1)
_SLOT = np.uint64(0x9E3779B97F4A7C15)
codecs.register_error("one-mark-a-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """The tables of a BPE piece model with byte fallback: characters, pairs with their ranks, and the bytes of the pieces.

    Symbols are piece ids; a character that only occurs inside longer pieces has a symbol behind the last id."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        norm, train = m.normalizer_spec, m.trainer_spec
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
                or not norm.escape_whitespaces or train.model_type != 2 or not train.byte_fallback
                or train.treat_whitespace_as_suffix):
            raise ValueError("a BPE model with byte fallback, identity normalisation and a space before the text is needed")
        kinds = [p.type for p in m.pieces]
        if any(k in (4, 5) for k in kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        text = [p.piece for p in m.pieces]
        normal = {t: i for i, (t, k) in enumerate(zip(text, kinds)) if k == 1}
        self.begin, self.end = (next(i for i, t in enumerate(text) if t == x and kinds[i] == 3)
                                for x in (train.bos_piece or "<s>", train.eos_piece or "</s>"))
        self.size = len(text)

        mark = chr(SPACE)
        spaces = {t for t in normal if len(t) > 1 and not t.strip(mark)}
        longer = [t for t in normal if len(t) > 1 and t not in spaces]
        least = min(m.pieces[normal[t]].score for t in longer)
        if any(mark in t[1:] for t in longer) or any(m.pieces[normal[t]].score >= least for t in spaces):
            raise ValueError("pieces with a space behind the first character must be spaces alone and rank last")

        symbols = dict(normal)
        for t in longer:
            for c in t:
                symbols.setdefault(c, len(text) + len(symbols) - len(normal))
        self.char_symbol = np.full(CODES, -1, np.int32)
        for t, i in symbols.items():
            if len(t) == 1:
                self.char_symbol[ord(t)] = i

        # which characters stand side by side in a piece
        inside = sorted({c for t in longer for c in t})
        self.char_class = np.zeros(CODES, np.uint16)
        self.char_class[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        number = {c: i + 1 for i, c in enumerate(inside)}
        self.classes = len(inside) + 1
        self.bridge = np.zeros(self.classes * self.classes, bool)
        for t in longer:
            for a, b in zip(t, t[1:]):
                self.bridge[number[a] * self.classes + number[b]] = True

        rank_of = {s: r for r, s in enumerate(sorted({m.pieces[i].score for i in normal.values()}, reverse=True))}
        rank = {t: rank_of[m.pieces[i].score] for t, i in normal.items()}
        pairs = [(symbols[t[:c]], symbols[t[c:]], i, rank[t]) for t, i in normal.items() if t not in spaces
                 for c in range(1, len(t)) if t[:c] in symbols and t[c:] in symbols]
        a, b, made, r = (np.array(x, np.int64) for x in zip(*pairs))
        self.width = len(text) + len(symbols) - len(normal)
        self._index(a * self.width + b, made.astype(np.int32), r.astype(np.int32))
        # pieces that may go on into a pair of the same or a better rank
        own = np.full(self.width, -1, np.int64)
        own[list(normal.values())] = [rank[t] for t in normal]
        self.hasty = np.zeros(self.width, bool)
        self.hasty[a[r <= own[a]]] = True
        self.hasty[b[r <= own[b]]] = True

        self.space = symbols.get(mark, -1)
        self.space_pieces = {len(t): (normal[t], rank[t]) for t in spaces}

        out = [b""] * self.size
        for i, (t, k) in enumerate(zip(text, kinds)):
            out[i] = (bytes([int(t[1:-1], 16)]) if k == 6 else b"" if k == 3 else
                      (train.unk_surface or " ⁇ ").encode() if k == 2 else t.replace(mark, " ").encode())
        self.byte_id = np.full(256, -1, np.int32)
        for i, k in enumerate(kinds):
            if k == 6:
                self.byte_id[out[i][0]] = i
        self.out_len = np.array([len(x) for x in out], np.int64)
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)

    def _index(self, keys, made, rank) -> None:
        """An open-addressed table of the pairs: a key's slot is its hash, or the next free one."""
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self._shift = np.uint64(64 - bits)
        slots = 1 << bits
        self.key, self.made, self.rank = np.full(slots, -1, np.int64), np.zeros(slots, np.int32), np.full(slots, NONE, np.int32)
        home = ((keys.astype(np.uint64) * _SLOT) >> self._shift).astype(np.int64)
        for k, m, r, s in zip(keys.tolist(), made.tolist(), rank.tolist(), home.tolist()):
            while self.key[s] != -1:
                s = (s + 1) % slots
            self.key[s], self.made[s], self.rank[s] = k, m, r

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` where there is no piece) and piece of each pair of symbols."""
        keys = a.astype(np.int64) * self.width + b
        slot = ((keys.astype(np.uint64) * _SLOT) >> self._shift).astype(np.int64)
        there = self.key[slot]
        rank, made = np.where(there == keys, self.rank[slot], NONE), self.made[slot]
        miss = np.flatnonzero((there != keys) & (there != -1))
        while len(miss):
            s = (slot[miss] + 1) % len(self.key)
            slot[miss] = s
            there = self.key[s]
            hit = there == keys[miss]
            rank[miss[hit]], made[miss[hit]] = self.rank[s[hit]], self.made[s[hit]]
            miss = miss[~hit & (there != -1)]
        return rank, made

    # ------------------------------------------------------------------ merge rounds

    def merge(self, sym: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words ``sym[off[i]:off[i+1]]`` (none empty) after all merges, and their new offsets."""
        n_words = len(off) - 1
        word = np.repeat(np.arange(n_words), np.diff(off))
        rank, made = self._ranks(sym, word)
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            best = np.minimum.reduceat(rank, starts)
            open_ = best != NONE
            if not open_.all():
                keep = np.repeat(open_, sizes)
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
                sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
                best, sizes = best[open_], sizes[open_]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            # neighbouring hits share a symbol: every second one from the left of such a run
            first = np.r_[True, hits[1:] != hits[:-1] + 1]
            at = np.flatnonzero(first)
            take = hits[(np.arange(len(hits)) - np.repeat(at, np.diff(np.r_[at, len(hits)]))) % 2 == 0]
            take = self._in_order(take, sym, word, rank, made)
            sym[take] = made[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            now = take - np.arange(len(take))
            touched = np.unique(np.r_[now, now[now > 0] - 1])
            rank[touched], made[touched] = self._ranks(sym, word, touched)
        if not done_sym:
            return sym, off
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.r_[0, np.cumsum(np.bincount(word, minlength=n_words))]

    def _ranks(self, sym, word, at=None):
        """Rank and piece of the pairs that begin at ``at`` (all); none over the end of a word."""
        at = np.arange(len(sym)) if at is None else at
        nxt = np.minimum(at + 1, len(sym) - 1)
        rank, made = self.pair(sym[at], sym[nxt])
        rank[(nxt == at) | (word[nxt] != word[at])] = NONE
        return rank, made

    def _in_order(self, take, sym, word, rank, made):
        """Without the merges that must wait: those behind one whose piece has a pair of the same or a better rank at once."""
        w = word[take]
        before_another = np.r_[w[1:] == w[:-1], False]
        c = np.flatnonzero(before_another & self.hasty[made[take]])
        if not len(c):
            return take
        i, q = take[c], made[take[c]]
        n = len(sym)
        right = np.minimum(i + 2, n - 1)
        r, _ = self.pair(q, sym[right])
        bad = (i + 2 < n) & (word[right] == word[i]) & (r <= rank[i])
        left = np.maximum(i - 1, 0)
        prev = sym[left]
        joined = np.r_[False, take[1:] == take[:-1] + 2][c]  # the symbol before is a merge of this round
        prev = np.where(joined, made[np.maximum(i - 2, 0)], prev)
        r, _ = self.pair(prev, q)
        bad |= (i > 0) & (word[left] == word[i]) & (r <= rank[i])
        c = c[bad]
        if not len(c):
            return take
        words, first = np.unique(w[c], return_index=True)
        limit = take[c[first]]
        k = np.searchsorted(words, w)
        kk = np.minimum(k, len(words) - 1)
        return take[(words[kk] != w) | (take <= limit[kk])]

    @lru_cache(maxsize=4096)
    def space_run(self, n: int) -> tuple[int, ...]:
        """The ids of ``n`` spaces in a row: one merge after another, best rank and then leftmost first."""
        size, nxt, prv = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = nxt[i]
            if j < n and size[i] + size[j] in self.space_pieces:
                heapq.heappush(heap, (self.space_pieces[size[i] + size[j]][1], i, size[i], size[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if size[i] else n
            if size[i] != a or j >= n or size[j] != b:
                continue
            size[i], size[j], nxt[i] = a + b, 0, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return tuple(self.space if s == 1 else self.space_pieces[s][0] for s in size if s)

    # ------------------------------------------------------------------ texts

    def cuts(self, chars: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character but the first."""
        k = self.char_class[chars].astype(np.int64)
        return ~self.bridge[k[:-1] * self.classes + k[1:]]

    def encode(self, chars: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (runs of spaces not yet merged) of the texts ``chars[off[i]:off[i+1]]`` and their offsets."""
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        begins = np.r_[True, self.cuts(chars)]
        begins[off[:-1][off[:-1] < len(chars)]] = True
        start = np.flatnonzero(begins)
        size = np.diff(np.r_[start, len(chars)])
        of_text = np.searchsorted(start, off)
        many = np.flatnonzero(size > 1)
        # distinct words by hash and length; a word unlike its representative stays on its own
        _, rep, inv = np.unique(tv.span_hash(tv.prefix_sums(chars), start[many], start[many] + size[many]),
                                return_index=True, return_inverse=True)
        like = many[rep][inv]
        same = size[like] == size[many]
        s, at = _spans(start[many][same], size[many][same])
        other, _ = _spans(start[like][same], size[many][same])
        if len(s):
            same[np.flatnonzero(same)[np.logical_or.reduceat(chars[s] != chars[other], at)]] = False
        alone = np.flatnonzero(~same)
        inv[alone] = len(rep) + np.arange(len(alone))
        reps = np.r_[many[rep], many[alone]]
        src, _ = _spans(start[reps], size[reps])
        sym, sym_off = self.merge(self.char_symbol[chars[src]], np.r_[0, np.cumsum(size[reps])])
        # every word's symbols in place: single characters as they are
        where, count = np.zeros(len(start), np.int64), np.ones(len(start), np.int64)
        where[many], count[many] = sym_off[inv], np.diff(sym_off)[inv]
        at = np.cumsum(count) - count
        flat, _ = _spans(where, count)
        one = np.repeat(size == 1, count)
        out = np.empty(len(flat), np.int32)
        out[~one] = sym[flat[~one]]
        out[one] = self.char_symbol[chars[start[size == 1]]]
        char = np.zeros(len(flat), np.uint32)
        char[one] = chars[start[size == 1]]
        ends = np.r_[at, len(flat)][of_text]
        return self._fall_back(out, char, ends)

    def _fall_back(self, sym, char, off):
        """Symbols without a piece become the ids of their character's UTF-8 bytes."""
        lost = np.flatnonzero((sym < 0) | (sym >= self.size))
        if not len(lost):
            return sym, off
        behind = sym[lost] >= self.size
        if behind.any():
            symbol_char = np.zeros(self.width, np.uint32)
            known = np.flatnonzero(self.char_symbol >= self.size)
            symbol_char[self.char_symbol[known]] = known
            char[lost[behind]] = symbol_char[sym[lost[behind]]]
        chars, inv = np.unique(char[lost], return_inverse=True)
        coded = [chr(c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
        size = np.array([len(x) for x in coded], np.int64)
        raw = self.byte_id[np.frombuffer(b"".join(coded), np.uint8)]
        count = np.ones(len(sym), np.int64)
        count[lost] = size[inv]
        at = np.cumsum(count) - count
        out = np.repeat(sym, count)
        src, _ = _spans((np.cumsum(size) - size)[inv], size[inv])
        dst, _ = _spans(at[lost], size[inv])
        out[dst] = raw[src]
        return out, np.r_[at, len(out)][off]

    def join_spaces(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge runs of single spaces inside each text."""
        if self.space < 0 or not self.space_pieces:
            return ids, off
        lone = ids == self.space
        begin = np.zeros(len(ids) + 1, bool)
        begin[off] = True
        follows = lone[1:] & lone[:-1] & ~begin[1:-1]
        if not follows.any():
            return ids, off
        start = np.flatnonzero(lone & np.r_[True, ~follows] & np.r_[follows, False])
        stop = np.flatnonzero(lone & np.r_[False, follows] & np.r_[~follows, True]) + 1
        runs = [np.array(self.space_run(n), np.int32) for n in (stop - start).tolist()]
        size = np.array([len(r) for r in runs], np.int64)
        keep = np.ones(len(ids), bool)
        dst, _ = _spans(start, size)
        gone, _ = _spans(start + size, stop - start - size)
        out = ids.copy()
        out[dst] = np.concatenate(runs)
        keep[gone] = False
        return out[keep], np.r_[0, np.cumsum(keep)][off]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts of ``ids[off[i]:off[i+1]]`` and their offsets."""
        size = self.out_len[ids]
        src, at = _spans(self.out_at[ids], size)
        out = self.out_bytes[src]
        ends = np.r_[at, len(out)][off]
        # the space put before a text goes, once
        full = np.flatnonzero(ends[1:] > ends[:-1])
        full = full[out[ends[:-1][full]] == 0x20]
        keep = np.ones(len(out), bool)
        keep[ends[:-1][full]] = False
        return out[keep], np.r_[0, np.cumsum(keep)][ends]


def _spans(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the spans behind each other, and where each span begins among them."""
    at = np.cumsum(size) - size
    return np.repeat(start - at, size) + np.arange(int(size.sum())), at


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The tables of a model file, once per worker."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def to_chars(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[c == 0x20] = SPACE
    return c


def encode_texts(p: Pieces, texts: list[str], block: int = BLOCK_CHARS):
    """Lists of texts in runs of about ``block`` characters: first text, ids with begin and end, offsets."""
    i = 0
    while i < len(texts):
        j, n = i + 1, len(texts[i])
        while j < len(texts) and n + len(texts[j]) <= block:
            n += len(texts[j])
            j += 1
        if n > block:
            ids, off = long_text(p, texts[i], block)
        else:
            some = ["▁" + t if t else "" for t in texts[i:j]]
            ids, off = p.encode(to_chars("".join(some)), np.cumsum([0, *map(len, some)]))
        ids, off = p.join_spaces(ids, off)
        k = np.arange(len(off) - 1)
        out = np.empty(len(ids) + 2 * len(k), np.int32)
        out[np.arange(len(ids)) + 2 * np.repeat(k, np.diff(off)) + 1] = ids
        out[off[:-1] + 2 * k], out[off[1:] + 2 * k + 1] = p.begin, p.end
        yield i, out, off + 2 * np.arange(len(off))
        i = j


def long_text(p: Pieces, text: str, block: int) -> tuple[np.ndarray, np.ndarray]:
    """One long text part by part: each part ends between two words, the rest goes with the next part."""
    parts, rest, at = [], to_chars("▁"), 0
    while at < len(text):
        chars = np.concatenate([rest, to_chars(text[at:at + block])])
        at += block
        cut = np.flatnonzero(p.cuts(chars))
        if at >= len(text):
            k = len(chars)
        elif len(cut):
            k = int(cut[-1]) + 1
        else:
            k = 0  # one word so far
        if k:
            parts.append(p.encode(chars[:k], np.array([0, k]))[0])
        rest = chars[k:]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return ids, np.array([0, len(ids)])


def codec(spark: SparkSession, docs: DataFrame, path: str, block: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids`` (begin and end ids included, little-endian u32 bytes) and ``decoded`` (their text) of every row of
    ``docs (doc_id, text)``. ``path``: a piece model that every executor can read."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        p = None
        for batch in batches:
            p = p or load(path)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, ids, off in encode_texts(p, texts, block):
                n = len(off) - 1
                raw, ends = p.decode(ids, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, n), pa.array(np.diff(off), pa.int64()),
                     _column(ids.astype("<u4").view(np.uint8), off * 4, pa.large_binary()).cast(pa.binary()),
                     _text_column(raw, ends)],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type}, n_tokens bigint, ids binary, decoded string")


def _column(data: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])


def _text_column(data: np.ndarray, off: np.ndarray) -> pa.Array:
    col = _column(data, off, pa.large_binary())
    try:
        return col.cast(pa.string())
    except pa.ArrowInvalid:  # byte pieces that make no character
        return pa.array([x.decode("utf-8", "one-mark-a-byte") for x in col.to_pylist()], pa.string())
