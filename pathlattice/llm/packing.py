"""Packing (concatenate and cut): two-pass prefix sums over partition token totals, then fixed windows.

Pass 1 tokenises every text where it lies and writes, per document, its ids, its partition and its offset inside
that partition. The partition totals (one row per input partition) are summed up in two levels, which gives each
partition its place in one endless row of tokens; ``offset = place + offset in partition`` is then known for each
document without any sort or shuffle of tokens. Pass 2 cuts that row into windows of ``size`` tokens; a document
that crosses a border leaves one boundary record (piece) per window.

Cases: a null or empty text is the end id alone; ties and repeated rows are packed like any others; an empty table
gives no piece; other columns are ignored. Only the last window of all is not full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathlattice.llm.common import map_arrow, small, stage

SEQUENCE = 1024
END_ID = 0
MEMO_WORDS = 400_000
GROUP = 1000  # partitions summed in one task at the lower level


class WordEncoder:
    """Ids of whole texts through a word memo.

    A byte-level BPE splits a text into pieces first and merges inside each piece only. Where all white space is single
    spaces and line ends, a piece never reaches over a space (which begins a piece) or a line end (a piece of its
    own), so a text's ids are those of its words, each with the space before it. Other texts are encoded as a whole.

    ``ranks``: the same vocabulary as a rank file. With it, words not in the memo are encoded in one string and cut
    apart again at their byte lengths, several times faster than one by one; the ids are the same.
    """

    def __init__(self, path: str, ranks: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.dtype("<u2" if self.tk.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo: dict[str, bytes] = {"\n": b""}
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                          special_tokens={})
            self.lengths = np.zeros(max(table.values()) + 1, np.int64)
            self.lengths[list(table.values())] = [len(x) for x in table]
        self.line_end = self.pack(self.tk.encode("\n", add_special_tokens=False).ids)

    def pack(self, ids) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tk.encode(text, add_special_tokens=False).ids)

    def learn(self, words: list[str]) -> None:
        """Put the ids of ``words`` into the memo: one string "\\na\\nb c d", cut at the words' byte lengths."""
        asked = [w if w[0] == "\n" else " " + w for w in words]
        ids = np.array(self.fast.encode_ordinary("".join(asked)), self.kind)
        ends = np.cumsum(self.lengths[ids])
        cut = np.searchsorted(ends, np.cumsum([len(w.encode()) for w in asked]), "right")
        raw, width, a = ids.tobytes(), self.kind.itemsize, 0
        skip = len(self.line_end)
        for w, b in zip(words, (cut * width).tolist()):
            self.memo[w] = raw[a + skip:b] if w[0] == "\n" else raw[a:b]
            a = b

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, of ``self.kind``."""
        lines: list[list[list[str]] | None] = []
        need: set[str] = set()
        for t in texts:
            if " ".join(t.split()) == t.replace("\n", " "):
                parts = [x.split(" ") for x in t.split("\n")]
                lines.append(parts)
                for p in parts:
                    need.update(p[1:])
                    need.add("\n" + p[0])
            else:
                lines.append(None)
        if len(self.memo) > MEMO_WORDS:
            self.memo = {"\n": b""}
        memo = self.memo
        # a word behind a space carries it; the first word of a line (key "\n" + word) does not
        missing = [w for w in need if w not in memo]
        if self.fast:
            self.learn(missing)
        else:
            asked = [w[1:] if w[:1] == "\n" else " " + w for w in missing]
            for w, e in zip(missing, self.tk.encode_batch_fast(asked, add_special_tokens=False)):
                memo[w] = self.pack(e.ids)
        get = memo.__getitem__
        out = []
        for t, parts in zip(texts, lines):
            if parts is None:
                out.append(self.whole(t))
                continue
            out.append(self.line_end.join([get("\n" + p[0]) + b"".join(map(get, p[1:])) for p in parts]))
        return out


def tokenise(docs: DataFrame, path: str, ranks: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``part, doc_id, start`` (tokens before it in its partition), ``n`` (with the end id), ``ids``, ``width``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc, at, part = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            enc = enc or WordEncoder(path, ranks)
            end, width = enc.pack([end_id]), enc.kind.itemsize
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                ids = [x + end for x in enc.encode([t or "" for t in piece.column("text").to_pylist()])]
                n = np.array([len(x) // width for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), piece.column("doc_id"), pa.array(starts),
                     pa.array(n), pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32())],
                    names=["part", "doc_id", "start", "n", "ids", "width"])

    return map_arrow(docs.select("doc_id", "text"), run,
                     f"part int, doc_id {id_type}, start bigint, n bigint, ids binary, width int")


def part_places(tokens: DataFrame) -> DataFrame:
    """Tokens before each partition: ``part, place``. Two levels, so no task sums more than ``GROUP`` partitions or
    more than one row per ``GROUP`` partitions; the rows are one per input partition, never per document."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).withColumn("g", F.floor(F.col("part") / GROUP))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy("g").agg(F.sum("n").alias("gn")).select(
        "g", F.coalesce(F.sum("gn").over(before), F.lit(0)).alias("gplace"))
    inside = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "g").select(
        "part", (F.col("gplace") + F.col("inner")).alias("place"))


def pack(spark: SparkSession, docs: DataFrame, path: str, ranks: str | None = None, size: int = SEQUENCE,
         end_id: int = END_ID) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids`` (little-endian u32) of
    ``docs (doc_id, text)``.

    ``path``: a byte-level BPE tokenizer file that every executor can read; ``ranks``: see ``WordEncoder``."""
    tokens = stage(spark, tokenise(docs, path, ranks, end_id), "tokens")
    places = stage(spark, part_places(tokens), "token-places")
    placed = tokens.join(small(places, places.count(), 16), "part").select(
        "doc_id", "n", "ids", "width", (F.col("place") + F.col("start")).alias("at"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                out = [[] for _ in range(7)]
                src = []
                for r, (n, ids, width, at) in enumerate(zip(*(rows.column(c).to_pylist()
                                                              for c in ("n", "ids", "width", "at")))):
                    wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                    a = 0
                    while a < n:
                        seq, off = divmod(at + a, size)
                        b = min(n, a + size - off)
                        raw = wide[a:b].tobytes()
                        src.append(r)
                        for col, v in zip(out, (a, b - a, zlib.crc32(raw), n, seq, off, raw)):
                            col.append(v)
                        a = b
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(src, pa.int32())), *(pa.array(c, pa.int64()) for c in out[:6]),
                     pa.array(out[6], pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return map_arrow(placed, cut, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, "
                                   "doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
