"""Exact sums over a huge key space, looked up again where the keys came from.

Many small chunks each hold distinct 64-bit keys with weights (n-grams with their counts, shingles with their
documents). Sent as one row per key, keys would cost a row's overhead twice; here a chunk sends one packed row to each shard
of the key space, the shard adds up its keys, and sends each chunk its sums back in the order the chunk sent them. Keys are
hashes, so shards are even, and a key takes one entry per chunk however often it occurs.

Shards and chunks bound a task's memory (about 60 bytes for each of ``KEYS_PER_SHARD`` entries); both numbers of rows grow with the input.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm.common import map_arrow, partitions_for, stage

U = np.uint64
KEYS_PER_SHARD = 1_500_000


def shard_bounds(n: int) -> np.ndarray:
    """First key of each of ``n`` even shards of the 64-bit space."""
    return np.array([(i << 64) // n for i in range(n)], dtype=U)


def by_shard(keys: np.ndarray, bounds: np.ndarray) -> tuple[list[int], list[int]]:
    """The shards of sorted keys and where each one's keys begin, then their end. The work follows the keys, not the shards."""
    of = np.searchsorted(bounds, keys, "right") - 1
    start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return of[start].tolist(), [*start.tolist(), len(keys)]


def narrow(keys: np.ndarray, low: int, width: int) -> bytes:
    """Keys of one shard in 6 bytes: their top 47 bits inside the shard and their lowest bit. Two keys of a shard fall
    together with probability 2^-47, whatever the size of the corpus, as shards do not grow."""
    shift = U(max(0, (width - 1).bit_length() - 48))
    inside = ((keys - U(low)) >> shift) & ~U(1) | keys & U(1)
    return np.ascontiguousarray(inside.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def widen(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(U).ravel()


def planes(a: np.ndarray) -> bytes:
    """Numbers by byte plane, so that their leading zero bytes compress to nothing."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack_sums(a: np.ndarray) -> bytes:
    kind = np.uint32 if not len(a) or a.max() < 1 << 32 else np.int64
    return bytes([np.dtype(kind).itemsize]) + planes(a.astype(kind))


def unpack_sums(raw: bytes) -> np.ndarray:
    return from_planes(raw[1:], np.uint32 if raw[0] == 4 else np.int64).astype(np.int64)


def rows_of(batches, columns: list[str]):
    """One row at a time of batches whose rows are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in columns}


def sums_of(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the sum of the weights of its key; and whether it is the key's first entry."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(weights[order], first) if len(keys) else weights
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
    lead = np.zeros(len(keys), bool)
    lead[order[first]] = True
    return out, lead


def key_sums(spark: SparkSession, chunks: DataFrame, make: Callable[[dict], tuple[np.ndarray, np.ndarray]], n_keys: int,
             name: str) -> tuple[DataFrame, DataFrame]:
    """``make`` gives the sorted distinct u64 keys of a row of ``chunks (chunk bigint, …)`` and their u32 weights.

    Returns ``chunk, shard, sums`` (packed sums, in the order of the chunk's keys in that shard; see ``by_chunk`` and
    ``put_together``), and one row per shard: for the odd keys only, the number of those whose sum is not 0, and the total of their sums."""
    n = partitions_for(spark, n_keys, KEYS_PER_SHARD)
    bounds = shard_bounds(n)

    def send(batches):
        for row in rows_of(batches, columns):
            k, w = make(row)
            used, cut = by_shard(k, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([row["chunk"]] * len(used), pa.int64()),
                 pa.array([narrow(k[a:b], i * (1 << 64) // n, -(-(1 << 64) // n)) for i, a, b in zip(used, cut, cut[1:])],
                          pa.binary()),
                 pa.array([planes(w[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())],
                names=["shard", "chunk", "keys", "weights"])

    columns = chunks.columns
    sent = map_arrow(chunks, send,
                     "shard int, chunk bigint, keys binary, weights binary").repartition(n, "shard")

    def add(table: pa.Table) -> pa.Table:
        parts = table.column("keys").to_pylist()
        keys = widen(b"".join(parts))
        weights = np.concatenate([from_planes(w, np.uint32) for w in table.column("weights").to_pylist()])
        sums, lead = sums_of(keys, weights.astype(np.int64))
        cut = np.cumsum([0, *(len(p) // 6 for p in parts)])
        shard = table.column("shard")
        live = lead & (sums > 0) & (keys & U(1) == 1)
        return pa.table({
            "chunk": pa.concat_arrays([table.column("chunk").combine_chunks(), pa.array([None], pa.int64())]),
            "shard": pa.concat_arrays([shard.combine_chunks(), pa.array([shard[0].as_py()], pa.int32())]),
            "sums": pa.array([*(pack_sums(sums[a:b]) for a, b in zip(cut[:-1], cut[1:])), b""], pa.binary()),
            "n_keys": pa.array([None] * len(parts) + [int(live.sum())], pa.int64()),
            "total": pa.array([None] * len(parts) + [int(sums[live].sum())], pa.int64())})

    done = stage(spark, sent.groupBy("shard").applyInArrow(
        add, "chunk bigint, shard int, sums binary, n_keys bigint, total bigint"), name)
    return done.filter("chunk IS NOT NULL"), done.filter("chunk IS NULL").select("shard", "n_keys", "total")


def by_chunk(parts: DataFrame) -> DataFrame:
    """``chunk, sums``: the parts of each chunk, together one sum per key."""
    return parts.groupBy("chunk").agg(F.collect_list(F.struct("shard", "sums")).alias("sums"))


def put_together(parts: list[dict]) -> np.ndarray:
    """The sums of a chunk in the order of its keys."""
    return np.concatenate([unpack_sums(p["sums"]) for p in sorted(parts, key=lambda p: p["shard"])])


def shared_keys(spark: SparkSession, postings: DataFrame, n_keys: int) -> DataFrame:
    """Postings of keys that several nodes can meet under: ``kind, key, node``.

    ``postings (kinds, keys, nodes)``: packed i8 kinds (0 and 1 stand in a key's list, 2 asks for it), u64 keys and i64 nodes. A key's
    postings come back if at least two nodes hold it and one of them stands in its list. One packed exchange; most keys of a text
    corpus are held once and end here."""
    n = partitions_for(spark, n_keys, KEYS_PER_SHARD)
    bounds = shard_bounds(n)

    def send(batches):
        for batch in batches:
            kinds, keys, nodes = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t)
                                  for c, t in (("kinds", np.int8), ("keys", U), ("nodes", np.int64)))
            order = np.argsort(keys)
            kinds, keys, nodes = kinds[order], keys[order], nodes[order]
            used, cut = by_shard(keys, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())
                                               for x in (kinds, keys, nodes))], names=["shard", "kinds", "keys", "nodes"])

    sent = map_arrow(postings.select("kinds", "keys", "nodes"), send,
                     "shard int, kinds binary, keys binary, nodes binary").repartition(n, "shard")

    def meet(table: pa.Table) -> pa.Table:
        kinds, keys, nodes = (np.frombuffer(b"".join(table.column(c).to_pylist()), t)
                              for c, t in (("kinds", np.int8), ("keys", U), ("nodes", np.int64)))
        held, _ = sums_of(keys, np.ones(len(keys), np.int64))
        several = np.flatnonzero(held > 1)
        kinds, keys, nodes = kinds[several], keys[several], nodes[several]
        order = np.lexsort((nodes, keys))
        kinds, keys, nodes = kinds[order], keys[order], nodes[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(keys)))
        last = first + count - 1
        ok = (nodes[first] != nodes[last]) & (np.minimum.reduceat(kinds, first) < 2) if len(keys) else np.zeros(0, bool)
        take = np.repeat(ok, count)
        return pa.table({"kind": pa.array(kinds[take]), "key": pa.array(keys[take].view(np.int64)),
                         "node": pa.array(nodes[take])})

    return sent.groupBy("shard").applyInArrow(meet, "kind byte, key bigint, node bigint")
