"""N-gram Jaccard self-join by universe-partition pigeonhole, exact, for groups of near copies.

A document is its set of distinct 5-word shingles (64-bit hashes; ASCII lower-cased words; a shorter text is one shingle). Two
documents link at Jaccard similarity >= 0.75, which is a symmetric difference of at most H = (|x| + |y|) / 7.

1. Documents with equal sets are one node. A document can only have a partner if enough of its shingles occur elsewhere: of its
   ``prefix`` (the smallest n/4 + n/8 hashes, rounded up) at least an eighth of 3n/4 must (the prefix theorem for overlaps), so
   others are left out without loss after one exact count of prefix shingles over all documents.
2. Sizes fall into bands of ratio 4/3, so partners are in the same or in adjacent bands. In band k the universe of shingles is cut by hash into m(k)
   segments with m(k) > H for every pair of the band. By the pigeonhole principle a linked pair agrees on enough segments:
   if document x spends H + 1 units on segments, one unit for asking a segment exactly and a second one for also asking its
   one-deletion neighbourhood, some asked segment must match.
3. Every document indexes the subsets of its own band's segments (and, in bands below ``DELETE_BELOW`` shingles, their one-deletion
   neighbourhoods, whose number of rows is only worth it there). Its requests are allocated by cost: the count of a segment's rarest shingle
   bounds its list, so the H + 1 cheapest units are taken, and those no other document can answer are not sent at all.
4. Lists go through ``links``: leader tests first, then all that is left apart. Every set has ``PARITIES`` bits, each telling whether an
   odd number of its shingles falls into a hash range; two sets differ in at least as many shingles as in bits, which refutes most pairs of
   groups that share segments without being linked, before any set is sent and, in the second step, inside the join of the lists, so that
   refuted pairs make no rows. What is left is verified exactly on the full sets.

Result: ``doc_id, n_shingles, component_id`` for every row; ``component_id`` is the smallest id of the group (by links), itself included.

Cases: no words or null text: an empty set, linked with nothing; a null id is linked with nothing and gets a null component; repeated rows
and equal texts are one node and all get their group's id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import drop, drop_folder, free_name, map_arrow, partitions_for, small, small_batches, stage
from pathlattice.llm.counting import by_chunk, by_shard, from_planes, key_sums, planes, put_together, rows_of, shard_bounds, shared_keys, sums_of
from pathlattice.llm.links import linked_groups
from pathlattice.session import scratch_path

U = np.uint64
WORDS = 5
CHUNK_KEYS = 1_000_000
PREFIX_PER_SHARD = 1_000_000
TEXT_ROWS = 1000  # texts in one Arrow batch
PAIR_ROWS = 500  # rows of two sets each in one Arrow batch
DELETE_BELOW = 48
PARITIES = 1024  # a multiple of 64
LONGS = [f"p{i}" for i in range(PARITIES // 64)]


def linked_sizes(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """n - ceil(3n/4) + ceil(n/8)."""
    return n - (3 * n + 3) // 4 + (n + 7) // 8


def prefix_need(n: np.ndarray) -> np.ndarray:
    """Shingles of the prefix that any partner shares: an eighth of the smallest partner's size, rounded up."""
    return np.maximum(1, ((3 * n + 3) // 4 + 7) // 8)


def band_starts(largest: int) -> np.ndarray:
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-4 * out[-1] // 3)))
    return np.array([*out, -(-4 * out[-1] // 3)], np.int64)


def text_sets(b: tv.Block) -> list[np.ndarray]:
    s, off = tv.shingles(b, WORDS)
    return [np.unique(s[i:j]) for i, j in zip(off[:-1], off[1:])]


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set (with its size)."""
    return tuple(int(x) for x in np.array([np.add.reduce(tv.mix(s)), np.bitwise_xor.reduce(tv.mix(s * U(5) + U(1)))],
                                          U).view(np.int64))


def scan(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document (``shard`` null; ``tag`` as given), and per chunk and shard the prefix shingles with the
    documents they are of."""
    bounds = shard_bounds(shards)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"row bigint, tag bigint, doc_id {id_type}, n bigint, s1 bigint, s2 bigint, shard int, first_row bigint, "
              "keys binary, owners binary")

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        keys, owners, held, first_row = [], [], 0, row

        def flush():
            k, o = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(k, kind="stable")
            k, o = k[order], o[order]
            used, cut = by_shard(k, bounds)
            # within a shard 32 bits tell keys apart well enough: a false equal only keeps a document for the exact steps
            k = (k * U(0x9E3779B97F4A7C15) >> U(32)).astype(np.uint32)
            null = pa.nulls(len(used), pa.int64())
            return pa.RecordBatch.from_arrays(
                [null, null, pa.nulls(len(used), id_kind), null, null, null, pa.array(used, pa.int32()),
                 pa.array([first_row] * len(used), pa.int64()),
                 pa.array([k[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                 pa.array([planes(o[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())],
                names=["row", "tag", "doc_id", "n", "s1", "s2", "shard", "first_row", "keys", "owners"])

        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for b in tv.blocks(batch.column("text"), lower=True):
                sets = text_sets(b)
                n = np.array([len(s) for s in sets], np.int64)
                sig = np.array([signature(s) if len(s) else (0, 0) for s in sets], np.int64).reshape(-1, 2)
                take = prefix_length(n)
                keys += [s[:p] for s, p in zip(sets, take)]
                owners.append(np.repeat(np.arange(len(sets)) + (row - first_row), take).astype(np.uint32))
                held += int(take.sum())
                blank = pa.nulls(len(sets), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(sets))), batch.column("tag").slice(b.lo, len(b)), batch.column("doc_id").slice(b.lo, len(b)), pa.array(n),
                     pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy()), pa.nulls(len(sets), pa.int32()),
                     pa.nulls(len(sets), pa.int64()), blank, blank],
                    names=["row", "tag", "doc_id", "n", "s1", "s2", "shard", "first_row", "keys", "owners"])
                row += len(sets)
                if held >= CHUNK_KEYS:
                    yield flush()
                    keys, owners, held, first_row = [], [], 0, row
        if held:
            yield flush()

    return map_arrow(docs.select("doc_id", "text", "tag"), run, schema)


def possible(spark: SparkSession, scanned: DataFrame, shards: int) -> DataFrame:
    """``row, shared``: rows with shingles of their prefix that other documents have in theirs."""
    sent = scanned.filter("kind = 'prefixes'").select("shard", "first_row", "keys", "owners").repartition(shards, "shard")

    def count(table: pa.Table) -> pa.Table:
        parts = table.column("keys").to_pylist()
        sums, _ = sums_of(np.frombuffer(b"".join(parts), np.uint32), np.ones(sum(map(len, parts)) // 4, np.int64))
        first, owners, shared, a = [], [], [], 0
        for chunk, own in zip(table.column("first_row").to_pylist(), table.column("owners").to_pylist()):
            o = from_planes(own, np.uint32)
            n = np.bincount(o[sums[a:a + len(o)] > 1])
            a += len(o)
            full = np.flatnonzero(n)
            first.append(chunk)
            owners.append(full.astype(np.uint32).tobytes())
            shared.append(n[full].astype(np.uint32).tobytes())
        return pa.table({"first_row": pa.array(first, pa.int64()), "owners": pa.array(owners, pa.binary()),
                         "shared": pa.array(shared, pa.binary())})

    counted = sent.groupBy("shard").applyInArrow(count, "first_row bigint, owners binary, shared binary")

    def add(table: pa.Table) -> pa.Table:
        o = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("owners").to_pylist()])
        c = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("shared").to_pylist()])
        n = np.bincount(o, weights=c).astype(np.int64)
        full = np.flatnonzero(n)
        return pa.table({"row": pa.array(full + table.column("first_row")[0].as_py()), "shared": pa.array(n[full])})

    return counted.groupBy("first_row").applyInArrow(add, "row bigint, shared bigint")


def chunked_sets(spark: SparkSession, docs: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """``chunk, nodes, sizes, shingles``: the sets of ``nodes (node, doc_id, s1, s2)``, packed by chunk."""
    side = nodes.select("node", F.col("doc_id").alias("_id"), "s1", "s2")
    joined = docs.select("doc_id", "text").join(small(side, n_nodes, 64), F.col("doc_id") == F.col("_id"))
    # an id on many rows makes its node once, not once a row
    rows_of_id = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeated = stage(spark, rows_of_id, "repeated-ids")
    n_repeated = repeated.count()
    if n_repeated:
        repeated = small(repeated, n_repeated, 16)
        joined = joined.join(repeated, "doc_id", "left_anti").unionByName(
            joined.join(repeated, "doc_id", "left_semi").withColumn("_h", F.xxhash64("text"))
            .dropDuplicates(["node", "_h"]).drop("_h"))

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, sets, held = [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 33) + seq], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array([len(s) for s in sets], np.int64).tobytes()], pa.binary()),
                 pa.array([np.concatenate(sets).tobytes()], pa.binary())],
                names=["chunk", "nodes", "sizes", "shingles"])

        for batch in batches:
            node, s1, s2 = (batch.column(c).to_pylist() for c in ("node", "s1", "s2"))
            for b in tv.blocks(batch.column("text"), lower=True):
                for i, s in enumerate(text_sets(b), b.lo):
                    if len(s) and signature(s) == (s1[i], s2[i]):  # else another row with the same id
                        ids.append(node[i])
                        sets.append(s)
                        held += len(s)
                if held >= CHUNK_KEYS // 2:
                    yield flush()
                    ids, sets, held, seq = [], [], 0, seq + 1
        if held:
            yield flush()

    return map_arrow(joined.select("text", "node", "s1", "s2"), run,
                     "chunk bigint, nodes binary, sizes binary, shingles binary")


def segments(s: np.ndarray, df: np.ndarray, m: int, salt: int):
    """Segments of a set: number, sum of the shingles' mixed hashes, and of its shingles their order by (segment, df).

    Empty segments are part of the result; ``first`` is where a segment's shingles begin in that order."""
    seg = (s % U(m)).astype(np.int64)
    order = np.lexsort((df, seg))
    count = np.bincount(seg, minlength=m)
    off = np.concatenate([[0], np.cumsum(count)])
    mixed = tv.mix(s ^ U(0x5851F42D4C957F2D))
    total = tv.sums_by(mixed[order], off)
    base = tv.mix(np.arange(m, dtype=U) + U(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
    return order, off, count, total, base, mixed


def exact_key(total, base):
    return tv.mix(total ^ base)


def deleted_key(total, base):
    return tv.mix(total ^ base ^ U(0xABCDEF0123456789))


def postings_of(s: np.ndarray, df: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys a set indexes exactly, keys of its one-deletion neighbourhoods, and keys it asks for."""
    n = len(s)
    own = int(np.searchsorted(starts, n, "right")) - 1
    index, gone, ask = [], [], []
    for k in range(max(0, own - 1), own + 2):
        lo, hi = int(starts[k]), int(starts[k + 1]) - 1
        m = hi // 3 + 1
        order, off, count, total, base, mixed = segments(s, df, m, k)
        rank = df[order]
        none = np.int64(1) << 40
        rarest = np.full(m, none)
        second = np.full(m, none)
        rarest[count > 0] = rank[off[:-1][count > 0]]
        second[count > 1] = rank[off[:-1][count > 1] + 1]
        exact = exact_key(total, base)
        deletes = hi < DELETE_BELOW
        seg_of = np.repeat(np.arange(m), count)
        if deletes:
            less = total[seg_of] - mixed[order]
            is_first = np.zeros(n, bool)
            is_first[off[:-1][count > 0]] = True
            rest = np.where(is_first, second[seg_of], rarest[seg_of])  # rarest shingle of what a deletion leaves
        if k == own:
            index.append(exact[rarest > 1])
            if deletes:
                gone.append(deleted_key(less, base[seg_of])[rest > 1])
        most = min(hi, 4 * n // 3)
        if most < max(lo, -(-3 * n // 4)):
            continue  # no partner's size falls into this band
        units = (n + most) // 7 + 1
        cost = np.minimum(rarest, none) - 1
        stage_of, seg_unit, unit_cost = np.zeros(m, np.int64), np.arange(m), cost
        if deletes:
            more = np.bincount(seg_of, weights=np.maximum(rest - 1, 0).astype(np.float64), minlength=m).astype(np.int64)
            more = np.maximum(more + cost, cost)
            stage_of, seg_unit = np.r_[stage_of, np.ones(m, np.int64)], np.r_[seg_unit, np.arange(m)]
            unit_cost = np.r_[cost, more]
        chosen = np.lexsort((seg_unit, stage_of, unit_cost))[:units]
        exactly = seg_unit[chosen[stage_of[chosen] == 0]]
        ask.append(exact[exactly[rarest[exactly] > 1]])
        if deletes:
            wider = seg_unit[chosen[stage_of[chosen] == 1]]
            ask.append(deleted_key(total, base)[wider[rarest[wider] > 1]])
            inside = np.isin(seg_of, wider) & (rest > 1)
            ask.append(exact_key(less, base[seg_of])[inside])
    pack = lambda parts: np.concatenate(parts) if parts else np.zeros(0, U)
    return pack(index), pack(gone), pack(ask)


def unpack(chunk) -> list[tuple[int, np.ndarray]]:
    ids, sizes = np.frombuffer(chunk["nodes"], np.int64), np.frombuffer(chunk["sizes"], np.int64)
    flat = np.frombuffer(chunk["shingles"], U)
    off = np.concatenate([[0], np.cumsum(sizes)])
    return [(int(i), flat[a:b]) for i, a, b in zip(ids, off[:-1], off[1:])]


def postings(spark: SparkSession, chunks: DataFrame, n_keys: int, largest: int) -> DataFrame:
    """``kind, key, node`` of keys that several nodes hold: 0 the exact index, 1 the one-deletion index, 2 requests."""
    starts = band_starts(largest)

    def distinct(row):
        keys, weights = np.unique(np.frombuffer(row["shingles"], U), return_counts=True)
        return keys, weights.astype(np.uint32)

    sums, _ = key_sums(spark, chunks.select("chunk", "shingles"), distinct, n_keys, "shingle-sums")

    def run(batches):
        for chunk in rows_of(batches, ["nodes", "sizes", "shingles", "sums"]):
            keys, df = np.unique(np.frombuffer(chunk["shingles"], U)), put_together(chunk["sums"])
            kinds, out, nodes = [], [], []
            for node, s in unpack(chunk):
                for kind, k in enumerate(postings_of(s, df[np.searchsorted(keys, s)], starts)):
                    kinds.append(np.full(len(k), kind, np.int8))
                    out.append(k)
                    nodes.append(np.full(len(k), node, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(x).tobytes()], pa.binary())
                                              for x in (kinds, out, nodes)], names=["kinds", "keys", "nodes"])

    joined = chunks.join(by_chunk(sums), "chunk").select("nodes", "sizes", "shingles", "sums")
    return shared_keys(spark, map_arrow(joined, run, "kinds binary, keys binary, nodes binary"), n_keys)


def node_sets(chunks: DataFrame) -> DataFrame:
    def run(batches):
        for chunk in rows_of(batches, ["nodes", "sizes", "shingles"]):
            rows = unpack(chunk)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()),
                                              pa.array([s.tobytes() for _, s in rows], pa.binary())],
                                             names=["node", "shingles"])

    return map_arrow(chunks.select("nodes", "sizes", "shingles"), run, "node bigint, shingles binary")


def parities(s: np.ndarray) -> np.ndarray:
    """For each of ``PARITIES`` hash ranges whether the set has an odd number of shingles there, as 64-bit numbers."""
    odd = np.bincount((s % U(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def node_parities(chunks: DataFrame) -> DataFrame:
    """``node, n, p0, p1, ...``: size and parities of each node's set."""
    def run(batches):
        for chunk in rows_of(batches, ["nodes", "sizes", "shingles"]):
            rows = unpack(chunk)
            bits = np.array([parities(s) for _, s in rows], np.int64).reshape(-1, len(LONGS))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()),
                 *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(len(LONGS)))], names=["node", "n", *LONGS])

    return map_arrow(chunks.select("nodes", "sizes", "shingles"), run, ", ".join(f"{c} bigint" for c in ("node", "n", *LONGS)))


def may_link(a, b):
    """Whether sets of these two columns (structs of ``n, p0, p1, ...``) can be linked; no linked pair is refuted."""
    differ = sum((F.bit_count(a[c].bitwiseXOR(b[c])) for c in LONGS), F.lit(0))
    return 7 * differ <= a["n"] + b["n"]


def not_refuted(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """Of ``(a, b)`` those that ``may_link``."""
    for side in ("a", "b"):
        pairs = pairs.join(told.select(F.col("node").alias(side), F.col("told").alias(f"told_{side}")), side)
    return pairs.filter(may_link(F.col("told_a"), F.col("told_b"))).select("a", "b")


def groups(spark: SparkSession, docs: DataFrame, tag: str | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs (doc_id, text)``, and ``tag``, the given bigint column."""
    with small_batches(spark, TEXT_ROWS):  # every step with Python tasks is written inside
        return linked_documents(spark, docs, tag)


def linked_documents(spark: SparkSession, docs: DataFrame, tag: str | None) -> DataFrame:
    docs = docs.select("doc_id", "text", (F.col(tag) if tag else F.lit(None)).cast("bigint").alias("tag"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = partitions_for(spark, size // 12, PREFIX_PER_SHARD)  # prefixes are 3/8 of the words
    # two folders: the prefixes are dropped when the nodes are known
    path = scratch_path(spark, "shingle-scan")
    both = scan(docs, shards).withColumn("kind", F.when(F.col("shard").isNull(), "rows").otherwise("prefixes"))
    both.write.partitionBy("kind").parquet(path)
    scanned = spark.read.schema(both.schema).parquet(path)
    rows = scanned.filter("kind = 'rows'").select("row", "tag", "doc_id", "n", "s1", "s2")
    able = rows.filter("doc_id IS NOT NULL AND n > 0")
    classes = stage(spark, able.groupBy("n", "s1", "s2").agg(F.min(F.struct("row", "doc_id")).alias("of"),
                                                             F.min("doc_id").alias("least")), "shingle-classes")
    shared = possible(spark, scanned, shards)
    n = F.col("n")
    need = F.greatest(F.lit(1), F.floor((F.floor((3 * n + 3) / 4) + 7) / 8))
    nodes = classes.join(shared, F.col("of.row") == F.col("row")).filter(F.col("shared") >= need).select(
        F.col("row").alias("node"), "of.doc_id", "n", "s1", "s2")
    nodes = stage(spark, nodes, "shingle-nodes")
    drop_folder(spark, f"{path}/kind=prefixes")
    columns = rows.columns
    rows = spark.read.schema(both.schema).parquet(path).filter("kind = 'rows'").select(*columns)  # listed anew
    stats = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("keys"), F.max("n").alias("largest")).first()
    chunks = stage(spark, chunked_sets(spark, docs, nodes, stats["nodes"]), "shingle-sets")
    posts = postings(spark, chunks, stats["keys"] or 0, stats["largest"] or 1)
    posts = stage(spark, posts.join(small(nodes.select("node", F.col("n").alias("mark")), stats["nodes"], 32), "node"),
                  "shingle-postings")
    parity_rows = stage(spark, node_parities(chunks), "shingle-parities")
    told = small(parity_rows.select("node", F.struct("n", *LONGS).alias("told")), stats["nodes"], 16 + PARITIES // 8)

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stage(spark, not_refuted(pairs, told), "shingle-near")
        sets = node_sets(chunks)
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")

        def run(batches):
            for batch in batches:
                ok = []
                for x, y in zip(batch.column("x"), batch.column("y")):
                    a, b = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                    both = np.sort(np.concatenate([a, b]), kind="stable")  # two sorted runs: merged
                    ok.append(linked_sizes(int((both[1:] == both[:-1]).sum()), len(a), len(b)))
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return map_arrow(both.select("a", "b", "x", "y"), run, "a bigint, b bigint")

    with small_batches(spark, PAIR_ROWS):
        found = linked_groups(spark, *(posts.filter(f"kind = {k}").select("key", "node", "mark") for k in (0, 2)),
                              verify, "shingle", posts.filter("kind = 1").select("key", "node", "mark"),
                              lambda x, y: 100 * F.least(x, y) >= 75 * F.greatest(x, y), posts, told, may_link)
    drop(chunks, parity_rows)
    named = classes.join(found, F.col("of.row") == found.node, "left").withColumn(
        "component", F.coalesce("component", "of.row"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "component").select("n", "s1", "s2", "component_id")
    ids = ids.select(*(F.col(c).alias(f"_{c}") for c in ("n", "s1", "s2")), "component_id")
    return rows.join(ids, (rows.n == ids._n) & (rows.s1 == ids._s1) & (rows.s2 == ids._s2), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "tag")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row of each group: the first of those with the smallest id. Rows without words or id stay."""
    tag = free_name(docs, "_tag")
    tagged = stage(spark, docs.withColumn(tag, F.monotonically_increasing_id()), "join-input")
    found = stage(spark, groups(spark, tagged, tag).filter("doc_id IS NOT NULL AND n_shingles > 0"), "join-groups")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "tag")).alias("keep"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").select("component_id", "keep")
    gone = found.join(first, "component_id").filter("tag <> keep.tag").select(F.col("tag").alias(tag))
    gone = stage(spark, gone, "join-drops")
    return tagged.join(small(gone, gone.count(), 32), tag, "left_anti").select(*docs.columns)
