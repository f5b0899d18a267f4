"""Jaccard similarity self-join of word shingles, and the components of its links.

Documents with one set of shingles are one node. A pair of nodes can only link if the sizes lie in the same or
neighbouring bands, and if the two share one of their rarest shingles (a fifth of each set). Such pairs pass three tests:

1. position: what is left of both sets after the shared shingle must suffice;
2. bitmap: each node has a bitmap of about two bits per shingle. A bit that only one side has stands for a shingle the
   other lacks, which bounds the overlap from above;
3. the exact intersection of the sorted hash arrays.

Shingles are ordered by a count sketch of all documents, so that those of widespread passages come last. Any order gives
the same links, the sketch only keeps lists short. A large group of near copies is not compared pair by pair: first every
node is tried against one leader, and then only those pairs of a list are formed whose ends are not connected yet. No
link between components is lost by that. The leader of a list is the node that shares most with others: copies of
one text, each changed in its own way, may link to the original alone, and the original is in most of their lists.

Hashes have 64 bits: two different sets out of n share a node with odds of n^2 / 2^65.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.arrow_text import Block, blocks, mix, ranges, sequence_hash
from orderloom.llm.components import components
from orderloom.llm.rows import without
from orderloom.session import drop_stage, stage

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 22
SKETCH_PART = 1 << 16


def shingle_sets(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row in ascending order, and the place of each row's first one.

    A row with fewer than ``size`` words has its whole sequence as the only shingle; one without words has none.
    """
    starts, ends, firsts = block.words()
    hashes = block.span_hash(starts, ends)
    counts = np.diff(firsts)
    long_enough = np.maximum(counts - size + 1, 0)
    at = ranges(firsts[:-1], long_enough)
    found = [sequence_hash(hashes, size)[at]]
    rows = [np.repeat(np.arange(block.rows), long_enough)]
    for words in range(1, size):
        short = np.flatnonzero(counts == words)
        found.append(mix(sequence_hash(hashes, words)[firsts[short]] + np.uint64(words)) if len(short) else found[0][:0])
        rows.append(short)
    all_found, all_rows = np.concatenate(found), np.concatenate(rows).astype(np.int64)
    order = np.argsort(all_found)
    narrow = all_rows.astype(np.uint16) if block.rows < 1 << 16 else all_rows
    order = order[np.argsort(narrow[order], kind="stable")]
    all_found, all_rows = all_found[order], all_rows[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (all_found[1:] != all_found[:-1]) | (all_rows[1:] != all_rows[:-1])
    all_found, all_rows = all_found[new], all_rows[new]
    return all_found, np.searchsorted(all_rows, np.arange(block.rows + 1))


def _row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def set_digests(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's set."""
    one = _row_sums(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), firsts)
    two = _row_sums(mix(hashes + np.uint64(0x1234567)), firsts)
    return mix(one ^ mix(two + np.diff(firsts).astype(np.uint64)))


def rarity(docs: DataFrame) -> np.ndarray:
    """The levels (two per doubling) of a count sketch over the shingles of all documents, of a fixed size.

    Every task counts into ``2 ** SKETCH_BITS`` slots and hands over its parts compressed; the sums of the parts
    are formed in tasks, and the driver gets one byte per slot.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                hashes, _ = shingle_sets(block)
                np.add.at(slots, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
        parts = slots.reshape(-1, SKETCH_PART)
        filled = np.flatnonzero(parts.any(axis=1))
        packed = [zlib.compress(np.minimum(parts[k], 255).astype(np.uint8).tobytes(), 1) for k in filled]
        yield pa.record_batch([pa.array(filled, pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
                sums[part] = sums[part] + counts if part in sums else counts.astype(np.int64)
        levels = [np.round(2 * np.log2(1 + s)).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["part", "counts"])

    n_parts = (1 << SKETCH_BITS) // SKETCH_PART
    rows = docs.select("text").mapInArrow(count, "part int, counts binary").repartition(n_parts, "part")
    out = np.zeros((n_parts, SKETCH_PART), dtype=np.uint8)
    for row in rows.mapInArrow(add, "part int, counts binary").collect():  # a byte per slot of the sketch
        out[row["part"]] = np.frombuffer(row["counts"], dtype=np.uint8)
    return out.reshape(-1)


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for every hash, by its low bits, in the smallest power of two above two bits per hash."""
    width = 1 << max(6, int(2 * len(hashes) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(one: bytes, two: bytes, n_one: int, n_two: int) -> int:
    """At most so many hashes are in both sets: a bit that only one side has is a hash the other lacks."""
    if len(one) > len(two):
        one, two, n_one, n_two = two, one, n_two, n_one
    x = np.frombuffer(one, dtype=np.uint64)
    y = np.bitwise_or.reduce(np.frombuffer(two, dtype=np.uint64).reshape(-1, len(x)), axis=0)
    return int(min(n_one - np.bitwise_count(x & ~y).sum(), n_two - np.bitwise_count(y & ~x).sum()))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Rarest shingles of which a linked set must share one: all but those that may be missing, and one."""
    return n - -(-percent * n // 100) + 1


def least_overlap(n: int, percent: int) -> int:
    """Common shingles that two sets of ``n`` shingles together need."""
    return -(-percent * n // (100 + percent))


def signatures(docs: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """Per document: doc_id, node (digest of the set, null if empty), n, and bitmap and prefix (the rarest shingles, rarest first) once per
    node and task."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # one byte per slot of the sketch

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for batch in batches:
            for block in blocks(batch.column(1), lower=True):
                hashes, firsts = shingle_sets(block)
                digests = set_digests(hashes, firsts).view(np.int64)
                n = np.diff(firsts)
                rows = np.repeat(np.arange(block.rows), n)
                rank = level[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                # stable: rows, within them levels, within them hashes
                order = np.argsort(rows * 256 + rank, kind="stable")
                ordered = hashes[order].view(np.int64)
                lengths = prefix_length(n, percent)
                maps, prefixes = [], []
                for k, digest in enumerate(digests.tolist()):
                    if not n[k] or digest in seen:
                        maps.append(None)
                        prefixes.append(None)
                        continue
                    seen.add(digest)
                    maps.append(bitmap(hashes[firsts[k] : firsts[k + 1]]))
                    prefixes.append(ordered[firsts[k] : firsts[k] + lengths[k]])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(block.first_row, block.rows),
                        pa.array(digests, pa.int64(), mask=n == 0),
                        pa.array(n.astype(np.int64)),
                        pa.array(maps, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "node", "n", "bitmap", "prefix"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, node long, n long, bitmap binary, prefix array<long>"
    )


def shared_postings(signed: DataFrame) -> DataFrame:
    """(key, node, n, place, holders) of the prefix shingles that two nodes share; holders counts their nodes and copies."""
    # a shingle that very many nodes hold is counted inside tasks first, and Spark may split it in the join
    postings = signed.where("prefix IS NOT NULL").select("node", "n", F.posexplode("prefix").alias("place", "key"))
    lists = postings.groupBy("key").agg(F.min("node").alias("_first"), F.max("node").alias("_last"), F.count(F.lit(1)).alias("holders"))
    shared = postings.join(lists.where("_first < _last").select("key", "holders"), "key")
    held = stage(signed.sparkSession, shared, "postings-of-tasks")
    made = stage(signed.sparkSession, held.distinct(), "shared-postings")
    drop_stage(held)
    return made


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link: first by bitmaps, then by the sorted hash arrays of the whole texts.

    ``nodes`` has (node, doc_id, n, bitmap).
    """
    spark = pairs.sparkSession
    for side in "ab":
        marks = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"map_{side}"))
        pairs = pairs.join(marks, side)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("map_a", "map_b", "n_a", "n_b")))
            keep = [overlap_bound(x, y, m, n) >= least_overlap(m + n, percent) for x, y, m, n in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = F.ceil(F.lit(percent) * F.greatest("n_a", "n_b") / 100) <= F.least("n_a", "n_b")
    likely = stage(spark, pairs.where(needed).mapInArrow(bounded, "a long, b long"), "likely-pairs")
    ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    wanted = ends.join(nodes.select("node", "doc_id"), "node").select("doc_id").distinct()

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                hashes, firsts = shingle_sets(block)
                rows = [hashes[firsts[k] : firsts[k + 1]].tobytes() for k in range(block.rows)]
                digests = set_digests(hashes, firsts).view(np.int64)
                yield pa.record_batch([pa.array(digests), pa.array(rows, pa.binary())], names=["node", "hashes"])

    sets = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi").select("text")
    # one row per node, staged: a leader with very many pairs then meets it in a join that Spark can split
    sets = stage(spark, sets.mapInArrow(arrays, "node long, hashes binary").dropDuplicates(["node"]), "shingle-arrays")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("hashes_a").to_pylist(), batch.column("hashes_b").to_pylist()):
                x, y = np.frombuffer(one, dtype=np.uint64), np.frombuffer(two, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        likely = likely.join(sets.select(F.col("node").alias(side), F.col("hashes").alias(f"hashes_{side}")), side)
    links = stage(spark, likely.mapInArrow(exact, "a long, b long"), "links")
    drop_stage(sets)
    return links


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    A-Z count as a-z. Null and empty texts have no shingles and are linked with nothing. Equal sets are always
    linked. doc_id is the identity of a document. Repeated rows get a row each. Rows without an identifier take part
    in links, and have a null component where no other identifier is reached. Other columns are not looked at.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    signed = stage(spark, signatures(docs, rarity(docs), percent), "signatures")
    firsts = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    marks = signed.where("bitmap IS NOT NULL").select("node", "bitmap").dropDuplicates(["node"])
    nodes = stage(spark, firsts.join(marks, "node"), "nodes")
    postings = shared_postings(signed)
    # from here on documents need their node alone
    named_nodes = stage(spark, signed.select("doc_id", "node", "n"), "document-nodes")
    drop_stage(signed)

    weights = postings.groupBy("node").agg(F.sum("holders").alias("weight"))
    weighted = postings.select("key", "node").join(weights, "node")
    leaders = weighted.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("_top")).select("key", F.col("_top.node").alias("leader"))
    often = postings.join(leaders, "key").where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("lists"))
    best = often.groupBy("node").agg(F.max(F.struct("lists", "leader")).alias("best"))
    links = verified(best.select(F.col("node").alias("a"), F.col("best.leader").alias("b")), nodes, docs, percent)
    known = stage(spark, components(links), "known-components")

    labelled = postings.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    mixed = mixed.where("_least < _most").select("key")
    open_lists = stage(spark, labelled.join(mixed, "key").select("key", "node", "n", "place", "component", _band("n", percent).alias("band")), "open-lists")
    one = open_lists.select(*[F.col(c).alias(f"{c}_a") for c in open_lists.columns])
    two = open_lists.select(*[F.col(c).alias(f"{c}_b") for c in open_lists.columns])
    fitting = (
        (F.col("key_a") == F.col("key_b"))
        & (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (F.abs(F.col("band_a") - F.col("band_b")) <= 1)
        & (
            F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b")) * (100 + percent)
            >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))
        )
    )
    pairs = one.join(two, fitting).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    links = links.unionByName(verified(pairs, nodes, docs, percent))
    for done in (postings, open_lists):
        drop_stage(done)

    joined = components(links).withColumnRenamed("component", "_component")
    grouped = nodes.select("node", "doc_id").join(joined, "node", "left").withColumn("_component", F.coalesce("_component", "node"))
    smallest = grouped.groupBy("_component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(smallest, "_component").select("node", "component_id")
    return named_nodes.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _band(n: str, percent: int):
    """Size bands so wide that linked sets lie in the same or in neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(100 / percent * 1.0000001)))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all their columns."""
    return without(docs, near_duplicates(docs, percent).where("component_id < doc_id"))
