"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within a radius share a variant: a value within half the radius of both. Every distinct fingerprint
emits all its variants, variants are shuffled, and fingerprints that meet in one are linked. A fingerprint of 64 bits
has 2081 variants within two bits, which are many times the text it stands for. So the shuffle goes by a prefix of the
variant, long enough that a bucket of variants fits into a task: a fingerprint is sent once to each bucket that its variants
fall into, together with the flips that are left, and the bucket's task makes the variants that lie in it. A bucket that
is still too large, as where many fingerprints are alike, is dealt again by more bits.

Fingerprints that meet in a variant are within the radius of each other, so each is linked with the smallest one
there, and not with all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.arrow_text import Block, blocks
from orderloom.llm.components import components
from orderloom.session import stage

BITS = 64
# Fixed values of the fingerprint: words a shingle, seed of the hash, and differing bits that still link
SHINGLE, SEED, RADIUS = 4, 42, 4
# variants that a task holds at once, and the bits by which a bucket that has more is dealt again
BUCKET_VARIANTS = 2_000_000
MORE_BITS = 6
SHINGLES_A_STEP = 1 << 16

FINGERPRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("bits", T.LongType())])
DEALT = "bits long, bucket long, flips int"
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _vote(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest bit first."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_A_STEP):
        step = hashes[at : at + SHINGLES_A_STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(step, axis=1).sum(axis=0, dtype=np.int64)
    return ones


def block_fingerprints(block: Block, size: int = SHINGLE) -> list[int]:
    """The fingerprint of each row, as a signed number: a bit is set where over half of the shingle hashes have it."""
    starts, ends, first = block.words()
    raw = block.data.tobytes()
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    found, digest = [], xxhash.xxh64_intdigest
    for row in range(block.rows):
        own = words[first[row] : first[row + 1]]
        if not own:
            found.append(0)
            continue
        joined = b" ".join(own)
        cuts = np.cumsum([0] + [len(w) + 1 for w in own])
        n = min(size, len(own))
        spans = zip(cuts[: len(own) - n + 1].tolist(), (cuts[n:] - 1).tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(own) - n + 1)
        bits = np.packbits(_vote(hashes) * 2 > len(hashes)).tobytes()
        found.append(int.from_bytes(bits, "big", signed=True))
    return found


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) of every row: the SimHash of its word shingles, repeats included, A-Z in lower case.

    A text of fewer words than a shingle is one shingle, one without words has no bit set. A null text counts as
    empty. ``bits`` is the fingerprint as a signed number.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits: list[int] = []
            for block in blocks(batch.column(1), lower=True):
                bits += block_fingerprints(block, size)
            yield pa.record_batch([batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, FINGERPRINTS)


def _ball(low: int, flips: int) -> np.ndarray:
    """The masks over the lowest ``low`` bits that flip at most ``flips`` of them."""
    one = [1 << k for k in range(low)]
    return np.array([sum(c) for k in range(flips + 1) for c in combinations(one, k)], dtype=np.uint64)


def ball_size(low: int, flips: int) -> int:
    return sum(math.comb(low, k) for k in range(flips + 1))


def _deal(rows: DataFrame, done: int, bits: int) -> DataFrame:
    """Rows (bits, bucket, flips) of buckets of ``done`` bits, once for each bucket of ``bits`` more bits that variants fall into."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = BITS - done - bits
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            buckets = batch.column(1).to_numpy().view(np.uint64)
            flips = batch.column(2).to_numpy()
            own = (prints >> np.uint64(low)) & np.uint64((1 << bits) - 1)
            for left in np.unique(flips).tolist():
                at = np.flatnonzero(flips == left)
                masks = _ball(bits, left)
                used = np.bitwise_count(masks).astype(np.int32)
                for some in np.array_split(at, -(-len(at) * len(masks) // SHINGLES_A_STEP)):
                    dealt = (buckets[some, None] << np.uint64(bits)) | (own[some, None] ^ masks[None, :])
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(prints[some], len(masks)).view(np.int64)),
                            pa.array(dealt.ravel().view(np.int64)),
                            pa.array(np.tile(left - used, len(some)).astype(np.int32)),
                        ],
                        names=["bits", "bucket", "flips"],
                    )

    return rows.mapInArrow(spread, DEALT)


def _meet(prints: np.ndarray, flips: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a fingerprint and the smallest one that meets it in a variant of one bucket, without repeats."""
    below = np.uint64((1 << low) - 1) if low < BITS else np.uint64(0xFFFFFFFFFFFFFFFF)
    variants, owners = [], []
    for left in np.unique(flips).tolist():
        at = np.flatnonzero(flips == left)
        masks = _ball(low, left)
        variants.append(((prints[at] & below)[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(prints[at], len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    fresh = np.concatenate(([True], variant[1:] != variant[:-1]))
    firsts = np.flatnonzero(fresh)
    least = np.repeat(np.minimum.reduceat(owner, firsts), np.diff(np.concatenate((firsts, [len(owner)]))))
    pairs = np.unique(np.stack([owner, least], axis=1)[owner != least], axis=0)
    return pairs[:, 0], pairs[:, 1]


def _links(rows: DataFrame, bits: int, radius: int) -> DataFrame:
    """(a, b) links of the fingerprints of whole buckets of ``bits`` bits."""
    low = BITS - bits

    def found(prints: np.ndarray, flips: np.ndarray) -> pa.RecordBatch:
        a, b = _meet(prints.view(np.uint64), flips, low)
        near = np.bitwise_count(a ^ b) <= radius
        return pa.record_batch([pa.array(a[near].view(np.int64)), pa.array(b[near].view(np.int64))], names=["a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of buckets that are not whole yet
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1).astype(np.int64)
            held.append(rows)
            whole = np.flatnonzero(rows[:, 1] != rows[-1, 1])
            before = len(held) > 1 and held[0][-1, 1] != rows[-1, 1]
            if len(whole) or before:
                together = np.concatenate(held)
                cut = int(np.flatnonzero(together[:, 1] != together[-1, 1])[-1]) + 1
                yield from by_bucket(together[:cut])
                held = [together[cut:]]
        if held:
            yield from by_bucket(np.concatenate(held))

    def by_bucket(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(rows[1:, 1] != rows[:-1, 1]) + 1
        for part in np.split(rows, cuts):
            if len(part) > 1:
                yield found(np.ascontiguousarray(part[:, 0]), part[:, 2])

    return rows.repartition("bucket").sortWithinPartitions("bucket").select("bits", "bucket", "flips").mapInArrow(meet, LINKS)


def ball_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``bits``): each meets the smallest one of its variants.

    All fingerprints that are within ``radius`` bits are linked directly or through others that are.
    """
    spark = prints.sparkSession
    flips = -(-radius // 2)
    rows = prints.select("bits", F.lit(0).cast("long").alias("bucket"), F.lit(flips).alias("flips"))
    # the first prefix is as long as the number of variants asks for; buckets above the bound get a longer one
    variants = prints.count() * ball_size(BITS, flips)
    done, step = 0, min(BITS, max(1, math.ceil(math.log2(max(variants, 1) / BUCKET_VARIANTS)) + 3 if variants > BUCKET_VARIANTS else 1))
    links = None
    while True:
        rows = stage(spark, _deal(rows, done, step), "ball-buckets")
        done += step
        low = BITS - done
        cost = sum(F.when(F.col("flips") == k, F.lit(ball_size(low, k))).otherwise(0) for k in range(flips + 1))
        large = rows.groupBy("bucket").agg(F.sum(cost).alias("variants")).where(F.col("variants") > BUCKET_VARIANTS).select("bucket")
        large = stage(spark, large, "ball-large")
        some_large = low > 0 and not large.isEmpty()
        small = rows.join(large, "bucket", "left_anti").select("bits", "bucket", "flips") if some_large else rows
        found = stage(spark, _links(small, done, radius).distinct(), "ball-links")
        links = found if links is None else links.unionByName(found)
        if not some_large:
            return links
        rows = rows.join(large, "bucket", "left_semi").select("bits", "bucket", "flips")
        step = min(MORE_BITS, low)


def simhash_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lowercase hex digits), component_id (smallest doc_id reachable).

    Documents link where their fingerprints differ in at most ``radius`` bits, also those without words, whose
    fingerprint is zero. Equal fingerprints are one before anything is compared. Repeated rows get a row each. A row
    without an identifier links others, and has a component without identifier only if no other row in it has one. An
    empty table gives an empty result. Columns other than doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    made = stage(spark, fingerprints(docs), "fingerprints")
    distinct = stage(spark, made.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    tied = stage(spark, components(ball_links(distinct, radius)), "ball-components")
    named = distinct.join(tied, distinct["bits"] == tied["node"], "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component")
    )
    named = stage(spark, named, "ball-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return (
        made.join(named.join(least, "component").select("bits", "component_id"), "bits")
        .select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
    )
