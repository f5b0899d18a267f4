"""What the two substring operators share: finding the stretches of text that can repeat, and cutting repeats out.

A window is ``window`` consecutive units (bytes or words) of one document. Windows are never listed one by one. Each
window has an anchor, the smallest hash among the grams inside it, and consecutive windows with the same anchor
gram form a *run*. Equal windows have equal anchors, so that

1. runs are dealt by anchor, and an anchor that occurs once settles its run: nothing in it repeats. A run that comes
   again right after itself, as in a line of one word, is one row;
2. runs alike in all their units are one *segment* with its first place and its number of copies, however many
   documents hold it;
3. the texts of the remaining segments are dealt by anchor, and a finder decides in each shard which windows occur
   where first. It is the suffix array or the automaton of the operator;
4. every occurrence of a segment is held against the first places of its windows, and what came earlier elsewhere
   is cut out of the documents.

An anchor with more than ``HOT_SEGMENTS`` different segments (a widespread passage, at whose edges every document goes on
in its own way) is not gathered. Its segments are cut into parts by where the anchor stands in the window, in the first
or the second half of the places it can stand at, and a part is dealt by a longer gram: the units that all windows with
such a place share. What is still crowded is halved again, up to parts of one window, whose gram is the window itself, so
that one part is left of each. Parts meet the finder as segments do.

Anchors and segments are told apart by two 64-bit hashes, of the gram and of the whole run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.arrow_text import _BASE, _BYTE_CODES, _GOLDEN, BLOCK_BYTES, Block, blocks, mix, ranges
from orderloom.session import stage

HOT_SEGMENTS = 20_000
CHUNK_BYTES = 1 << 20
# Where runs lie, in one number: start, how often the run comes again at once, and its number of windows
START, TIMES = 1 << 32, 1 << 12
MOST_TIMES = START // TIMES - 1
NO_ID = -(1 << 63)

# (segment texts as lists of units, first documents, first starts, copies) -> (segment, from, to, document, start)
Finder = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, ...]]


@dataclass(frozen=True)
class Units:
    """What counts as a unit, how many make a window, and how many a gram."""

    words: bool
    window: int
    gram: int

    @property
    def halvings(self) -> int:
        """How often the places of an anchor in a window are halved until single ones are left."""
        return (self.window - self.gram).bit_length()

    def places(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every unit, and the first unit of every row."""
        if self.words:
            return block.words()
        every = np.arange(len(block.data))
        return every, every + 1, block.offsets

    def bodies(self, block: Block, starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        """The units [begin, end), words joined by one space."""
        pairs = zip(begin.tolist(), end.tolist())
        if self.words:
            return pa.array([b" ".join([block.data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])]) for a, b in pairs], pa.binary())
        data = block.data.tobytes()
        return pa.array([data[a:b] for a, b in pairs], pa.binary())

    def codes(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return block.span_hash(starts, ends) if self.words else _BYTE_CODES[block.data]


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for at least ``n`` positions."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            tables = []
            for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


class Spans:
    """Hashes of spans of units, equal for equal units wherever they stand.

    They are polynomials modulo 2^64, under which a pattern of two units and its swapped copy are equal from 1024 units
    on. The spans hashed here are runs of windows round one anchor, which have less than two windows' units.
    """

    def __init__(self, codes: np.ndarray):
        powers, self.inverse = _power_tables(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * powers[: len(codes)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(spans: Spans, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the gram at every unit, and for the window at every unit where its anchor stands."""
    every = np.arange(len(spans.sums) - units.gram)
    grams = spans.hash(every, every + units.gram)
    # the leftmost smallest gram: a hash's upper half, then the place
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | every.astype(np.uint64)
    least = _sliding_least(keyed, units.window - units.gram + 1)
    return grams, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(block: Block, units: Units) -> tuple[np.ndarray, ...]:
    """(row, start in the row, number of windows, anchor, digest, times) of every run of a block; a run that repeats at
    once is there once, with the times."""
    starts, ends, firsts = units.places(block)
    windows = np.maximum(np.diff(firsts) - units.window + 1, 0)
    at = ranges(firsts[:-1], windows)
    if not len(at):
        return (np.zeros(0, np.int64),) * 6
    spans = Spans(units.codes(block, starts, ends))
    grams, anchor_at = _anchors(spans, units)
    anchor_at = anchor_at[at]
    row = np.repeat(np.arange(block.rows), windows)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    number = np.diff(np.append(head, len(at)))
    begin = at[head]
    digest = spans.hash(begin, begin + number - 1 + units.window)
    row, anchor = row[head], grams[anchor_at[head]]
    new = np.ones(len(head), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1]) | (number[1:] != number[:-1])
    place = np.arange(len(head))
    first = np.maximum.accumulate(np.where(new, place, 0))
    head = np.flatnonzero((place - first) % MOST_TIMES == 0)
    times = np.diff(np.append(head, len(place)))
    return row[head], begin[head] - firsts[row[head]], number[head], anchor[head], digest[head], times


def _texts(docs: DataFrame) -> DataFrame:
    """(_id, doc_id, text); rows without an identifier are one document before all others."""
    identifier = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(identifier, F.lit(NO_ID)).alias("_id"), identifier.alias("doc_id"), "text")


def _runs(texts: DataFrame, units: Units) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                row, start, number, anchor, digest, times = runs_of(block, units)
                place = start * START + times * TIMES + number
                columns = [anchor.view(np.int64), digest.view(np.int64), ids[row + block.first_row], place]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["anchor", "digest", "id", "place"])

    return texts.select("_id", "text").mapInArrow(find, "anchor long, digest long, id long, place long")


def _segment_texts(texts: DataFrame, places: DataFrame, units: Units) -> DataFrame:
    """The texts of segments at their first places."""
    listed = places.groupBy(F.col("id").alias("_id")).agg(
        F.collect_list(F.struct("anchor", "digest", "place", "copies")).alias("places")  # as long as the document at most
    )
    schema = "anchor long, digest long, id long, start long, copies long, body binary"
    names = ["anchor", "digest", "id", "start", "copies", "body"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("_id").to_numpy(), batch.column("places")
            list_ends = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int64)
            flat = {n: lists.values.field(n).to_numpy(zero_copy_only=False) for n in ("anchor", "digest", "place", "copies")}
            for block in blocks(batch.column("text")):
                starts, ends, firsts = units.places(block)
                mine = np.arange(list_ends[block.first_row], list_ends[block.first_row + block.rows])
                row = np.searchsorted(list_ends, mine, side="right") - 1 - block.first_row
                start, number = flat["place"][mine] // START, flat["place"][mine] % TIMES
                begin = firsts[row] + start
                # rows that repeat an identifier may hold another text
                fits = begin + number - 1 + units.window <= firsts[row + 1]
                mine, row, start, number, begin = mine[fits], row[fits], start[fits], number[fits], begin[fits]
                spans = Spans(units.codes(block, starts, ends))
                same = spans.hash(begin, begin + number - 1 + units.window).view(np.int64) == flat["digest"][mine]
                mine, row, start, number, begin = mine[same], row[same], start[same], number[same], begin[same]
                bodies = units.bodies(block, starts, ends, begin, begin + number - 1 + units.window)
                numbers = [flat["anchor"][mine], flat["digest"][mine], ids[row + block.first_row], start, flat["copies"][mine]]
                columns = [pa.array(c, pa.int64()) for c in numbers] + [bodies]
                yield pa.record_batch(columns, names=names)

    return texts.join(listed, "_id").select("_id", "text", "places").mapInArrow(cut, schema)


def _crowded_texts(texts: DataFrame, places: DataFrame, crowded: np.ndarray, units: Units) -> DataFrame:
    """The texts of crowded segments at their first places. Their runs are found again in the documents, which stay where they are:
    only what is crowded is shuffled."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                row, start, number, anchor, digest, times = runs_of(block, units)
                mine = np.flatnonzero(np.isin(anchor.view(np.int64), crowded))
                row, start, number, anchor, digest, times = (c[mine] for c in (row, start, number, anchor, digest, times))
                starts, ends, firsts = units.places(block)
                begin = firsts[row] + start
                bodies = units.bodies(block, starts, ends, begin, begin + number - 1 + units.window)
                place = start * START + times * TIMES + number
                columns = [anchor.view(np.int64), digest.view(np.int64), ids[row + block.first_row], place, start]
                names = ["anchor", "digest", "id", "place", "start", "body"]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns] + [bodies], names=names)

    found = texts.mapInArrow(find, "anchor long, digest long, id long, place long, start long, body binary")
    return found.join(places, ["anchor", "digest", "id", "place"]).select("anchor", "digest", "id", "start", "copies", "body")


PARTS = ["anchor", "segment", "nth", "key", "part", "id", "start", "copies"]


def _halves(rows: DataFrame, units: Units, halving: int) -> DataFrame:
    """Texts of a segment's windows from the ``nth`` on, cut where the anchor changes its half; each part has a key that equal
    windows share."""
    shift, last_place = units.halvings - halving, units.window - units.gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = {n: batch.column(n).to_numpy() for n in ("anchor", "segment", "nth", "id", "start", "copies")}
            for block in blocks(batch.column("body")):
                starts, ends, firsts = units.places(block)
                spans = Spans(units.codes(block, starts, ends))
                first, at = firsts[:-1], _anchors(spans, units)[1][firsts[:-1]]
                # units before the anchor, in the first and in the last window
                most, least = at - first, at - (firsts[1:] - units.window)
                halves = (most >> shift) - (least >> shift) + 1
                of = np.repeat(np.arange(block.rows), halves)
                half = (most >> shift)[of] - ranges(np.zeros(block.rows, np.int64), halves)
                at, low, high = at[of], half << shift, np.minimum(((half + 1) << shift) - 1, last_place)
                shared = spans.hash(at - low, at - high + units.window)
                key = mix(shared + (half + 1 + (halving << 8)).astype(np.uint64) * np.uint64(_GOLDEN)).view(np.int64)
                begin, end = at - np.minimum(high, most[of]), at - np.maximum(low, least[of]) + units.window
                part, moved = spans.hash(begin, end).view(np.int64), begin - first[of]
                data = block.data.tobytes()
                bodies = [data[a:b] for a, b in zip(starts[begin].tolist(), ends[end - 1].tolist())]
                mine = {n: values[block.first_row + of] for n, values in flat.items()}
                columns = [mine["anchor"], mine["segment"], mine["nth"] + moved, key, part, mine["id"], mine["start"] + moved, mine["copies"]]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns] + [pa.array(bodies, pa.binary())], names=[*PARTS, "body"])

    rows = rows.select("anchor", "segment", "nth", "id", "start", "copies", "body")
    return rows.mapInArrow(cut, ", ".join(f"{c} long" for c in PARTS) + ", body binary")


FIRSTS = "anchor long, digest long, lo long, hi long, first_id long, first_start long"


def _first_places(segments: DataFrame, finder: Finder, parts: int) -> DataFrame:
    """Ranges [lo, hi) of a segment's windows, with the first document and the first start of window ``lo``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            anchor, digest, ids, start, copies = (chunk.column(c).to_numpy() for c in ("anchor", "digest", "id", "start", "copies"))
            segment, lo, hi, first_id, first_start = finder(chunk.column("body").to_pylist(), ids, start, copies)
            columns = [anchor[segment], digest[segment], lo, hi, first_id, first_start]
            names = ["anchor", "digest", "lo", "hi", "first_id", "first_start"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    dealt = segments.select("anchor", "digest", "id", "start", "copies", "body").repartition(parts, "anchor")
    return dealt.sortWithinPartitions("anchor").mapInArrow(find, FIRSTS)


def _crowded(segments: DataFrame) -> DataFrame:
    return segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_SEGMENTS).select("anchor")


def _window_places(docs_texts: DataFrame, segments: DataFrame, units: Units, finder: Finder, parts: int) -> DataFrame:
    """First places of the windows of all segments, of crowded anchors by parts of their segments."""
    spark = docs_texts.sparkSession
    texts = docs_texts.select("_id", "text")
    crowded = stage(spark, _crowded(segments), "crowded-anchors")
    even = segments.join(crowded, "anchor", "left_anti")
    found = _first_places(_segment_texts(texts.repartition(parts, "_id"), even, units), finder, parts)
    # one anchor for every HOT_SEGMENTS segments at most
    anchors = np.array([row[0] for row in crowded.collect()], dtype=np.int64)
    if not len(anchors):
        return found
    # the texts of crowded segments are cut out of the documents once, and halved from there on
    rows = _crowded_texts(texts, segments.join(crowded, "anchor", "left_semi"), anchors, units)
    rows = rows.withColumn("segment", F.col("digest")).withColumn("nth", F.lit(0).cast("long"))
    settled = []
    for halving in range(1, units.halvings + 1):
        halves = stage(spark, _halves(rows, units, halving), "halves")
        crowded = _crowded(halves.select(F.col("key").alias("anchor"), "part").distinct()).withColumnRenamed("anchor", "key")
        if halving == units.halvings:
            settled.append(halves)  # parts of one window under the hash of that window
            break
        crowded = stage(spark, crowded, "crowded-keys")
        settled.append(halves.join(crowded, "key", "left_anti"))
        if crowded.isEmpty():
            break
        rows = halves.join(crowded, "key", "left_semi")
    pieces = reduce(DataFrame.unionByName, settled)
    firsts = pieces.groupBy(F.col("key").alias("anchor"), F.col("part").alias("digest")).agg(
        F.min(F.struct("id", "start", "body")).alias("_first"), F.sum("copies").alias("copies")
    )
    places = _first_places(firsts.select("anchor", "digest", "_first.*", "copies"), finder, parts)
    places = places.withColumnsRenamed({"anchor": "key", "digest": "part"})
    return found.unionByName(
        pieces.join(places, ["key", "part"]).select(
            "anchor", F.col("segment").alias("digest"), (F.col("nth") + F.col("lo")).alias("lo"), (F.col("nth") + F.col("hi")).alias("hi"),
            "first_id", "first_start",
        )
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by anchor in tables of about CHUNK_BYTES of text that never part an anchor."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        anchors = batch.column("anchor").to_numpy()
        sizes = np.cumsum(pa.compute.binary_length(batch.column("body")).to_numpy())
        heads = np.append(np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])), len(anchors))
        row = 0
        for head, end in zip(heads[:-1].tolist(), heads[1:].tolist()):
            before = size + int(sizes[head - 1] - (sizes[row - 1] if row else 0)) if head > row else size
            if before >= CHUNK_BYTES and anchors[head] != last:
                if head > row:
                    held.append(batch.slice(row, head - row))
                yield pa.Table.from_batches(held)
                held, size, row = [], 0, head
            last = anchors[head]
        if len(anchors) > row:
            held.append(batch.slice(row))
            size += int(sizes[-1] - (sizes[row - 1] if row else 0))
    if held:
        yield pa.Table.from_batches(held)


def repeated_ranges(docs_texts: DataFrame, units: Units, finder: Finder, within: bool) -> DataFrame:
    """(_id, ranges): the units of every document that a window covers which came earlier, as ranges [from, to).

    Earlier is in a document with a smaller identifier or, if ``within``, before in the same one.
    """
    spark = docs_texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # an anchor with very many runs is counted inside tasks first, and Spark may split it in the join
    runs = _runs(docs_texts, units)
    times = F.shiftright(F.col("place").bitwiseAND(START - 1), TIMES.bit_length() - 1)
    count = F.sum(times) > 1 if within else F.min("id") < F.max("id")
    recurring = runs.groupBy("anchor").agg(count.alias("_again")).where("_again").select("anchor")
    occurrences = stage(spark, runs.join(recurring, "anchor"), "recurring-runs")
    segments = stage(
        spark,
        occurrences.groupBy("anchor", "digest").agg(F.min(F.struct("id", "place")).alias("_first"), F.sum(times).alias("copies"))
        .select("anchor", "digest", "_first.*", "copies"),
        "segments",
    )
    found = _window_places(docs_texts, segments, units, finder, parts)
    start, number = F.shiftright("place", START.bit_length() - 1), F.col("place").bitwiseAND(TIMES - 1)
    own = (F.col("first_id") == F.col("id")) & (F.col("first_start") == start + F.col("lo"))
    if within:  # the first of all keeps itself, and loses what comes again after it
        gone = F.when(own, 1).otherwise(0)
    else:
        gone = F.when(F.col("first_id") < F.col("id"), 0).otherwise(times)
    # repeats of a run leave no gap: a run has fewer windows than a window has units
    ends = start + (times - 1) * number + F.col("hi") + (units.window - 1)
    return (
        occurrences.join(found, ["anchor", "digest"])
        .withColumn("_gone", gone)
        .where(F.col("_gone") < times)
        .groupBy(F.col("id").alias("_id"))
        .agg(F.collect_list(F.struct((start + F.col("_gone") * number + F.col("lo")).alias("a"), ends.alias("b"))).alias("ranges"))
    )


def joined_windows(segment: np.ndarray, nth: np.ndarray, first_id: np.ndarray, first_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows (by segment and number) as ranges over which the first place moves along with the window."""
    if not len(segment):
        return (np.zeros(0, np.int64),) * 5
    order = np.lexsort((nth, segment))
    segment, nth, first_id, first_start = segment[order], nth[order], first_id[order], first_start[order]
    new = np.ones(len(segment), dtype=bool)
    new[1:] = (segment[1:] != segment[:-1]) | (nth[1:] != nth[:-1] + 1) | (first_id[1:] != first_id[:-1]) | (first_start[1:] != first_start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(segment)) - 1
    return segment[head], nth[head], nth[tail] + 1, first_id[head], first_start[head]


def covered(lists: pa.ListArray, block: Block, firsts: np.ndarray) -> np.ndarray:
    """Which units of a block lie in a range of their row."""
    depth = np.zeros(firsts[-1] + 1, dtype=np.int64)
    part = lists.slice(block.first_row, block.rows)
    counts = part.value_lengths().fill_null(0).to_numpy()
    flat = part.flatten()
    if len(flat):
        base = np.repeat(firsts[:-1], counts)
        limit = np.repeat(firsts[1:], counts)
        a = np.minimum(base + flat.field("a").to_numpy(zero_copy_only=False), limit)
        b = np.minimum(base + flat.field("b").to_numpy(zero_copy_only=False), limit)
        np.add.at(depth, a, 1)
        np.add.at(depth, b, -1)
    return np.cumsum(depth)[:-1] > 0
