"""Removal of repeated byte strings by suffix arrays.

Segments that can hold a repeated window (see ``repeats``) are dealt into shards by their anchor, and each shard sorts
the suffixes of its segments in two stages. A suffix is of type B if it is smaller than its successor, the one that
starts a byte later. Only suffixes of type B are compared; a scan over the buckets of first bytes puts every other
suffix behind its smaller successor, in order. Adjacent suffixes that share a window's length are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.arrow_text import blocks, ranges
from orderloom.llm.repeats import Units, _texts, covered, joined_windows, repeated_ranges

WINDOW = 100
GRAM = 32


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Type B: which suffixes are smaller than the next one. Equal bytes have the type of what follows them; the
    last suffix counts as smaller than the empty one that ends the text."""
    n = len(text)
    following = np.append(text[1:], 255)
    differs = np.append(text[:-1] != text[1:], True)
    place = np.where(differs, np.arange(n), n)
    place = np.minimum.accumulate(place[::-1])[::-1]
    return text[place] < following[place]


def two_stage_order(text: np.ndarray, real: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at the places ``real`` in order. Type B suffixes are compared over ``depth`` bytes.

    ``text`` holds bytes above 0, and at least ``depth`` zeros after every segment. ``real`` has the first places of every segment,
    as far as some suffix of type B; the first of the zeros is one.
    Two suffixes that share more than ``depth`` bytes may stand in any order, next to each other.
    """
    kind = smaller_than_successor(text)
    kind[text == 0] = True
    of_b = real[kind[real]]
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)
    keys = np.ascontiguousarray(rows[of_b]).view(f"S{depth}").ravel()
    of_b = of_b[np.argsort(keys, kind="stable")]

    # buckets by first byte: suffixes of type A from the front, those of type B at the end
    sizes = np.bincount(text[real], minlength=256)
    fronts = np.cumsum(sizes) - sizes
    b_sizes = np.bincount(text[of_b], minlength=256)
    order = np.full(len(real), -1, dtype=np.int64)
    within = ranges(np.zeros(256, dtype=np.int64), b_sizes)
    order[np.repeat(fronts + sizes - b_sizes, b_sizes) + within] = of_b

    front, out = fronts.tolist(), order.tolist()
    # the byte of a type A predecessor, or 0 where there is none to induce
    before = np.zeros(len(text), dtype=np.uint8)
    before[1:] = np.where(kind[:-1], 0, text[:-1])
    induces = before.tobytes()
    at = 0
    while at < len(out):
        place = out[at]
        byte = induces[place]
        if byte:
            out[front[byte]] = place - 1
            front[byte] += 1
        at += 1
    return np.array(out, dtype=np.int64)


def holding_windows(text: np.ndarray, base: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
    """The places that have to be sorted: those where a whole window fits into a segment, and behind the last of them those up to
    a suffix of type B, which puts it in order. The others neither hold a window nor induce one that does."""
    held = np.flatnonzero(smaller_than_successor(text) | (text == 0))
    last = base + lengths - window
    ends = np.where(lengths < window, base, held[np.searchsorted(held, np.maximum(last, base))] + 1)
    return ranges(base, ends - base)


def common_prefix_reaches(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix shares its first ``length`` bytes with the one before it in the order."""
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    out = np.zeros(len(order), dtype=bool)
    for first in range(1, len(order), 1 << 13):
        last = min(first + (1 << 13), len(order))
        out[first:last] = (rows[order[first:last]] == rows[order[first - 1 : last - 1]]).all(axis=1)
    return out


def first_windows(bodies: list[bytes], ids: np.ndarray, starts: np.ndarray, copies: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Where the windows of some segments occur first, as ranges; windows that occur once are left out."""
    lengths = np.array([len(b) for b in bodies], dtype=np.int64)
    depth = window + 4
    base = np.concatenate(([0], np.cumsum(lengths + depth)[:-1]))
    text = np.zeros(int((lengths + depth).sum()), dtype=np.uint8)
    # no byte of UTF-8 is 255, so that one more than the byte fits
    text[ranges(base, lengths)] = np.minimum(np.frombuffer(b"".join(bodies), dtype=np.uint8), 254) + 1
    order = two_stage_order(text, holding_windows(text, base, lengths, window), depth)

    segment_of = np.searchsorted(base, order, side="right") - 1
    nth = order - base[segment_of]
    whole = nth <= lengths[segment_of] - window
    order, segment_of, nth = order[whole], segment_of[whole], nth[whole]
    if not len(order):
        return joined_windows(*(np.zeros(0, np.int64),) * 4)
    new = ~common_prefix_reaches(text, order, window)
    group, heads = np.cumsum(new) - 1, np.flatnonzero(new)
    doc, start = ids[segment_of], starts[segment_of] + nth
    first_doc = np.minimum.reduceat(doc, heads)[group]
    first_start = np.minimum.reduceat(np.where(doc == first_doc, start, np.iinfo(np.int64).max), heads)[group]
    again = np.add.reduceat(copies[segment_of], heads)[group] > 1
    return joined_windows(segment_of[again], nth[again], first_doc[again], first_start[again])


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    A byte goes if a string of ``window`` bytes around it also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one. Null texts are empty. Repeated rows are the same document and do not count as earlier
    than each other. Rows without an identifier are one document before all others. Other columns are not looked at.
    """
    texts = _texts(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = repeated_ranges(texts, Units(False, window, gram), first_windows, within=True)
    whole = texts.select("_id", "text").repartition(parts, "_id").join(gone, "_id", "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            for block in blocks(batch.column("text")):
                out = covered(batch.column("ranges"), block, block.offsets)
                rows = []
                for row in range(block.rows):
                    a, b = block.offsets[row], block.offsets[row + 1]
                    mask = out[a:b]
                    kept = block.data[a:b][~mask].tobytes()
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if b > a else 0
                    doc_id = ids[block.first_row + row]
                    rows.append((None if doc_id == -(1 << 63) else doc_id, b - a, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                columns = list(zip(*rows))[: 6 if with_text else 5]
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)])

    return whole.select("_id", "text", "ranges").mapInArrow(cut, schema)
