"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

Scores are divided by the item's score against itself, so that one threshold holds for all items. Items are found by
block-max WAND: postings lie in blocks of item numbers with the largest impact of each block, and a cursor moves only to
items whose blocks can still reach the threshold. Most passages cannot reach it with any item, and a bound over all
passages of a block of text says so first: an item's *essential* terms are all but its weakest ones, which
together weigh less than half the threshold, so a passage must gather the other half from essential postings.

A retrieved item is a leak if the passage holds most word triples of its question and of its answer. Words are compared
without the signs around them and without regard to case, in items and documents alike; a word that has only signs stays
as it is.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text; a larger benchmark takes more shards.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.arrow_text import Block, blocks, ranges, row_of
from orderloom.llm.rows import without

SHARD_BYTES = 8 << 20
THRESHOLD = 0.5
OVERLAP = 0.5
LEAST_PASSAGE = 32
LEAST_PART = 8  # words of a question or an answer: one that differs leaves half of the triples
K1, B = 1.2, 0.75  # the usual BM25 parameters
BLOCK_ITEMS = 8

MATCHES = "doc_id long, item_id long, start_word long, n_words long, bm25 double, question_overlap double, answer_overlap double"


@cache
def letter_points() -> np.ndarray:
    """For every code point, whether it is a letter, a mark or a digit."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)])


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """For every byte of UTF-8, whether it belongs to a letter, a mark or a digit."""
    known = letter_points()
    out = known[data] & (data < 0x80)
    heads = np.flatnonzero(data >= 0xC0)
    head = data[heads].astype(np.int64)
    size = 2 + (head >= 0xE0) + (head >= 0xF0)
    whole = heads + size <= len(data)
    heads, head, size = heads[whole], head[whole], size[whole]
    point = head & (0x7F >> size)
    for step in range(1, 4):
        more = size > step
        point[more] = point[more] << 6 | (data[heads[more] + step] & 0x3F)
    letter = known[np.minimum(point, len(known) - 1)]
    out[ranges(heads[letter], size[letter])] = True
    return out


def bare_words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words without the signs around them, and the first word of each row."""
    starts, ends, firsts = block.words()
    letters = np.flatnonzero(letter_bytes(block.data))
    low, high = np.searchsorted(letters, starts), np.searchsorted(letters, ends)
    some = high > low
    starts[some], ends[some] = letters[low[some]], letters[high[some] - 1] + 1
    return starts, ends, firsts


def folded(block: Block) -> Block:
    """The block's texts by the full case folding of Unicode, which also makes two letters of a sharp s."""
    rows = [block.text(row).decode("utf-8", "replace").casefold().encode() for row in range(block.rows)]
    return Block(block.first_row, np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum([0, *map(len, rows)]))


def hashed_words(text: bytes) -> np.ndarray:
    block = folded(Block(0, np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)])))
    starts, ends, _ = bare_words(block)
    return block.span_hash(starts, ends)


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentences that have ``LEAST_PART`` words answer, or the last quarter of the words if too few are left to ask.

    A text too short for two such parts is both.
    """
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 2 * LEAST_PART:
        return text, text
    cut = max((k for k in range(1, len(words) - LEAST_PART + 1) if words[k - 1][-1] in ".!?"), default=0)
    if cut < LEAST_PART:
        cut = len(words) - max(LEAST_PART, len(words) // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


def word_triples(words: list) -> set:
    """Distinct runs of three words; a shorter text is one run."""
    size = min(3, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if size else set()


class ItemIndex:
    """BM25 postings of some test items with block maxima. Every impact is a share of its item's own score."""

    def __init__(self, item_ids: list, texts: list[str], n_items: int, mean_words: float, frequency: dict[int, int] | None, threshold: float):
        self.item_ids, self.threshold = item_ids, threshold
        self.words = [hashed_words(t.encode()) for t in texts]
        self.parts = [
            tuple(word_triples(hashed_words(part.encode()).tolist()) for part in question_and_answer(t)) for t in texts
        ]
        if frequency is None:
            terms, counts = np.unique(np.concatenate([np.unique(w) for w in self.words] or [np.zeros(0, np.uint64)]), return_counts=True)
            frequency = dict(zip(terms.tolist(), counts.tolist()))
        postings: dict[int, list[tuple[int, float]]] = {}
        essential: list[tuple[int, int, float]] = []
        self.bound = np.full(len(texts), np.inf)
        for item, words in enumerate(self.words):
            terms, tf = np.unique(words, return_counts=True)
            if not len(terms):
                continue
            df = np.array([frequency[t] for t in terms.tolist()], dtype=float)
            idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            impact = impact / impact.sum()
            for term, share in zip(terms.tolist(), impact.tolist()):
                postings.setdefault(term, []).append((item, share))
            order = np.argsort(impact, kind="stable")
            weak = np.cumsum(impact[order]) < threshold / 2
            # what the essential terms must bring, with a margin for the rounding of sums
            self.bound[item] = threshold - impact[order[weak]].sum() - 1e-9
            essential += [(terms[k], item, impact[k]) for k in order[~weak].tolist()]
        self.postings = {
            term: (np.array([i for i, _ in rows]), np.array([s for _, s in rows])) for term, rows in postings.items()
        }
        self.block_max = {}
        for term, (items, shares) in self.postings.items():
            numbers, firsts = np.unique(items // BLOCK_ITEMS, return_index=True)
            self.block_max[term] = dict(zip(numbers.tolist(), np.maximum.reduceat(shares, firsts).tolist()))
        essential.sort(key=lambda row: (row[0], row[1]))
        hashes = np.array([row[0] for row in essential], dtype=np.uint64)
        self.terms, firsts = np.unique(hashes, return_index=True)
        self.firsts = np.append(firsts, len(hashes))
        self.items = np.array([row[1] for row in essential], dtype=np.int64)
        self.shares = np.array([row[2] for row in essential], dtype=float)

    def candidates(self, passage: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Passages (numbers) that can reach the threshold with some item, from all words of all passages."""
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = self.terms[place] == hashes
        pairs = np.unique(passage[hit] * len(self.terms) + place[hit])
        passages, places = pairs // len(self.terms), pairs % len(self.terms)
        lengths = self.firsts[places + 1] - self.firsts[places]
        at = ranges(self.firsts[places], lengths)
        keys, inverse = np.unique(np.repeat(passages, lengths) * len(self.bound) + self.items[at], return_inverse=True)
        reached = np.bincount(inverse, weights=self.shares[at], minlength=len(keys)) >= self.bound[keys % len(self.bound)]
        return np.unique(keys[reached] // len(self.bound))

    def search(self, query: np.ndarray) -> list[tuple[int, float]]:
        """All items that score at least the threshold, by block-max WAND."""
        cursors = []  # (item, term, position): the postings not yet passed, in the order of items
        for term in np.unique(query).tolist():
            if term in self.postings:
                cursors.append([int(self.postings[term][0][0]), term, 0])
        heapq.heapify(cursors)
        most = {term: max(self.block_max[term].values()) for _, term, _ in cursors}
        found = []
        while cursors:
            cursors.sort()
            total, pivot = 0.0, None
            for cursor in cursors:
                total += most[cursor[1]]
                if total >= self.threshold - 1e-9:
                    pivot = cursor[0]
                    break
            if pivot is None:
                break
            block = pivot // BLOCK_ITEMS
            near = [c for c in cursors if c[0] <= pivot]
            if sum(self.block_max[c[1]].get(block, 0.0) for c in near) < self.threshold - 1e-9:
                # no item of this block up to the next cursor can reach it
                ahead = min((c[0] for c in cursors if c[0] > pivot), default=1 << 60)
                target = max(pivot + 1, min(ahead, (block + 1) * BLOCK_ITEMS))
            elif cursors[0][0] == pivot:
                score = sum(float(self.postings[c[1]][1][c[2]]) for c in cursors if c[0] == pivot)
                if score >= self.threshold - 1e-9:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            left = []
            for cursor in cursors:
                if cursor[0] < target:
                    items = self.postings[cursor[1]][0]
                    place = int(np.searchsorted(items, target))
                    if place == len(items):
                        continue
                    cursor = [int(items[place]), cursor[1], place]
                left.append(cursor)
            cursors = left
        return found


def passage_matches(block: Block, index: ItemIndex, half: int, overlap: float) -> dict[tuple[int, int], tuple]:
    """Verified leaks of a block of rows: (row, item) to (start word, words, score, question, answer).

    Passages are ``2 * half`` words long and start every ``half`` words, so that any ``half`` words lie in one.
    """
    starts, ends, firsts = bare_words(block)
    if not len(starts):
        return {}
    hashes = block.span_hash(starts, ends)
    row = row_of(np.arange(len(starts)), firsts)
    n_steps = -(-np.diff(firsts) // half)  # stretches of ``half`` words
    base = np.concatenate(([0], np.cumsum(n_steps)))
    step = base[row] + (np.arange(len(starts)) - firsts[row]) // half
    inner = step > base[row]
    passage = np.concatenate([step, step[inner] - 1])
    found: dict[tuple[int, int], tuple] = {}
    for number in index.candidates(passage, np.concatenate([hashes, hashes[inner]])).tolist():
        at = int(row_of(np.array([number]), base)[0])
        first = int(firsts[at]) + (number - int(base[at])) * half
        last = min(first + 2 * half, int(firsts[at + 1]))
        words = hashes[first:last]
        triples = None
        for item, score in index.search(words):
            if triples is None:
                own = words.tolist()
                triples = {n: {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} for n in (1, 2, 3)}
            shares = []
            for part in index.parts[item]:
                size = len(next(iter(part))) if part else 1
                shares.append(len(part & triples[size]) / len(part) if part else 1.0)
            if min(shares) >= overlap and (at, item) not in found or (at, item) in found and found[at, item][2] < score:
                if min(shares) >= overlap:
                    found[at, item] = (first - int(firsts[at]), last - first, score, *shares)
    return found


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """One row per document and test item that leaked into it, with the best passage.

    Items without words, null texts and null identifiers match nothing. Words are compared without regard to
    case. Repeated documents give a row each; repeated items match each on their own. Empty tables
    give an empty result.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).where("item_id IS NOT NULL")
    sized = items.mapInArrow(_add_words, "item_id long, text string, _words array<long>").where(F.size("_words") > 0)
    n_items, n_words, n_bytes, longest = sized.agg(
        F.count(F.lit(1)), F.sum(F.size("_words")), F.sum(F.octet_length("text")), F.max(F.size("_words"))
    ).first()
    spark = docs.sparkSession
    if not n_items:
        return spark.createDataFrame([], MATCHES)
    half = max(LEAST_PASSAGE, longest)
    shards = max(1, math.ceil(n_bytes / shard_bytes))
    counts = sized.select(F.explode(F.array_distinct("_words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    out = None
    for shard in range(shards):
        own = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        rows = own.select("item_id", "text").orderBy("item_id", "text").collect()  # about ``shard_bytes``
        frequency = None
        if shards > 1:
            terms = own.select(F.explode("_words").alias("word")).distinct().join(counts, "word").collect()
            frequency = {r["word"] % (1 << 64): r["df"] for r in terms}
        index = ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], n_items, n_words / n_items, frequency, threshold)
        part = _search(docs, index, half, overlap)
        out = part if out is None else out.unionByName(part)
    return out


def _add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items with the hashes of their words, as signed numbers."""
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).to_pylist()
        lists = pa.array([hashed_words(t).view(np.int64) for t in texts], pa.list_(pa.int64()))
        yield pa.record_batch([batch.column(0), batch.column(1), lists], names=["item_id", "text", "_words"])


def _search(docs: DataFrame, index: ItemIndex, half: int, overlap: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by ``shard_bytes``

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids = batch.column(0)
            rows = []
            for block in blocks(batch.column(1)):
                for (row, item), found in sorted(passage_matches(folded(block), index, half, overlap).items()):
                    rows.append((ids[block.first_row + row].as_py(), index.item_ids[item], *found))
            columns = [list(c) for c in zip(*rows)] or [[]] * 7
            types = [pa.int64()] * 4 + [pa.float64()] * 3
            names = ["doc_id", "item_id", "start_word", "n_words", "bm25", "question_overlap", "answer_overlap"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, MATCHES)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns. Rows without an identifier stay."""
    return without(docs, benchmark_leaks(docs, benchmark))
