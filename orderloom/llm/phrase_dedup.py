"""Removal of repeated phrases by Aho-Corasick automata.

Segments that can hold a repeated window of words (see ``repeats``) are dealt into shards by their anchor. A shard
confirms which windows occur more than once, compiles them into an automaton, and streams all its segments through it;
the matches tell the first document. A segment stands for all documents that hold it. Inside a shard every distinct
word is two characters, so that a window of 13 words is a pattern of 26 characters and matches only whole words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.arrow_text import blocks
from orderloom.llm.repeats import Units, _texts, covered, joined_windows, repeated_ranges

WINDOW = 13
GRAM = 5
# first characters of words; with them a shard has room for 3.5 million words, more than its 1 MB and one anchor hold
BASE = 64


class Letters(dict):
    """Two characters for every distinct word: one of ``BASE``, and one of others.

    A node of the automaton looks through its children one after another, so that few characters matter more than short
    patterns. No second character is a first one, and thus no match begins or ends inside a word.
    """

    def __missing__(self, word: bytes) -> str:
        rest, low = divmod(len(self), BASE)
        letters = self[word] = chr(low) + chr(BASE + rest)
        return letters


def first_phrases(bodies: list[bytes], ids: np.ndarray, starts: np.ndarray, copies: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Where the windows of some segments occur first, as ranges; windows that occur once are left out."""
    letters = Letters()
    texts = ["".join([letters[w] for w in body.split(b" ")]) for body in bodies]
    length = 2 * window
    # confirm: which phrases recur
    times: dict[str, int] = {}
    for text, number in zip(texts, copies.tolist()):
        for k in range(0, len(text) - length + 1, 2):
            phrase = text[k : k + length]
            times[phrase] = times.get(phrase, 0) + number
    automaton = ahocorasick.Automaton()
    for phrase, number in times.items():
        if number > 1:
            automaton.add_word(phrase, len(automaton))
    found: list[tuple[int, int, int]] = []
    if len(automaton):
        automaton.make_automaton()
        for k, text in enumerate(texts):
            found += [(k, (end + 1 - length) // 2, pattern) for end, pattern in automaton.iter(text)]
    segment, nth, pattern = (np.array(c, dtype=np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    first = np.full(len(automaton), np.iinfo(np.int64).max)
    np.minimum.at(first, pattern, ids[segment])
    # only the document counts as earlier; the start just lets neighbouring windows join
    return joined_windows(segment, nth, first[pattern], nth)


def remove_repeated_phrases(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and the kept words if asked for.

    A word goes if a window around it also starts in a document with a smaller doc_id. Words are runs without white
    space, unchanged. Null texts have none. Repeated rows are the same document. Rows without an identifier are one
    document before all others. Other columns are not looked at.
    """
    texts = _texts(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = repeated_ranges(texts, Units(True, window, gram), first_phrases, within=False)
    whole = texts.select("_id", "text").repartition(parts, "_id").join(gone, "_id", "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            for block in blocks(batch.column("text")):
                starts, ends, firsts = block.words()
                out = covered(batch.column("ranges"), block, firsts)
                data, rows = block.data.tobytes(), []
                for row in range(block.rows):
                    a, b = int(firsts[row]), int(firsts[row + 1])
                    stay = a + np.flatnonzero(~out[a:b])
                    kept = b" ".join([data[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])
                    doc_id = ids[block.first_row + row]
                    rows.append((None if doc_id == -(1 << 63) else doc_id, b - a, b - a - len(stay), hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
                columns = list(zip(*rows))[: 5 if with_text else 4]
                types = [pa.int64()] * 3 + [pa.string(), pa.string()]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)])

    return whole.select("_id", "text", "ranges").mapInArrow(cut, schema)
