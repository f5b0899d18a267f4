"""Packing of token pieces into fixed windows by best-fit decreasing.

Documents are tokenised and cut into full windows and one rest. Pieces of one length are interchangeable, so best-fit
decreasing is planned on the histogram of lengths, which has at most ``window`` rows however large the corpus: a
segment tree over the remaining capacities finds the tightest open window for the next length, and all windows that
are alike are filled at once. The plan says for each length which ranks go where. Pieces get their rank within their
length from a distributed count, look their place up in the plan, and never meet in one task.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.arrow_text import ranges
from orderloom.llm.sharding import number_rows
from orderloom.session import stage

WINDOW = 2048
END_ID = 1
# words whose ids a Python worker remembers over its tasks; beyond that it starts anew
KNOWN_WORDS = 1_000_000
WORDS_A_CALL = 2000
ROWS_A_STEP = 200
# letters or digits, and then signs to the end; an apostrophe may belong to letters, and is left with them
_CORE_AND_SIGNS = r"^(?P<core>[\pL\pN]+)(?P<signs>[!-&(-/:-@\[-`{-~]+)$"
# letters only, of those whose lower case and composition need no context: below U+0250, without U+0130
_LATIN = r"^[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it can be seen, else the next free one."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


@lru_cache(maxsize=100_000)
def _stays_a_letter(sign: str) -> bool:
    """Whether a letter or digit ends in one after lower case and composition; else the tokenizer joins it with what follows."""
    return unicodedata.normalize("NFC", sign.lower())[-1].isalnum()


def _is_latin(word: str) -> bool:
    """Letters only, of those whose lower case and composition need no context."""
    return word.isalpha() and max(word) < "\u0250" and "\u0130" not in word


class WordIds:
    """Token ids of texts, as little-endian 32-bit bytes, by a tokenizer that never joins words over a space.

    Each distinct word is tokenised once and remembered; a text's ids are those of its words. ``spaces`` must be
    characters at which the tokenizer always cuts. The tokenizer is byte-level and writes its vocabulary by ``_BYTE_LETTERS``.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel unit
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    def cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words as their cores and the signs behind them, since the tokenizer cuts there and drops the case; where it does
        not, the core is the whole word."""
        found = pc.extract_regex(words, _CORE_AND_SIGNS)
        cores, signs = found.field("core"), found.field("signs")
        last = pc.utf8_slice_codeunits(cores, -1).dictionary_encode()
        stay = pa.array([bool(c) and _stays_a_letter(c) for c in last.dictionary.to_pylist()] or [False], pa.bool_())
        apart = pc.and_(found.is_valid(), pc.fill_null(stay.take(pc.fill_null(last.indices, 0)), False))
        cores, signs = pc.if_else(apart, cores, words), pc.if_else(apart, signs, "")
        return pc.if_else(pc.match_substring_regex(cores, _LATIN), pc.utf8_lower(cores), cores), signs

    def tokenise(self, words: list[str]) -> None:
        """Latin letters in lower case go to the tokenizer's model as they are, without its normaliser and splitter."""
        pieces = self.tokenizer.model.tokenize
        others = []
        for word in words:
            if _is_latin(word) and word == word.lower():
                ids = [token.id for token in pieces(word.encode().decode("latin-1").translate(_BYTE_LETTERS))]
                self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(word)
        words = others
        for at in range(0, len(words), WORDS_A_CALL):
            some = words[at : at + WORDS_A_CALL]
            firsts = np.cumsum([0] + [len(w) + 1 for w in some])
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            places = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            cuts = 4 * np.searchsorted(places, firsts)
            for k, word in enumerate(some):
                self.known[word] = ids[cuts[k] : cuts[k + 1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts one after another, and the place of each text's first one."""
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        parts = pa.concat_arrays(list(self.cut(coded.dictionary.cast(pa.large_string())))).dictionary_encode()
        words, part = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        known = self.known
        if new := [w for w in words if w not in known]:
            if len(known) + len(new) > KNOWN_WORDS:  # what this call needs must be known at its end
                self.known, new = {"": b""}, words
            self.tokenise(new)
            known = self.known
        bodies = [known[w] for w in words]
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies)) // 4
        firsts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(bodies), dtype="<u4")
        # a word is its core and its signs, side by side
        pairs = part.reshape(2, -1).T[coded.indices.to_numpy()].ravel()
        lengths = sizes[pairs]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        offsets = split.offsets.to_numpy()
        return ids[ranges(firsts[pairs], lengths)], ends[2 * (offsets - offsets[0])]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The tokenizer of a Python worker, with the words that its earlier tasks have met."""
    return WordIds(path)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and the ids themselves if asked for.

    A document is its token ids and the end id; a null or empty text is the end id alone. Pieces are full windows
    and the rest. Columns other than doc_id and text are not looked at.
    """
    schema = T.StructType(PIECES.fields + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []))
    names = schema.fieldNames()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer_path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_A_STEP):
                part = batch.slice(first, ROWS_A_STEP)
                out: dict[str, list] = {name: [] for name in names}
                found, firsts = encoder.encode(part.column(1).fill_null(""))
                for row, doc_id in enumerate(part.column(0).to_pylist()):
                    ids = found[firsts[row] : firsts[row + 1]].tobytes() + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["length"].append(len(piece) // 4)
                        out["ids_crc32"].append(zlib.crc32(piece))
                        out["doc_tokens"].append(total)
                        if with_ids:
                            out["ids"].append(np.frombuffer(piece, dtype="<u4").tolist())
                types = {name: pa.int64() for name in names} | ({"ids": pa.list_(pa.int64())} if with_ids else {})
                yield pa.record_batch([pa.array(out[n], types[n]) for n in names], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class OpenWindows:
    """How many windows are open at each remaining capacity, as a segment tree of sums."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, capacity: int, number: int) -> None:
        node = capacity + self.size
        while node:
            self.sums[node] += number
            node >>= 1

    def tightest(self, needed: int) -> int | None:
        """The smallest capacity of at least ``needed`` that an open window has."""
        node = needed + self.size
        if self.sums[node]:
            return needed
        while node > 1:  # up, until a subtree to the right has open windows
            if not node & 1 and self.sums[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.size:  # and down to its first one
            node = 2 * node if self.sums[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_decreasing(lengths: dict[int, int], window: int) -> np.ndarray:
    """Places of all pieces, from how many there are of each length.

    Rows (length, first rank, pieces a window, first sequence, offset): the pieces of that length from that rank on
    go ``pieces a window`` into each sequence from the first, side by side from the offset. The result is that of
    best-fit decreasing piece by piece: a piece that leaves room for its like makes its window the tightest one.
    """
    tree, alike, rows, sequences = OpenWindows(window), {}, [], 0

    def put(capacity: int, first: int, number: int) -> None:
        if capacity and number:
            alike.setdefault(capacity, []).append((first, number))
            tree.add(capacity, number)

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, per = window, window // length
                first, number = sequences, -(-left // per)
                sequences += number
            else:
                per = capacity // length
                first, number = alike[capacity].pop()
                tree.add(capacity, -number)
            filled = min(number, left // per)
            if filled:
                rows.append((length, rank, per, first, window - capacity))
                put(capacity - per * length, first, filled)
                rank, left = rank + filled * per, left - filled * per
            if filled < number and left:  # fewer pieces than one window holds
                rows.append((length, rank, left, first + filled, window - capacity))
                put(capacity - left * length, first + filled, 1)
                filled, rank, left = filled + 1, rank + left, 0
            put(capacity, first + filled, number - filled)
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece with its sequence_id and offset; see ``token_pieces`` for the other columns.

    Offsets in a sequence leave no gap. Repeated rows are packed each on their own. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    pieces = stage(spark, token_pieces(docs, tokenizer_path, window, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    plan = best_fit_decreasing(histogram, window)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    keys = (plan[:, 0] << 48) + plan[:, 1]
    ranked = number_rows(pieces, ["length"], "rank")
    schema = T.StructType(
        pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = plan[np.searchsorted(keys, (length << 48) + rank, side="right") - 1] if len(plan) else plan[:0]
            nth = rank - row[:, 1]
            columns = [batch.column(name) for name in schema.fieldNames()[:-2]]
            columns += [pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * length)]
            yield pa.record_batch(columns, names=schema.fieldNames())

    return ranked.mapInArrow(place, schema)
