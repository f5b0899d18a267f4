"""Quality and toxicity of documents by co-training on two views.

The text view sees the words and the look of a text, the metadata view its language, source and length. For each
target, a classifier per view is fitted on labelled rows; in every round each view labels those unlabelled rows it is
sure of, and the other view learns from them. Each view is then calibrated on labelled rows that were held out, and
the calibrated log-odds are combined. The fit uses a bounded sample (``MAX_LABELLED``, ``MAX_UNLABELLED``: rows
with the smallest hashes of doc_id); every document is scored, in its whole length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.arrow_text import Block, blocks, mix
from orderloom.llm.rows import without

MAX_LABELLED = 8000
MAX_UNLABELLED = 4000
ROUNDS = 3
SURE = 0.97
HELD_OUT = 5  # every fifth labelled row calibrates
BITS = 18
BUCKETS = 1 << BITS
BINS = 24
TARGETS = ("good", "toxic")

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def _binned(values: np.ndarray, salt: int, low: float, high: float) -> np.ndarray:
    """A feature of its own for each stretch of a number's range."""
    bins = np.clip((values - low) / (high - low) * BINS, 0, BINS - 1).astype(np.uint64)
    return (mix(bins + np.uint64(salt << 32)) >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(rows: np.ndarray, features: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(rows.astype(np.int64) << BITS | features)
    return keys & (BUCKETS - 1), np.searchsorted(keys >> BITS, np.arange(n_rows + 1))


def text_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row, and the place of the first of each row: words without the signs around them,
    the signs that end them, and the shares of capitals, digits, signs and repeated words."""
    starts, ends, firsts = block.words()
    n_rows = block.rows
    rows = np.searchsorted(firsts, np.arange(len(starts)), side="right") - 1
    letters = np.concatenate(([0], np.cumsum(_LETTER[block.data] | _DIGIT[block.data])))
    # a word's core: from its first to its last letter or digit
    inner = np.flatnonzero(_LETTER[block.data] | _DIGIT[block.data])
    core = letters[ends] > letters[starts]
    a = starts.copy()
    b = ends.copy()
    if len(inner):
        a[core] = inner[letters[starts[core]]]
        b[core] = inner[letters[ends[core]] - 1] + 1
    lowered = Block(0, _lowered(block.data), block.offsets)
    hashes = lowered.span_hash(a, b)
    words = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    tails = (mix(block.span_hash(b, ends) + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64)[b < ends]

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return (sums[block.offsets[1:]] - sums[block.offsets[:-1]]) / np.maximum(np.diff(block.offsets), 1)

    n_words = np.diff(firsts)
    n_distinct = np.diff(_distinct(rows, words, n_rows)[1])
    again = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])  # a word after itself
    symbols = ~(_LETTER | _DIGIT)
    symbols[[*range(9, 14), 32]] = False
    looks = [
        _binned(share(_UPPER[block.data]), 1, 0, 0.6),
        _binned(share(_DIGIT[block.data]), 2, 0, 0.3),
        _binned(share(symbols[block.data]), 3, 0, 0.5),
        _binned(n_distinct / np.maximum(n_words, 1), 4, 0, 1),
        _binned(np.log1p(n_words), 5, 0, 11),
        _binned(np.diff(block.offsets) / np.maximum(n_words, 1), 6, 0, 24),
        _binned(np.bincount(rows[1:][again], minlength=n_rows) / np.maximum(n_words, 1), 8, 0, 1),
    ]
    every = np.arange(n_rows)
    all_rows = np.concatenate([rows, rows[b < ends], *[every] * len(looks)])
    return _distinct(all_rows, np.concatenate([words, tails, *looks]), n_rows)


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where(_UPPER[data], data + np.uint8(32), data).astype(np.uint8)


def meta_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The features of language, source and length; missing ones are a value of their own."""
    n_rows, all_rows, found = batch.num_rows, [], []
    for salt, name in enumerate(("lang", "source")):
        for block in blocks(batch.column(name).cast(pa.string()).fill_null("\0")):
            hashes = block.span_hash(block.offsets[:-1], block.offsets[1:])
            all_rows.append(np.arange(block.rows) + block.first_row)
            found.append((mix(hashes + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64))
    sizes = np.maximum(batch.column("n_chars").cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False), -1)
    all_rows.append(np.arange(n_rows))
    found.append(_binned(np.log1p(np.maximum(sizes, 0)) + (sizes < 0) * -1.0, 7, -1, 14))
    return _distinct(np.concatenate(all_rows), np.concatenate(found), n_rows)


@dataclass
class Linear:
    """A logistic regression on sparse binary features."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, dtype=np.float32))
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def log_odds(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.weights[features], dtype=np.float64)))
        return sums[firsts[1:]] - sums[firsts[:-1]] + self.bias

    def calibrated(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return self.scale * self.log_odds(features, firsts) + self.shift

    def calibrate(self, log_odds: np.ndarray, truth: np.ndarray) -> None:
        """Platt's scale and shift, by Newton steps on a slightly smoothed truth."""
        if len(truth) < 10 or truth.min() == truth.max():
            return
        n, n_1 = len(truth), truth.sum()
        goal = np.where(truth > 0, (n_1 + 1) / (n_1 + 2), 1 / (n - n_1 + 2))
        x = np.stack([log_odds, np.ones(n)], axis=1)
        at = np.array([1.0, 0.0])
        for _ in range(30):
            p = sigmoid(x @ at)
            grad = x.T @ (p - goal) + 1e-3 * (at - [1.0, 0.0])
            hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            at = at - np.linalg.solve(hess, grad)
        if np.isfinite(at).all() and at[0] > 0:
            self.scale, self.shift = float(at[0]), float(at[1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sample:
    """Sparse rows: the features of row ``i`` are ``features[firsts[i]:firsts[i + 1]]``."""

    def __init__(self, lists: list):
        self.firsts = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        self.features = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
        self.rows = np.repeat(np.arange(len(lists)), np.diff(self.firsts))

    def take(self, rows: np.ndarray) -> "Sample":
        return Sample([self.features[self.firsts[r] : self.firsts[r + 1]] for r in rows])


def telling(sample: Sample, goal: np.ndarray, least_z: float) -> np.ndarray:
    """Which features differ between the classes by ``least_z`` standard errors; the rest would be fitted noise."""
    good = goal > 0.5
    n_1, n_0 = good.sum(), (~good).sum()
    in_1 = np.bincount(sample.features[good[sample.rows]], minlength=BUCKETS)
    in_0 = np.bincount(sample.features[~good[sample.rows]], minlength=BUCKETS)
    share = (in_1 + in_0) / (n_1 + n_0)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_1 + 1 / n_0))
    return np.abs(in_1 / n_1 - in_0 / n_0) >= least_z * error


def fit(sample: Sample, goal: np.ndarray, row_weights: np.ndarray, steps: int = 150, rate: float = 0.3, l2: float = 1e-4, least_z: float = 3.5) -> Linear:
    """Adagrad over all rows, on the telling features. Both classes weigh alike."""
    model = Linear()
    if not len(goal) or goal.min() == goal.max():
        model.bias = 4.0 if len(goal) and goal.max() > 0 else -4.0
        return model
    chosen = telling(sample, goal, least_z)
    used, places = np.unique(sample.features[chosen[sample.features]], return_inverse=True)
    rows = sample.rows[chosen[sample.features]]
    weight = row_weights * np.where(goal > 0.5, 0.5 / np.mean(goal > 0.5), 0.5 / np.mean(goal <= 0.5))
    weight = weight / weight.sum()
    w, bias, seen_w, seen_b = np.zeros(len(used)), 0.0, np.full(len(used), 1e-8), 1e-8
    for _ in range(steps):
        odds = np.bincount(rows, weights=w[places], minlength=len(goal)) + bias
        error = weight * (sigmoid(odds) - goal)
        grad = np.bincount(places, weights=error[rows], minlength=len(used)) + l2 * w
        seen_w += grad**2
        seen_b += error.sum() ** 2
        w -= rate * grad / np.sqrt(seen_w)
        bias -= rate * error.sum() / np.sqrt(seen_b)
    model.weights[used] = w
    model.bias = bias
    return model


def co_train(views: list[Sample], truth: np.ndarray, rounds: int = ROUNDS, sure: float = SURE) -> list[Linear]:
    """A calibrated classifier per view. ``truth`` has 0 or 1, and -1 where no label is known.

    A view is sure of a row if its calibrated probability is; pseudo-labels weigh half of a real one and are
    given anew in each round.
    """
    known = np.flatnonzero(truth >= 0)
    held = known[np.arange(len(known)) % HELD_OUT == 0] if len(known) >= 50 else known[:0]
    train = np.setdiff1d(known, held)
    free = np.flatnonzero(truth < 0)
    pseudo = [(free[:0], np.zeros(0)) for _ in views]
    models: list[Linear] = []
    for turn in range(rounds + 1):
        models, said = [], []
        for view, (rows, goals) in zip(views, pseudo):
            part = np.concatenate([train, rows])
            model = fit(view.take(part), np.concatenate([truth[train], goals]).astype(float), np.concatenate([np.ones(len(train)), np.full(len(rows), 0.5)]))
            if len(held):
                rest = view.take(held)
                model.calibrate(model.log_odds(rest.features, rest.firsts), truth[held].astype(float))
            models.append(model)
            if turn < rounds and len(free):
                rest = view.take(free)
                p = sigmoid(model.calibrated(rest.features, rest.firsts))
                chosen = (p >= sure) | (p <= 1 - sure)
                said.append((free[chosen], (p[chosen] >= 0.5).astype(float)))
        if said:
            pseudo = said[::-1]  # each view learns from the other's
    return models


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Batches with the text and metadata features of their rows, some rows at a time."""
    for batch in batches:
        meta, meta_firsts = meta_features(batch)
        for block in blocks(batch.column("text")):
            part = batch.slice(block.first_row, block.rows)
            span = meta_firsts[block.first_row : block.first_row + block.rows + 1]
            yield part, text_features(block), (meta[span[0] : span[-1]], span - span[0])


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), F.col("n_chars").cast("double").alias("n_chars"),
    )


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int, max_unlabelled: int) -> DataFrame:
    """A bounded sample: the labelled rows with the smallest hashes, and some of the other rows, with features.

    Of several labels of one document the strictest counts. Labels without a document, and null labels, are not used.
    """
    order = F.xxhash64("doc_id")
    strict = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    strict = strict.where("doc_id IS NOT NULL").orderBy(order, "doc_id").limit(max_labelled)
    others = (
        docs.select("doc_id").where("doc_id IS NOT NULL").join(labels.select("doc_id"), "doc_id", "left_anti")
        .orderBy(order, "doc_id").limit(max_unlabelled)
        .select("doc_id", F.lit(None).cast("long").alias("quality"), F.lit(None).cast("long").alias("toxic"))
    )
    chosen = strict.select("doc_id", F.col("quality").cast("long"), F.col("toxic").cast("long")).unionByName(others)
    # proven bound: max_labelled + max_unlabelled rows of three numbers
    rows = _inputs(docs).join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, quality long, toxic long, words binary, meta binary"

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (words, w), (meta, m) in _feature_rows(batches):
            lists = [
                pa.array([b.tobytes() for b in np.split(found.astype(np.int32), firsts[1:-1])], pa.binary())
                for found, firsts in ((words, w), (meta, m))
            ]
            columns = [part.column(n).cast(pa.int64()) for n in ("doc_id", "quality", "toxic")] + lists
            yield pa.record_batch(columns, names=["doc_id", "quality", "toxic", "words", "meta"])

    return rows.mapInArrow(features, schema)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_unlabelled: int = MAX_UNLABELLED) -> dict:
    """{target: [text model, metadata model]} for ``good`` (quality) and ``toxic``.

    Without labels of both kinds a target's models give a fixed answer: good, and not toxic.
    """
    rows = sorted(training_rows(docs, labels, max_labelled, max_unlabelled).collect(), key=lambda r: (r["doc_id"], r["words"]))
    views = [Sample([np.frombuffer(r[view], dtype=np.int32) for r in rows]) for view in ("words", "meta")]
    models = {}
    for target, column, otherwise in (("good", "quality", 1.0), ("toxic", "toxic", -1.0)):
        truth = np.array([-1 if r[column] is None else int(r[column] > 0) for r in rows], dtype=int)
        both = (truth == 0).any() and (truth == 1).any()
        models[target] = co_train(views, truth) if both else [Linear(bias=4.0 * otherwise), Linear(bias=0.0)]
    return models


def score(docs: DataFrame, models: dict) -> DataFrame:
    """Per document: doc_id, p_good, p_toxic, text_score, meta_score, quality_score, kept.

    kept is whether a document is more likely good than not, and more likely clean than toxic. Empty and null texts
    are scored by what is left of them.
    """
    schema = "doc_id long, text_score double, meta_score double, p_good double, p_toxic double, quality_score double, kept boolean"
    names = ["doc_id", "text_score", "meta_score", "p_good", "p_toxic", "quality_score", "kept"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (words, w), (meta, m) in _feature_rows(batches):
            odds, views = {}, {}
            for target in TARGETS:
                text_model, meta_model = models[target]
                by_text, by_meta = text_model.calibrated(words, w), meta_model.calibrated(meta, m)
                odds[target], views[target] = combine(by_text, by_meta), (sigmoid(by_text), sigmoid(by_meta))
            p = {target: sigmoid(odds[target]) for target in TARGETS}
            kept = (p["good"] >= 0.5) & (p["toxic"] < 0.5)
            columns = [*views["good"], p["good"], p["toxic"], p["good"] * (1 - p["toxic"])]
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, columns), pa.array(kept)], names=names)

    return _inputs(docs).mapInArrow(scored, schema)


def combine(by_text: np.ndarray, by_meta: np.ndarray) -> np.ndarray:
    """Calibrated log-odds of both views in one: the text speaks, the metadata decide where it is in doubt."""
    return by_text + 0.25 * by_meta * np.exp(-np.abs(by_text))


def quality_scores(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """Train on the labels and score every document: one row per row of ``docs``, see ``score``.

    Null and empty texts are scored by their metadata and what little the text view has; missing metadata
    are a value of their own. Repeated rows are scored alike, each with a row; a null doc_id stays null and is never trained on. No
    documents give no rows. Without labels of both kinds for a target every document is good, or not toxic. Ties at one half
    count as good, and as toxic. Other columns are not looked at.
    """
    return score(docs, train(docs, labels, **bounds))


def keep_good(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns. Rows without an identifier stay."""
    return without(docs, quality_scores(docs, labels, **bounds).where("NOT kept"))
