"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text go through trees that were grown on labelled documents. Feature values
are put into quantile bins once, each level of a tree is grown from one histogram of gradients, and
the finished trees are flattened into arrays: all rows of a batch walk down all trees at once by
indexing. Only the text enters a score, never labels, language, source or id.

**Training rows** are those with a label and a remainder of crc32(doc_id) mod 4 other than 2. At
most ``TRAINING_ROWS`` of them are used, those with the least hash of their id; this bound is the
only thing that does not grow with the input. Scoring covers every document.

Null text scores as empty text. Null ids count as not held out and are never trained on. Labels
other than 0 and 1 are ignored. Repeated labels or documents count as often as they occur. With no
labels, or only one class of them, the score is the smoothed share of label 1 everywhere. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.llm.quality_rules import repeated_words, words_of

TRAINING_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
LEARNING_RATE, PENALTY = 0.15, 1.0
#: Least weight of a leaf: so much, or this share of all weight where the labelled rows are few.
LEAST_WEIGHT, LEAST_SHARE = 4.0, 0.02
CUTOFF = 0.7

FEATURES = (
    "log_words", "log_chars", "mean_word", "sd_word", "distinct_words", "repeated_next",
    "repeated_windows", "repeated_lines", "mean_line", "upper", "lower", "digits", "symbols",
    "exclamation", "points", "other_punctuation", "beyond_ascii", "words_with_symbol",
)


def _bytes_in(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_CLASSES = [
    _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_in("abcdefghijklmnopqrstuvwxyz"),
    _bytes_in("0123456789"), _bytes_in("#*$%&|<>"), _bytes_in("!"), _bytes_in(".,"),
    _bytes_in("?;:'\"()[]{}-_/\\+=@~^`"), np.arange(256) >= 128,
]
_CLASS_TABLE = np.array(_CLASSES, float)


def statistics(text: str) -> list[float]:
    """The features of a text, in the order of ``FEATURES``."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    shares = _CLASS_TABLE @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lengths = np.fromiter(map(len, words), np.int32, n)
    lines = [line for line in text.split("\n") if line.strip()]
    marked = sum([not (w[-1].isalnum() or w[-1] in ".,") for w in words])
    return [
        float(np.log(n)), float(np.log(len(text))), float(lengths.mean()), float(lengths.std()),
        len(set(words)) / n, sum(map(str.__eq__, words, words[1:])) / n,
        repeated_words(words) / n, 1 - len(set(lines)) / max(len(lines), 1),
        float(np.log1p(n / max(len(lines), 1))), *shares.tolist(), marked / n,
    ]


class Trees(NamedTuple):
    """Flattened complete trees: node k of a tree has children 2k+1 and 2k+2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        if len(self.feature) and len(x):
            trees = np.arange(len(self.feature))
            rows = np.arange(len(x))[:, None]
            at = np.zeros((len(x), len(trees)), np.int64)
            inner = self.feature.shape[1]
            for _ in range(DEPTH):
                above = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
                at = 2 * at + 1 + above
            total = total + self.leaf[trees, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for logistic loss."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    nodes, leaves = 2**DEPTH - 1, 2**DEPTH
    empty = Trees(np.zeros((0, nodes), int), np.zeros((0, nodes)), np.zeros((0, leaves)), base)
    if n == 0 or y.min() == y.max():
        return empty
    n_features = x.shape[1]
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0, method="lower").T
    binned = np.stack(
        [np.searchsorted(edges[f], x[:, f], side="left") for f in range(n_features)], axis=1
    )
    place = np.arange(n_features) * BINS + binned
    score = np.full(n, base)
    least = min(LEAST_WEIGHT, LEAST_SHARE * n * share * (1 - share))
    feature = np.zeros((TREES, nodes), int)
    threshold = np.full((TREES, nodes), np.inf)
    leaf = np.zeros((TREES, leaves))
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = y - p, p * (1 - p)
        at = np.zeros(n, int)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            flat = ((at - first)[:, None] * (n_features * BINS) + place).ravel()
            size = width * n_features * BINS
            g, h = (
                np.bincount(flat, np.repeat(v, n_features), size)
                .reshape(width, n_features, BINS).cumsum(axis=2)
                for v in (gradient, hessian)
            )
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = (
                g**2 / (h + PENALTY)
                + (whole_g - g) ** 2 / (whole_h - h + PENALTY)
                - whole_g**2 / (whole_h + PENALTY)
            )[:, :, :-1]
            gain[(h < least)[:, :, :-1] | ((whole_h - h) < least)[:, :, :-1]] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            split_feature, split_bin = np.divmod(best, BINS - 1)
            feature[tree, first : first + width] = np.where(good, split_feature, 0)
            threshold[tree, first : first + width] = np.where(
                good, edges[split_feature, np.minimum(split_bin, BINS - 2)], np.inf
            )
            value = x[np.arange(n), feature[tree, at]]
            at = 2 * at + 1 + (value > threshold[tree, at])
        g = np.bincount(at - nodes, gradient, leaves)
        h = np.bincount(at - nodes, hessian, leaves)
        leaf[tree] = LEARNING_RATE * g / (h + PENALTY)
        score = score + leaf[tree, at - nodes]
    return Trees(feature, threshold, leaf, base)


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: a remainder of 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled documents, in a fixed order."""
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int")
    )
    chosen = usable.where(F.col("labelled").isNotNull()).orderBy(
        F.xxhash64("labelled"), "labelled", "quality"
    ).limit(rows)
    # At most ``rows`` pairs of an id and a label are sent to the tasks.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("labelled")
    )

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [statistics(t) for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.list_(pa.float64()))],
                names=["doc_id", "quality", "x"],
            )

        return run

    schema = "doc_id long, quality int, x array<double>"
    found = map_batches(texts.select("doc_id", "text", "quality"), make, schema).collect()
    found.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    x = np.array([r.x for r in found], float).reshape(len(found), len(FEATURES))
    return x, np.array([r.quality for r in found], float)


def score_documents(
    docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, cutoff: float = CUTOFF
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    trees = grow_trees(*training_sample(docs, labels, rows))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([statistics(t) for t in texts_of(batch)], float)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(trees.scores(x))], names=["doc_id", "score"]
            )

        return run

    scored = map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        make, "doc_id long, score double",
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cutoff).cast("int").alias("predicted"),
    )
