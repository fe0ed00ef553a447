"""Benchmark decontamination: n-gram seeds, then local alignment.

A document and a test item are compared where they share a run of three words. Around the shared
runs of one item a window of the document is cut, and Smith-Waterman alignment of item and window
gives a score: matches minus mismatches and gaps along the best local alignment. Edited and
paraphrased copies keep most of their score; text that shares a phrase by chance does not.

**Rare and frequent seeds.** How many documents hold each three-word run of the items is counted
exactly, over all documents. A run that at most ``COMMON`` of them hold is rare, and so is the rarest
of each item: a rare seed opens a comparison wherever it stands. Frequent ones, such as a turn of phrase,
open one only where two seeds of an item stand within the item's length; an edited copy that is
itself common is found by these.

**Scale.** Items are few and stated; they go to the tasks in blocks of at most ``BLOCK_WORDS`` words
on average, whatever their number, and each block is one pass over the documents. That pass counts
seeds, aligns what pairs of seeds open, and sets windows of single seeds aside until the counts are
known; these are few and stored. There is no shuffle of documents: a passage shared by a third of them costs
each task its own share. A stage that drops leaks joins documents with the digests of leaked texts,
a written table that Spark broadcasts only where it is small.

Before an alignment, the words that item and window have in common are counted; since the score
can't exceed twice that number, windows that can't reach the limit are left out without loss.

Items of fewer than ``SEED`` words cannot be told from ordinary phrases and match nothing. Null
text matches nothing; a null id, of a document or an item, is reported as null. Repeated documents are
reported as often as they occur, repeated items too. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.sources.workspace import written

SEED = 3
COMMON = 0.001
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the greatest score that makes a leak, and the item length from which it stops growing:
#: so many words of a longer item are a leak in themselves.
LIMIT, LONG = 0.6, 25
BLOCK_WORDS = 2_000_000

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Items(NamedTuple):
    """A block of test items: words as numbers, and their seeds."""

    ids: list[int]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    #: Sorted numbers of all seeds, and for each the items and places it occurs at.
    seeds: np.ndarray
    places: list[list[tuple[int, int]]]

    def numbers(self, text: str) -> np.ndarray:
        """Word numbers of a text; -1 for words that no item has."""
        find = self.vocabulary.get
        return np.array([find(w, -1) for w in words_of(text)], np.int64)

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of seeds in a text, and which they are."""
        if len(numbers) < SEED or not len(self.seeds):
            return np.zeros(0, int), np.zeros(0, int)
        known = numbers >= 0
        runs = known[:-2] & known[1:-1] & known[2:]
        at = np.flatnonzero(runs)
        key = self.keys(numbers[at], numbers[at + 1], numbers[at + 2])
        seed = np.minimum(np.searchsorted(self.seeds, key), len(self.seeds) - 1)
        same = self.seeds[seed] == key
        return at[same], seed[same]

    def keys(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a * len(self.vocabulary) + b) * len(self.vocabulary) + c


def build_items(rows: list[tuple[int, str]]) -> Items:
    """Numbers and seeds of a block. Three word numbers fit 63 bits up to two million words."""
    vocabulary: dict[str, int] = {}
    words = [
        np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64)
        for _, t in rows
    ]
    items = Items([i for i, _ in rows], words, vocabulary, np.zeros(0, np.int64), [])
    found: dict[int, list[tuple[int, int]]] = {}
    for item, w in enumerate(words):
        if len(w) >= SEED:
            for place, key in enumerate(items.keys(w[:-2], w[1:-1], w[2:]).tolist()):
                found.setdefault(key, []).append((item, place))
    seeds = np.array(sorted(found), np.int64)
    return items._replace(seeds=seeds, places=[found[k] for k in seeds.tolist()])


def rare_of(items: Items, counts: np.ndarray, n_docs: int, common: float = COMMON) -> np.ndarray:
    """Which seeds are rare, given the number of documents that hold each: few, or an item's fewest."""
    rare = counts <= max(1.0, common * n_docs)
    rarest: dict[int, int] = {}
    for seed, places in enumerate(items.places):
        for item, _ in places:
            if item not in rarest or counts[seed] < counts[rarest[item]]:
                rarest[item] = seed
    rare[list(rarest.values())] = True
    return rare


def rare_seeds(docs: DataFrame, items: Items, common: float = COMMON) -> np.ndarray:
    """Rare seeds among documents."""
    return Block(docs, items, common).rare


def best_alignment(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment, and the end of it in the window.

    A row at a time; gaps along a row are a running maximum.
    """
    slope = -GAP * np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.zeros_like(row)
        step[1:] = np.maximum(row[:-1] + np.where(window == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def limit_of(n_words: int) -> float:
    """Score from which a window holds a leak of an item of so many words."""
    return LIMIT * MATCH * min(n_words, LONG)


class Window(NamedTuple):
    """Words of a text round seeds of an item, from word ``first`` on."""

    item: int
    first: int
    words: np.ndarray
    #: The seeds in it; None where two stand close enough to open it.
    alone: list[int] | None


def windows_in(items: Items, numbers: np.ndarray, at: np.ndarray, seed: np.ndarray) -> Iterator[Window]:
    """Windows that share enough words with an item to reach its limit."""
    by_item: dict[int, list[tuple[int, int]]] = {}
    for p, s in zip(at.tolist(), seed.tolist(), strict=True):
        for item, _ in items.places[s]:
            of = by_item.setdefault(item, [])
            if not of or of[-1][0] != p:
                of.append((p, s))
    for item, hits in by_item.items():
        words = items.words[item]
        n, limit = len(words), limit_of(len(words))
        own, times = np.unique(words, return_counts=True)
        places = np.array([p for p, _ in hits])
        cuts = np.flatnonzero(np.diff(places) > 2 * n) + 1
        for group in np.split(np.arange(len(hits)), cuts):
            first = max(0, int(places[group[0]]) - n)
            window = numbers[first : int(places[group[-1]]) + SEED + n]
            place = np.minimum(np.searchsorted(own, window), len(own) - 1)
            place = place[own[place] == window]
            shared = np.minimum(np.bincount(place, minlength=len(own)), times).sum()
            if MATCH * shared < limit:
                continue
            close = len(group) > 1 and int(np.diff(places[group]).min()) <= n
            yield Window(item, first, window, None if close else [hits[k][1] for k in group])


def leak_in(items: Items, window: Window) -> tuple[int, int, int] | None:
    """``score, first word, end`` of the best alignment of a window, if it is a leak."""
    words = items.words[window.item]
    score, end = best_alignment(words, window.words)
    if score < limit_of(len(words)):
        return None
    _, length = best_alignment(words[::-1], window.words[:end][::-1])
    return score, window.first + end - length, window.first + end


SCHEMA = "doc_id long, item_id long, score long, share double, first_word long, end_word long"
_FOUND = "row long, doc_id long, digest string, item int, score long, first_word long, end_word long"
#: What one pass leaves: counts of seeds, leaks, and windows of single seeds.
_PASS = f"seed long, n long, {_FOUND}, words array<long>, alone array<long>"
_DOCUMENTS = -1
#: Of a text's digest, so that the table of leaked texts stays small enough to be sent for longer.
_DIGEST_DIGITS = 32


def _arrow(schema: str, rows: list[dict]) -> pa.RecordBatch | None:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
             "array<long>": pa.list_(pa.int64())}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields],
        names=[name for name, _ in fields],
    )


class Block:
    """One block of items against all documents."""

    def __init__(self, docs: DataFrame, items: Items, common: float = COMMON) -> None:
        self.items = items
        self.sent = docs.sparkSession.sparkContext.broadcast(items)
        self.passed = written(self._pass(docs), "decontamination")
        counted = self.passed.where("seed IS NOT NULL").groupBy("seed").agg(F.sum("n").alias("n"))
        # One row for each seed of the block comes back, as the items themselves did.
        found = {r["seed"]: r["n"] for r in counted.collect()}
        counts = np.array([found.get(s, 0) for s in range(len(items.seeds))], np.int64)
        self.rare = rare_of(items, counts, found.get(_DOCUMENTS, 0), common)

    def _pass(self, docs: DataFrame) -> DataFrame:
        sent = self.sent

        def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
            items = sent.value

            def run(batch: pa.RecordBatch) -> pa.RecordBatch:
                counts = np.zeros(len(items.seeds), np.int64)
                rows: list[dict] = []
                for place, text in enumerate(texts_of(batch)):
                    numbers = items.numbers(text)
                    at, seed = items.hits(numbers)
                    if not len(at):
                        continue
                    counts[np.unique(seed)] += 1
                    known = {
                        name: batch.column(name)[place].as_py() for name in ("row", "doc_id", "digest")
                    }
                    for window in windows_in(items, numbers, at, seed):
                        if window.alone is not None:
                            rows.append(known | {
                                "item": window.item, "first_word": window.first,
                                "words": window.words.tolist(), "alone": window.alone,
                            })
                        elif (leak := leak_in(items, window)) is not None:
                            rows.append(known | _named(window.item, leak))
                some = np.flatnonzero(counts).tolist()
                rows += [{"seed": s, "n": int(counts[s])} for s in some]
                return _arrow(_PASS, [*rows, {"seed": _DOCUMENTS, "n": batch.num_rows}])

            return run

        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        typed = docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
            F.sha2(text, 256).alias("digest"), text.alias("text"),
        )
        return map_batches(typed, make, _PASS)

    def leaks(self) -> DataFrame:
        """``_FOUND``: the best window of each leaked item of each document."""
        sent, rare = self.sent, self.rare

        def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
            items = sent.value

            def run(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = []
                for row in batch.to_pylist():
                    if not rare[row["alone"]].any():
                        continue
                    words = np.array(row["words"], np.int64)
                    window = Window(row["item"], row["first_word"], words, row["alone"])
                    if (leak := leak_in(items, window)) is not None:
                        rows.append(row | _named(window.item, leak))
                return _arrow(_FOUND, rows)

            return run

        names = [part.split()[0] for part in _FOUND.split(", ")]
        waiting = self.passed.where("alone IS NOT NULL").select(*names, "words", "alone")
        found = self.passed.where("score IS NOT NULL").select(*names)
        both = found.unionByName(map_batches(waiting, make, _FOUND))
        best = both.groupBy("row", "item").agg(
            F.max_by(F.struct(*names), F.struct("score", -F.col("first_word"))).alias("b")
        )
        return best.select("b.*")


def _named(item: int, leak: tuple[int, int, int]) -> dict:
    return {"item": item, "score": leak[0], "first_word": leak[1], "end_word": leak[2]}


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, score, share, first_word, end_word``, a row for each leaked item.

    ``share`` is the score over that of a full copy; words are counted from zero, end exclusive.
    """
    out = None
    for items in item_blocks(benchmark, block_words):
        found = _with_items(Block(docs, items).leaks(), items)
        out = found if out is None else out.unionByName(found)
    return out


def _with_items(leaks: DataFrame, items: Items) -> DataFrame:
    ids, sizes = items.ids, [len(w) for w in items.words]

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _arrow(SCHEMA, [
                r | {"item_id": ids[r["item"]], "share": r["score"] / (MATCH * sizes[r["item"]])}
                for r in batch.to_pylist()
            ])

        return run

    return map_batches(leaks, make, SCHEMA)


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The test items in blocks of bounded size; at least one, which may be empty."""
    tests = benchmark.select(
        F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    # Sizes before anything is sent: white space bounds the number of words well enough.
    total = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * block_words)))
    for block in range(blocks):
        some = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r.item_id, r.text) for r in some.collect()]
        yield build_items(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns.

    Whether a row leaks depends on its text alone, so rows whose text has the digest of a leaked one go.
    """
    leaked = None
    for items in item_blocks(benchmark, block_words):
        found = Block(docs, items).leaks().select("digest")
        leaked = found if leaked is None else leaked.unionByName(found)
    short = F.unhex(F.left("digest", F.lit(_DIGEST_DIGITS))).alias("leaked")
    leaked = written(leaked.select(short).distinct(), "leaked-texts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.left(F.sha2(text, 256), F.lit(_DIGEST_DIGITS)))
    return docs.join(leaked, digest == F.col("leaked"), "left_anti")
