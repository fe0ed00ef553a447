"""SimHash near-duplicates by anchor-point covering.

A fingerprint is the bitwise majority of the hashes of a text's word shingles. Two texts are linked
where their fingerprints differ in at most ``THRESHOLD`` bits, and a component is what links reach.

**Anchors.** The 64 bits are cut into three blocks. Two fingerprints within four bits differ in at
most one bit in some block, so the search is done for each block with a threshold of one. Anchors
are the words of a covering code: in fifteen bits of the block the Hamming code, which has a word
within one bit of anything, the other bits as they are. A fingerprint has its home at its nearest
anchor and is replicated to every anchor within covering radius plus threshold, two bits. If two
fingerprints differ in one bit of the block, the home of either is within two bits of the other, so
they meet there. Each replica costs one short row, some 45 for a fingerprint in all.

**Comparison.** Equal fingerprints are one node from the start, so thousands of exact copies are one
row here. At an anchor, homes are compared with all that came. Small groups are compared at once;
in a larger one a search spreads from linked to unlinked rows, so a dense group of near copies costs
about one comparison a row and gives one link a row, not one for each pair. Anchors with very many
homes are dealt to several tasks, which share the homes out and each get all replicas.

A text of fewer than four words has one shingle, the whole; one without words has fingerprint zero
and is linked like any other. Null text counts as no words. Rows with a null id take part, but
cannot name a component: its id is the least that is not null, or null where there is none.
Repeated rows are repeated in the result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.llm.components import star_roots
from surveyloom.sources.workspace import written

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: First bit and width of each block; one of them holds at most a third of all differences.
BLOCKS = ((0, 21), (21, 21), (42, 22))
BLOCK_THRESHOLD = THRESHOLD // len(BLOCKS)
CODED = 15
RADIUS = 1
#: Homes of one anchor that a task compares; an anchor with more is dealt to several.
HOMES = 16_384
#: Rows of an anchor up to which all comparisons are made at once.
SMALL = 48
_AT_ONCE = 200_000
_PAIRS = 2_000_000


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The fingerprint of a text, as an unsigned integer."""
    # On bytes, lower() touches A-Z alone and split() cuts at blank, tab, line feed, VT, FF and CR.
    words = text.encode().lower().split()
    n = len(words) - size + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: n - 1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[a:b], SEED)
        for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    ]
    counts = np.zeros(64, np.int64)
    for first in range(0, n, 50_000):
        part = np.array(hashes[first : first + 50_000], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, more: Mapping[str, Column] | None = None) -> DataFrame:
    """``doc_id, fp`` with the fingerprint as a signed integer, and more columns of text if asked."""
    names = list(more or {})

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64)),
                 *[batch.column(name) for name in names]],
                names=["doc_id", "fp", *names],
            )

        return run

    typed = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"),
        *[column.alias(name) for name, column in (more or {}).items()],
    )
    schema = ", ".join(["doc_id long, fp long", *[f"{name} string" for name in names]])
    return map_batches(typed, make, schema)


def code_masks(width: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Syndromes of all coded parts; for each syndrome the flips to anchors, and the one to home.

    The flips lead to every anchor within ``RADIUS + BLOCK_THRESHOLD`` bits. Column k of the
    parity check is k + 1, so the syndrome of a word is the sum of its bit numbers without carry.
    """
    syndrome = np.zeros(1 << CODED, np.uint8)
    words = np.arange(1 << CODED)
    for bit in range(CODED):
        syndrome ^= np.where(words >> bit & 1, bit + 1, 0).astype(np.uint8)
    within = RADIUS + BLOCK_THRESHOLD
    coded: list[list[tuple[int, int]]] = [[] for _ in range(CODED + 1)]
    for weight in range(within + 1):
        for bits in combinations(range(CODED), weight):
            mask = sum(1 << b for b in bits)
            coded[syndrome[mask]].append((mask, weight))
    free = [
        (sum(1 << (CODED + b) for b in bits), weight)
        for weight in range(within + 1)
        for bits in combinations(range(width - CODED), weight)
    ]
    flips = [
        np.array([m | f for m, v in of for f, w in free if v + w <= within], np.int64)
        for of in coded
    ]
    home = np.array([0, *[1 << (s - 1) for s in range(1, CODED + 1)]], np.int64)
    return syndrome, flips, home


def to_anchors(nodes: DataFrame) -> DataFrame:
    """``anchor, home, fp``: every fingerprint at every anchor it is replicated to."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        tables = {width: code_masks(width) for _, width in BLOCKS}

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = batch.column("fp").to_numpy()
            anchors, homes, rows = [], [], []
            for number, (first, width) in enumerate(BLOCKS):
                syndrome, flips, home = tables[width]
                block = (fps >> first) & ((1 << width) - 1)
                kind = syndrome[block & ((1 << CODED) - 1)]
                for s in range(CODED + 1):
                    own = kind == s
                    if not own.any():
                        continue
                    at = (block[own][:, None] ^ flips[s]) | (number << 40)
                    anchors.append(at.ravel())
                    homes.append(np.broadcast_to(flips[s] == home[s], at.shape).ravel())
                    rows.append(np.broadcast_to(fps[own][:, None], at.shape).ravel())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(anchors)), pa.array(np.concatenate(homes)),
                 pa.array(np.concatenate(rows))],
                names=["anchor", "home", "fp"],
            )

        return run

    return map_batches(nodes.select("fp"), make, "anchor long, home boolean, fp long")


def _share_out(placed: DataFrame) -> DataFrame:
    """Adds ``part``: homes of a crowded anchor go to one part each, replicas to all."""
    crowded = (
        placed.groupBy(F.col("anchor").alias("crowd"))
        .agg(F.count_if("home").alias("homes"))
        .where(F.col("homes") > HOMES)
        .select("crowd", F.ceil(F.col("homes") / HOMES).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    return placed.join(crowded, F.col("anchor") == F.col("crowd"), "left").select(
        "anchor", F.explode(parts).alias("part"), own.alias("own"), "home", "fp"
    ).select(
        "anchor", "part", (F.col("home") & (F.col("own") == F.col("part"))).alias("home"), "fp"
    )


def _links(homes: np.ndarray, fps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Links of small groups: each home against all rows of its group."""
    group_of = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.flatnonzero(homes)
    lengths = (ends - starts)[group_of[at]]
    out = []
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(_PAIRS, lengths.sum() + _PAIRS, _PAIRS))
    for some in np.split(np.arange(len(at)), np.unique(cuts)):
        if not len(some):
            continue
        n = lengths[some]
        left = np.repeat(at[some], n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        right = np.repeat(starts[group_of[at[some]]], n) + within
        near = np.bitwise_count((fps[left] ^ fps[right]).view(np.uint64)) <= THRESHOLD
        near &= left != right
        out.append(np.stack([fps[left[near]], fps[right[near]]]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def _forest(homes: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links of one large group that connect what its links connect, one for each row at most.

    Only homes link, so a search starts from homes alone, and a row that is none looks for homes
    alone: comparisons are those between homes and all rows.
    """
    left, right = [], []
    bits = fps.view(np.uint64)
    own, others = np.flatnonzero(homes), np.flatnonzero(~homes)
    while len(own):
        todo, own = [own[0]], own[1:]
        while todo and (len(own) or len(others)):
            row = todo.pop()
            near = np.bitwise_count(bits[own] ^ bits[row]) <= THRESHOLD
            found, own = own[near], own[~near]
            if homes[row]:
                near = np.bitwise_count(bits[others] ^ bits[row]) <= THRESHOLD
                found, others = np.concatenate([found, others[near]]), others[~near]
            if len(found):
                left.append(np.full(len(found), fps[row]))
                right.append(fps[found])
                todo += found.tolist()
    if not left:
        return np.zeros((2, 0), np.int64)
    return np.stack([np.concatenate(left), np.concatenate(right)])


def near_links(nodes: DataFrame) -> DataFrame:
    """``a, b``: links that connect exactly what all links within the threshold connect."""
    placed = _share_out(to_anchors(nodes))
    by_anchor = placed.repartition("anchor", "part").sortWithinPartitions("anchor", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(columns: list[np.ndarray]) -> pa.RecordBatch:
            anchor, part, homes, fps = columns
            edges = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
            starts = np.concatenate([[0], edges])
            ends = np.concatenate([edges, [len(fps)]])
            small = ends - starts <= SMALL
            rows = np.repeat(small, ends - starts)
            lengths = (ends - starts)[small]
            new_ends = np.cumsum(lengths)
            found = [_links(homes[rows], fps[rows], new_ends - lengths, new_ends)]
            for s, e in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
                found.append(_forest(homes[s:e], fps[s:e]))
            a, b = np.concatenate(found, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            size += batch.num_rows
            if size < _AT_ONCE:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            anchor, part = columns[0], columns[1]
            # The last group may go on in the next batch.
            whole = np.flatnonzero((anchor != anchor[-1]) | (part != part[-1]))
            cut = int(whole[-1]) + 1 if len(whole) else 0
            if cut:
                yield compared([c[:cut] for c in columns])
            held, size = [[c[cut:] for c in columns]], len(anchor) - cut
        if size:
            yield compared([np.concatenate(c) for c in zip(*held, strict=True)])

    return by_anchor.mapInArrow(run, "a long, b long")


def _classified(hashed: DataFrame) -> DataFrame:
    """Columns of ``doc_id, fp, ...`` with ``root``, the component's, and ``component_id``."""
    nodes = hashed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = star_roots(near_links(nodes))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy(F.col("root").alias("named")).agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, F.col("root") == F.col("named")).select(
        F.col("fp").alias("class_fp"), "root", "component_id"
    )
    return hashed.join(classes, F.col("fp") == F.col("class_fp"), "left").drop("class_fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document."""
    return _classified(written(fingerprints(docs), "fingerprints")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the least id.

    The row is told by its id and a digest of its text, so of different texts under one id each keeps
    the place it has in its own component. Rows that repeat both are the same document and one of
    them stays. Rows without an id cannot be told from their copies by it, and stay.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    found = _classified(written(fingerprints(docs, {"digest": digest}), "fingerprints"))
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    one = found.where(F.col("doc_id").isNotNull()).groupBy("root").agg(first)
    kept = written(
        one.select(F.col("first.doc_id").alias("kept_id"), F.col("first.digest").alias("kept_digest"))
        .distinct(),
        "kept-ids",
    )
    # The digest under a name that no column of the documents can have.
    name = "digest_" + uuid.uuid4().hex
    with_id = docs.where(F.col("doc_id").isNotNull()).withColumn(name, digest)
    same = (with_id["doc_id"] == kept["kept_id"]) & (F.col(name) == kept["kept_digest"])
    # The join deals rows by id and digest already, so dropping repeats takes no further shuffle.
    rows = with_id.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))
