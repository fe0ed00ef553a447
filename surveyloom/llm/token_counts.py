"""Token counts without tokens: byte-pair merging with a heap over a linked list.

The adjacent pair of lowest rank is popped, its two symbols become one, and the pairs with the new
neighbours are pushed. Each merge takes one symbol away, so the count of a piece is its symbols
minus its merges; no token identifier is ever built.

A null text counts as empty and has no tokens. Special strings inside a text count as one token
each, as the library has it. A row with a null id is counted like any other; repeated rows give
repeated results. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.llm.word_vocabulary import read_vocabulary_file, vocabulary

LIMIT = 2048
#: Words and pieces whose counts a worker remembers, and their greatest length. Words come back by Zipf's
#: law, so those met first are those met often; the others are merged again each time.
REMEMBERED_WORDS = 400_000
REMEMBERED_PIECES = 700_000
REMEMBERED_LENGTH = 40
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document."""
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary_file(path))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        count = piece_counter(content.value)

        def batch_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            n_tokens = [count(t) for t in texts]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return batch_counts

    return map_batches(docs.select("doc_id", "text"), make, SCHEMA)


def merges_made(symbols: list[int], rules: dict[int, int]) -> int:
    """How many merges a piece takes; ``symbols`` is used up.

    ``rules`` maps ``left << 20 | right`` to ``rank << 20 | merged``. A heap entry is a rule and
    the place of its left symbol in one integer, so the lowest rank comes first, leftmost first.
    """
    n = len(symbols)
    bits = n.bit_length()
    find = rules.get
    heap = []
    for at in range(n - 1):
        rule = find(symbols[at] << 20 | symbols[at + 1])
        if rule is not None:
            heap.append(rule << bits | at)
    if not heap:
        return 0
    heapify(heap)
    place = (1 << bits) - 1
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    made = 0
    while heap:
        entry = heappop(heap)
        at, rule = entry & place, entry >> bits
        after, symbol = right[at], symbols[at]
        # Stale if either symbol was merged meanwhile; a place that was merged away holds -1.
        if symbol < 0 or after >= n or find(symbol << 20 | symbols[after]) != rule:
            continue
        merged = rule & 0xFFFFF
        symbols[at], symbols[after] = merged, -1
        made += 1
        after, before = right[after], left[at]
        right[at] = after
        if after < n:
            left[after] = at
            rule = find(merged << 20 | symbols[after])
            if rule is not None:
                heappush(heap, rule << bits | at)
        if before >= 0:
            rule = find(symbols[before] << 20 | merged)
            if rule is not None:
                heappush(heap, rule << bits | before)
    return made


@lru_cache(maxsize=4)
def piece_counter(content: str) -> Callable[[str], int]:
    """The counting function of a vocabulary; one for each Python worker, with its memory."""
    words_of = vocabulary(content)
    ids = words_of.ids
    rules = {
        ids[a] << 20 | ids[b]: rank << 20 | ids[a + b] for rank, (a, b) in enumerate(words_of.merges)
    }
    known: dict[str, int] = dict.fromkeys(words_of.special, 1)
    known_pieces: dict[str, int] = {}

    def of_piece(piece: str) -> int:
        symbols = words_of.symbols(piece)
        count = len(symbols) - merges_made(symbols, rules)
        if len(known_pieces) < REMEMBERED_PIECES and len(piece) <= REMEMBERED_LENGTH:
            known_pieces[piece] = count
        return count

    def of_word(word: str) -> int:
        count = 0
        for piece in words_of.pieces(word):
            count += known_pieces.get(piece) or of_piece(piece)
        if len(known) < REMEMBERED_WORDS and len(word) <= REMEMBERED_LENGTH:
            known[word] = count
        return count

    def of_text(text: str) -> int:
        return sum([known.get(w) or of_word(w) for w in words_of.words(text)])

    return of_text
