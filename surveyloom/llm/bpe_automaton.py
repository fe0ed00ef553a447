"""Byte-pair encoding and decoding by a deterministic automaton over tokens.

The automaton accepts exactly those token sequences that the merges produce. It starts with one
state for each symbol and an arc from every state on every symbol. Each merge ``u v -> w``, in rank
order, then puts in its gadget: where ``u`` may be followed by ``v``, the state behind ``w`` starts
as a copy of the state behind ``v``; the state behind ``u`` loses its arc on ``v``; and every state
with an arc on ``u`` gets one on ``w``. Since all arcs with one label lead to one state, the whole
machine is a bit table, states by labels. Tokens that end a word need no state: nothing follows.

A word is encoded by following table transitions from each reached position: for each end position
there is exactly one last token whose arc exists, so the path is unique and found without
searching. Decoding emits the labels of the arcs, joined by blanks as the library's decoder does
for a file that names no decoder.

A null text is empty: no tokens, the digests of nothing. Special strings inside a text are one
token each. Null ids, repeated rows and other columns are passed over or through unchanged.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.llm.word_vocabulary import WordVocabulary, read_vocabulary_file, vocabulary

#: Words and pieces whose encoding a worker remembers, and their greatest length.
REMEMBERED_WORDS = 120_000
REMEMBERED_PIECES = 200_000
REMEMBERED_LENGTH = 40


class Automaton(NamedTuple):
    """A compiled automaton.

    Bit ``column_of[label]`` of row ``state_of[token]`` says that the arc with this label leaves the
    state behind this token. Equal rows and equal columns are kept once.
    """

    content: str
    state_of: np.ndarray
    column_of: np.ndarray
    arcs: bytes
    width: int


def compile_automaton(content: str) -> Automaton:
    """Apply all merge gadgets, in rank order, to the one-symbol automaton."""
    vocab = WordVocabulary(content)
    ids, suffix = vocab.ids, vocab.suffix
    n_labels = max(ids.values()) + 1
    made = {a + b for a, b in vocab.merges}
    if len(made) != len(vocab.merges):
        raise ValueError("two merges give the same token")
    inner = [s for s in ids if not s.endswith(suffix)]
    state_of = np.full(n_labels, -1, np.int32)
    start = [s for s in ids if s not in made]
    first = [s for s in inner if s not in made]
    state_of[[ids[s] for s in first]] = np.arange(len(first))
    width = (n_labels + 7) // 8
    arcs = np.zeros((len(inner), width), np.uint8)
    for s in start:
        arcs[: len(first), ids[s] >> 3] |= np.uint8(1 << (ids[s] & 7))
    states = len(first)
    for a, b in vocab.merges:
        u, v, w = ids[a], ids[b], ids[a + b]
        behind_u = state_of[u]
        follows = arcs[behind_u, v >> 3] >> (v & 7) & 1
        if not (a + b).endswith(suffix):
            state_of[w] = states
            if follows:
                arcs[states] = arcs[state_of[v]]
            states += 1
        if not follows:
            continue  # u and v never stand side by side any more, so w never arises
        arcs[behind_u, v >> 3] &= np.uint8(0xFF ^ (1 << (v & 7)))
        has_u = arcs[:states, u >> 3] >> np.uint8(u & 7) & np.uint8(1)
        arcs[:states, w >> 3] |= has_u << np.uint8(w & 7)
    return _merge_equal(content, state_of, arcs)


def _merge_equal(content: str, state_of: np.ndarray, arcs: np.ndarray) -> Automaton:
    """Make states with the same arcs one, and labels with arcs from the same states one."""
    rows: dict[bytes, int] = {}
    row_of = np.array([rows.setdefault(sha256(r).digest(), len(rows)) for r in arcs])
    table = arcs[np.unique(row_of, return_index=True)[1]]
    columns: dict[bytes, int] = {}
    column_of = np.zeros(table.shape[1] * 8, np.int32)
    for eight in range(table.shape[1]):
        bits = np.unpackbits(table[:, eight : eight + 1], axis=1, bitorder="little")
        packed = np.packbits(bits, axis=0)
        for k in range(8):
            column = columns.setdefault(packed[:, k].tobytes(), len(columns))
            column_of[8 * eight + k] = column
    width = (len(columns) + 7) // 8
    small = np.zeros((len(rows), width), np.uint8)
    for packed, column in columns.items():
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))[: len(rows)]
        small[:, column >> 3] |= bits << np.uint8(column & 7)
    merged = np.where(state_of >= 0, row_of[np.maximum(state_of, 0)], -1)
    return Automaton(content, merged, column_of[: len(state_of)], small.tobytes(), width)


class Encoder:
    """Encodes words with an automaton and remembers them."""

    def __init__(self, machine: Automaton) -> None:
        self.vocab = vocabulary(machine.content)
        self.ids = self.vocab.ids
        self.state_of = machine.state_of.tolist()
        self.arcs = machine.arcs
        self.width = machine.width
        self.spelled = self._spelling_tree(machine)
        self.known_pieces: dict[str, tuple[bytes, str]] = {}
        self.known: dict[str, tuple[bytes, str]] = {
            s: (struct.pack("<I", i), s) for s, i in self.vocab.special.items()
        }

    def _spelling_tree(self, machine: Automaton) -> dict:
        """Characters to subtree, token and its column, and the same of a token that ends a piece.

        A token is -1 where there is none.

        Tokens without an arc from any state are left out: no encoding holds them.
        """
        table = np.frombuffer(machine.arcs, np.uint8).reshape(-1, machine.width)
        used = np.unpackbits(np.bitwise_or.reduce(table, axis=0), bitorder="little")
        columns = machine.column_of.tolist()
        used = used[machine.column_of].tolist()
        suffix, tree = self.vocab.suffix, {}
        for token, identifier in self.ids.items():
            if not used[identifier]:
                continue
            final = token.endswith(suffix)
            spelled = token.removesuffix(suffix) if final else token
            level = tree
            for c in spelled[:-1]:
                level = level.setdefault(c, [{}, -1, 0, -1, 0])[0]
            at = 3 if final else 1
            entry = level.setdefault(spelled[-1], [{}, -1, 0, -1, 0])
            entry[at : at + 2] = identifier, columns[identifier]
        return tree

    def piece(self, piece: str) -> list[int]:
        """Tokens of a piece: from each position follow the arcs that its state has."""
        arcs, width, state_of, tree = self.arcs, self.width, self.state_of, self.spelled
        n = len(piece)
        last, origin, row = [0] * (n + 1), [0] * (n + 1), 0
        for begin in range(n):
            if begin:
                row = state_of[last[begin]] * width
            level = tree
            for end in range(begin, n):
                found = level.get(piece[end])
                if found is None:
                    break
                level, token, column, closing, closing_column = found
                if end == n - 1:
                    token, column = closing, closing_column
                # In the first state every token can be read that arises at all.
                if token >= 0 and (not begin or arcs[row + (column >> 3)] >> (column & 7) & 1):
                    last[end + 1], origin[end + 1] = token, begin
        out, at = [], n
        while at:
            out.append(last[at])
            at = origin[at]
        return out[::-1]

    def word(self, word: str) -> tuple[bytes, str]:
        """The tokens of a word as packed identifiers, and its labels joined by blanks."""
        pieces = self.known_pieces
        found = [pieces.get(p) or self._new_piece(p) for p in self.vocab.pieces(word)]
        out = b"".join([f[0] for f in found]), " ".join([f[1] for f in found])
        if len(self.known) < REMEMBERED_WORDS and len(word) <= REMEMBERED_LENGTH:
            self.known[word] = out
        return out

    def _new_piece(self, piece: str) -> tuple[bytes, str]:
        tokens = self.piece(piece)
        labels = self.vocab.labels
        out = struct.pack(f"<{len(tokens)}I", *tokens), " ".join([labels[t] for t in tokens])
        if len(self.known_pieces) < REMEMBERED_PIECES and len(piece) <= REMEMBERED_LENGTH:
            self.known_pieces[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """Identifiers of a text, little-endian unsigned 32-bit integers."""
        known, word = self.known, self.word
        return b"".join([(known.get(w) or word(w))[0] for w in self.vocab.words(text)])

    def both(self, text: str) -> tuple[bytes, str]:
        """Identifiers of a text, and the labels that decoding them emits."""
        known, word = self.known, self.word
        found = [known.get(w) or word(w) for w in self.vocab.words(text)]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def decode(self, packed: bytes) -> str:
        """Emit the label of each arc."""
        labels = self.vocab.labels
        return " ".join([labels[i] for (i,) in struct.iter_unpack("<I", packed)])


@lru_cache(maxsize=2)
def _compiled(content: str) -> Automaton:
    return compile_automaton(content)


_encoders: dict[str, Encoder] = {}


def encoder(machine: Broadcast) -> Encoder:
    """The encoder of this Python worker."""
    name = machine.value.content
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(machine.value)
    return _encoders[name]


_shared: dict[tuple[str, str], Broadcast] = {}


def shared_automaton(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The automaton of a vocabulary file, compiled on the driver; its size is that of the file.

    One broadcast for each application and file, so that workers load it once, however many tables
    are encoded.
    """
    content = read_vocabulary_file(path)
    key = spark.sparkContext.applicationId, content
    if key not in _shared:
        _shared[key] = spark.sparkContext.broadcast(_compiled(content))
    return _shared[key]


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` with the tokens of every document."""
    machine = shared_automaton(docs.sparkSession, path)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encode = encoder(machine).encode

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.frombuffer(encode(t), "<u4").astype(np.int32) for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, decoded`` for rows of ``encode_texts``; null lists decode to nothing."""
    machine = shared_automaton(encoded.sparkSession, path)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        decode = encoder(machine).decode

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [np.asarray(r or [], "<u4").tobytes() for r in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 pa.array([decode(r) for r in rows], pa.string())],
                names=["doc_id", "decoded"],
            )

        return run

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id long, decoded string")


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` without storing tokens."""
    machine = shared_automaton(docs.sparkSession, path)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        both = encoder(machine).both

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids, decoded = [], [], []
            for text in texts_of(batch):
                packed, labels = both(text)
                counts.append(len(packed) // 4)
                ids.append(sha256(packed).hexdigest())
                decoded.append(sha256(labels.encode()).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", "text"), make, schema)
