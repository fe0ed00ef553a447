"""Personal data: base patterns, and a linear-chain conditional random field that adds to them.

The base patterns find e-mail addresses, IP addresses, card and phone numbers in their usual forms.
The field labels tokens (runs of letters, runs of digits, single other characters); its features are
word shapes of a token and its neighbours. It is trained once a call from the small labelled table
``pii_examples.EXAMPLES``, and decoded by Viterbi in numpy, many windows at a time. A span of any
kind holds a digit, an ``@`` or the word "at", so only windows around these are decoded. A window is
widened until the labels around them are the same whatever comes before and after it: the result is
that of the whole text in one window. The field adds forms without a plus sign, written-out addresses and the
like, never a span that touches one that a base pattern matched, found or dropped. Base spans stay
as they are.

Every text is searched whole. A null text is empty and has no spans; null ids and repeated rows
are passed through; other columns are ignored by ``find_personal_data``. ``mask_personal_data``
keeps all columns. Very long texts take time in proportion to their length: no pattern backs off
over more than its own run.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.batches import map_batches, place_of, texts_of
from surveyloom.llm.pii_examples import EXAMPLES

KINDS = ("email", "ip", "card", "phone")
#: Code points on either side of a trigger that a window takes in at first.
CONTEXT = 40
LABELS = ("O", *[f"{part}-{kind}" for kind in KINDS for part in "BI"])
LONGEST_EMAIL = 254
STEPS, RATE, PENALTY = 250, 0.1, 0.01

Span = tuple[str, int, int]

#: What every sound span holds: a digit, ``@`` or the token "at". One set of characters comes first,
#: so that the search skips all others quickly.
_TRIGGER = re.compile(
    r"[0-9@aA](?:(?<=[0-9@])|(?<=[aA])(?<![^\W\d_][aA])[tT](?![^\W\d_]))"
)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def luhn(digits: str) -> bool:
    """Whether a card number's check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _parts_fit(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: the local part is the run before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the base patterns, and the places of matches that were dropped."""
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    dropped: list[tuple[int, int]] = []

    def take(kind: str, pattern: re.Pattern, fits: Callable[[str], bool], marks: bool) -> None:
        for m in pattern.finditer(text):
            if fits(m.group()):
                spans.append((kind, m.start(), m.end()))
            elif marks and m.end() - m.start() >= 13:
                dropped.append(m.span())

    take("ip", _IP, _parts_fit, False)
    take("card", _CARD, _card, True)
    if "+" in text:
        take("phone", _PHONE, lambda t: 9 <= len(_digits(t)) <= 15, True)
    return spans, dropped


class Window(NamedTuple):
    """A stretch of text: its tokens, where they start and end, and whether a space goes before."""

    tokens: list[str]
    starts: list[int]
    ends: list[int]
    spaced: list[bool]


def window_of(text: str, begin: int, end: int) -> Window:
    found = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text, begin, end)]
    tokens, starts, ends = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
    spaced = [i == 0 or starts[i] > ends[i - 1] for i in range(len(tokens))]
    return Window(tokens, starts, ends, spaced)


class Stretch(NamedTuple):
    """A window, how many tokens at either end only lend features, and its triggers' first and last.

    The two tokens before and after a stretch are its neighbours; where none are there, the text
    begins or ends. ``first`` and ``last`` count tokens without the neighbours; ``core`` is where
    they stand in the text.
    """

    window: Window
    before: int
    after: int
    first: int
    last: int
    core: tuple[int, int]


def triggers(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TRIGGER.finditer(text)]


def windows(text: str, cores: list[tuple[int, int]], reach: int = CONTEXT) -> list[Stretch]:
    """Stretches within ``reach`` of a core, widened to whole tokens, merged where they meet."""
    out: list[list[int]] = []
    for first, last in cores:
        if out and first - reach <= out[-1][1]:
            out[-1][1], out[-1][3] = last + reach, last
        else:
            out.append([first - reach, last + reach, first, last])
    merged: list[list[int]] = []
    for begin, end, first, last in out:
        begin, end = _token_start(text, max(0, begin)), _token_end(text, min(end, len(text)))
        if merged and begin <= merged[-1][1]:
            merged[-1][1], merged[-1][3] = end, last
        else:
            merged.append([begin, end, first, last])
    return [_stretch(text, *m) for m in merged]


def _stretch(text: str, begin: int, end: int, first: int, last: int) -> Stretch:
    outer_begin, outer_end, before, after = begin, end, 0, 0
    while before < 2 and (at := _blanks_before(text, outer_begin)):
        outer_begin, before = _token_start(text, at - 1), before + 1
    while after < 2 and (found := _TOKEN.search(text, outer_end)):
        outer_end, after = found.end(), after + 1
    window = window_of(text, outer_begin, outer_end)
    inside = bisect_right(window.starts, first) - 1 - before
    last_inside = bisect_left(window.starts, last) - 1 - before
    return Stretch(window, before, after, inside, last_inside, (first, last))


def _blanks_before(text: str, at: int) -> int:
    """Where the white space that ends at a place begins."""
    while at and text[at - 1].isspace():
        at -= 1
    return at


def _one_token(a: str, b: str) -> bool:
    """Whether two characters side by side belong to one token."""
    if "0" <= a <= "9":
        return "0" <= b <= "9"
    return a.isalnum() and b.isalnum() and not a.isdecimal() and not b.isdecimal()


def _token_start(text: str, at: int) -> int:
    """Start of the token that goes over a place in a text."""
    while 0 < at < len(text) and _one_token(text[at - 1], text[at]):
        at -= 1
    return at


def _token_end(text: str, at: int) -> int:
    """End of the token that goes over a place in a text."""
    while 0 < at < len(text) and _one_token(text[at - 1], text[at]):
        at += 1
    return at


def shape(token: str) -> str:
    """Word shape: digits with their number, letters by case, other characters as they are."""
    c = token[0]
    if "0" <= c <= "9":
        return f"9x{min(len(token), 6)}" if len(token) < 13 or len(token) > 19 else "9xcard"
    if c.isalpha():
        if len(token) == 1:
            return "a"
        return "AA" if token.isupper() else "Aa" if token[0].isupper() else "aa"
    return c


def surroundings(window: Window, words: frozenset[str]) -> list[tuple[str, ...]]:
    """What the features of each token are made from: five shapes, five words and two spaces."""
    shapes = ["<", "<", *[shape(t) for t in window.tokens], ">", ">"]
    lower = ["", "", *[w if (w := t.lower()) in words else "" for t in window.tokens], "", ""]
    spaced = ["_" if s else "" for s in window.spaced] + ["_"]
    return [
        (*shapes[i : i + 5], *lower[i : i + 5], spaced[i], spaced[i + 1])
        for i in range(len(window.tokens))
    ]


def names_of(around: tuple[str, ...]) -> list[str]:
    """Names of the features of a token."""
    second, before, shaped, after, next_but_one, *words, spaced, spaced_after = around
    here, after = spaced + shaped, spaced_after + after
    names = [
        "bias", f"0{here}", f"-1{before}", f"+1{after}", f"-2{second}", f"+2{next_but_one}",
        f"-10{before}{here}", f"01{here}{after}", f"-101{before}{here}{after}",
    ]
    return names + [f"w{k}{word}" for k, word in zip((-2, -1, 0, 1, 2), words, strict=True) if word]


def features(window: Window, words: frozenset[str]) -> list[list[str]]:
    """Names of the features of each token."""
    return [names_of(around) for around in surroundings(window, words)]


class Field(NamedTuple):
    """A trained field."""

    words: frozenset[str]
    names: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def scores(
        self, window: Window, seen: dict[tuple[str, ...], np.ndarray] | None = None
    ) -> np.ndarray:
        """Scores of the labels of each token; ``seen`` keeps those of surroundings met before."""
        seen = {} if seen is None else seen
        out = np.zeros((len(window.tokens), len(LABELS)))
        for i, around in enumerate(surroundings(window, self.words)):
            found = seen.get(around)
            if found is None:
                rows = [self.names[n] for n in names_of(around) if n in self.names]
                found = seen[around] = self.weights[rows].sum(axis=0)
            out[i] = found
        return out


def _allowed() -> np.ndarray:
    """Zero where a label may follow another; a span may only be continued by its own kind."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            if b[0] == "I" and (a == "O" or a[2:] != b[2:]):
                out[i, j] = -1e4
    return out


def parse_example(marked: str) -> tuple[Window, list[int]]:
    """A row of the labelled table: spans are written ``{kind:text}``."""
    text, spans = "", []
    for plain, kind, inner in re.findall(r"([^{]*)(?:\{(\w+):([^}]*)\})?", marked):
        text += plain
        if kind:
            spans.append((kind, len(text), len(text) + len(inner)))
            text += inner
    window = window_of(text, 0, len(text))
    labels = [0] * len(window.tokens)
    for kind, a, b in spans:
        inside = [i for i, s in enumerate(window.starts) if a <= s < b]
        for n, i in enumerate(inside):
            labels[i] = LABELS.index(("I-" if n else "B-") + kind)
    return window, labels


def _pad(arrays: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(a) for a in arrays])
    out = np.zeros((len(arrays), lengths.max(), *arrays[0].shape[1:]), arrays[0].dtype)
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out, lengths


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=1)
def train(examples: tuple[str, ...] = EXAMPLES) -> Field:
    """Greatest penalised likelihood, by full gradients with adaptive steps."""
    parsed = [parse_example(e) for e in examples]
    counts: dict[str, int] = {}
    for window, _ in parsed:
        for t in {t.lower() for t in window.tokens if t[0].isalpha()}:
            counts[t] = counts.get(t, 0) + 1
    words = frozenset(w for w, n in counts.items() if n >= 3)
    rows = [features(window, words) for window, _ in parsed]
    names: dict[str, int] = {}
    for row in rows:
        for token in row:
            for name in token:
                names.setdefault(name, len(names))
    width = max(len(token) for row in rows for token in row)
    blank = len(names)
    ids = [
        np.array([[*(names[n] for n in t), *[blank] * (width - len(t))] for t in row])
        for row in rows
    ]
    padded, lengths = _pad(ids)
    gold, _ = _pad([np.array(labels) for _, labels in parsed])
    n, longest, k = len(parsed), padded.shape[1], len(LABELS)
    inside = np.arange(longest)[None] < lengths[:, None]
    weights, moves, forbidden = np.zeros((blank + 1, k)), np.zeros((k, k)), _allowed()
    start = np.where([label[0] == "I" for label in LABELS], -1e4, 0.0)
    first, second = [0.0, 0.0], [1e-8, 1e-8]
    seq, pos = np.nonzero(inside)
    pairs = inside[:, 1:]
    for step in range(1, STEPS + 1):
        emit = weights[padded].sum(axis=2)
        emit[:, 0] += start
        trans = moves + forbidden
        alpha, beta = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            move = _log_sum(alpha[:, t - 1][:, :, None] + trans, 1) + emit[:, t]
            alpha[:, t] = np.where(inside[:, t][:, None], move, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            move = _log_sum(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1][:, None], move, 0.0)
        whole = _log_sum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - whole[:, None, None])
        node[seq, pos, gold[seq, pos]] -= 1
        g_weights = np.zeros_like(weights)
        for f in range(width):
            np.add.at(g_weights, padded[seq, pos, f], node[seq, pos])
        edge = np.exp(
            alpha[:, :-1, :, None] + trans
            + (emit + beta)[:, 1:, None, :] - whole[:, None, None, None]
        )
        g_moves = edge[pairs].sum(axis=0)
        np.add.at(g_moves, (gold[:, :-1][pairs], gold[:, 1:][pairs]), -1)
        g_weights[blank] = 0
        for i, (value, gradient) in enumerate(((weights, g_weights), (moves, g_moves))):
            gradient = gradient + PENALTY * value
            first[i] = 0.9 * first[i] + 0.1 * gradient
            second[i] = 0.99 * second[i] + 0.01 * gradient**2
            value -= (
                RATE * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6)
            )
    return Field(words, names, weights[:blank], moves + forbidden)


def viterbi(scores: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Best labels of many windows; those of like length are decoded together."""
    out: list[np.ndarray] = [np.zeros(0, int)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: len(scores[i]))
    start = np.where([label[0] == "I" for label in LABELS], -1e4, 0.0)
    while order:
        room = max(1, 200_000 // len(scores[order[-1]]))
        some, order = order[-room:], order[:-room]
        emit, lengths = _pad([scores[i] for i in some])
        best = emit[:, 0] + start
        back = np.zeros(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            step = best[:, :, None] + moves
            back[:, t] = step.argmax(axis=1)
            best = np.where((t < lengths)[:, None], step.max(axis=1) + emit[:, t], best)
        label = best.argmax(axis=1)
        labels = np.zeros(emit.shape[:2], int)
        for t in range(emit.shape[1] - 1, -1, -1):
            inside = t < lengths
            labels[inside, t] = label[inside]
            label = np.where(inside, back[np.arange(len(some)), t, label], label)
        for row, i in enumerate(some):
            out[i] = labels[row, : lengths[row]]
    return out


def certain(
    scores: list[np.ndarray], opens: list[tuple[bool, bool]], moves: np.ndarray
) -> list[np.ndarray]:
    """Labels of windows that are best whatever label goes before and after; -1 for all others.

    ``opens`` says whether tokens go on before and after a window.
    """
    out: list[np.ndarray] = [np.zeros(0, int)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: len(scores[i]))
    start = np.where([label[0] == "I" for label in LABELS], -1e4, 0.0)
    while order:
        room = max(1, 20_000 // len(scores[order[-1]]))
        some, order = order[-room:], order[:-room]
        emit, lengths = _pad([scores[i] for i in some])
        k, n = len(LABELS), len(some)
        begun, going_on = np.array([opens[i] for i in some]).T
        # By label, label before the window and window, so that steps run along memory.
        emit = np.ascontiguousarray(emit.transpose(1, 2, 0))
        best = emit[0][:, None] + np.where(begun, moves.T[:, :, None], start[:, None, None])
        back = np.zeros((len(emit), k, k, n), np.int8)
        for t in range(1, len(emit)):
            top = _step(best, moves, back[t])
            best = np.where(t < lengths, top + emit[t][:, None], best)
        # By label after, label before and window.
        after = np.zeros((k, k, n), np.int8)
        _step(best, moves, after)
        label = np.where(going_on, after, best.argmax(axis=0)[None]).astype(np.int64)
        before, row = np.arange(k)[None, :, None], np.arange(n)[None, None]
        labels = np.zeros((len(emit), n), int)
        for t in range(len(emit) - 1, -1, -1):
            one = label[0, 0]
            labels[t] = np.where((label == one).all(axis=(0, 1)), one, -1)
            label = np.where(t < lengths, back[t][label, before, row], label)
        for row_of, i in enumerate(some):
            out[i] = labels[: lengths[row_of], row_of]
    return out


def _step(best: np.ndarray, moves: np.ndarray, came: np.ndarray) -> np.ndarray:
    """Best values of the next labels; where each came from is put into ``came``."""
    top = best[0][None] + moves[0][:, None, None]
    for label in range(1, len(moves)):
        other = best[label][None] + moves[label][:, None, None]
        better = other > top
        np.copyto(top, other, where=better)
        np.copyto(came, np.int8(label), where=better)
    return top


def _settled(labels: np.ndarray, stretch: Stretch) -> tuple[int, int] | None:
    """The tokens around the triggers whose spans are known whole, or None where more is needed.

    An address that is too long already is no span, however far it goes on.
    """
    unknown = np.flatnonzero(labels < 0)
    k = int(np.searchsorted(unknown, stretch.first))
    low = int(unknown[k - 1]) + 1 if k else 0
    high = int(unknown[k]) if k < len(unknown) else len(labels)
    if high <= stretch.last:
        return None
    starts, ends = stretch.window.starts[stretch.before :], stretch.window.ends[stretch.before :]
    inner = [label[0] == "I" for label in LABELS]
    goes_on = [inner[label] for label in labels[low:high].tolist()]
    a, b = low, high
    if low or stretch.before:
        while a < high and goes_on[a - low]:
            a += 1
        if a > stretch.first and not _too_long(labels[low], ends[a - 1] - starts[low]):
            return None
    if high < len(labels) or stretch.after:
        while b > low and goes_on[b - 1 - low]:
            b -= 1
        b = max(low, b - 1)
        open_end = b <= stretch.last and labels[b]
        if open_end and not _too_long(labels[high - 1], ends[high - 1] - starts[b]):
            return None
    return a, max(a, b)


def _too_long(label: int, length: int) -> bool:
    return LABELS[label] == "I-email" and length > LONGEST_EMAIL


def _labelled(texts: Sequence[str], numbers: list[int], field: Field) -> list[set[Span]]:
    """Spans of the field in some of the texts, as if each text were one window."""
    spans: list[set[Span]] = [set() for _ in texts]
    cores = {n: triggers(texts[n]) for n in numbers}
    reach = CONTEXT
    seen: dict[tuple[str, ...], np.ndarray] = {}
    while cores:
        places = [(n, s) for n, some in cores.items() for s in windows(texts[n], some, reach)]
        scores = [
            field.scores(s.window, seen)[s.before : len(s.window.tokens) - s.after]
            for _, s in places
        ]
        opens = [(s.before > 0, s.after > 0) for _, s in places]
        cores, reach = {}, 2 * reach
        for (number, stretch), labels in zip(
            places, certain(scores, opens, field.moves), strict=True
        ):
            known = _settled(labels, stretch)
            if known is None:
                cores.setdefault(number, []).append(stretch.core)
                continue
            at, stop = known
            while at < stop:
                name = LABELS[labels[at]]
                end = at + 1
                while end < stop and name[0] == "B" and LABELS[labels[end]] == f"I-{name[2:]}":
                    end += 1
                if name != "O":
                    window, k = stretch.window, stretch.before
                    spans[number].add((name[2:], window.starts[at + k], window.ends[end - 1 + k]))
                at = end
    return spans


def _sound(kind: str, text: str) -> bool:
    """Whether a labelled span can be what its label says."""
    digits = _digits(text)
    if kind == "email":
        return 6 <= len(text) <= LONGEST_EMAIL and bool(re.search(r"@|\bat\b", text, re.IGNORECASE))
    if kind == "card":
        return _card(text)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 7 <= len(digits) <= 15


def find_spans(texts: Sequence[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all spans, by kind as listed, then start."""
    base: list[list[Span]] = []
    busy, numbers = [], []
    for number, text in enumerate(texts):
        if not _TRIGGER.search(text):
            base.append([])
            busy.append([])
            continue
        spans, dropped = base_spans(text)
        base.append(spans)
        busy.append([(a, b) for _, a, b in spans] + dropped)
        numbers.append(number)
    added = [
        [
            (kind, a, b) for kind, a, b in spans
            if all(b <= x or y <= a for x, y in busy[number]) and _sound(kind, texts[number][a:b])
        ]
        for number, spans in enumerate(_labelled(texts, numbers, field))
    ]
    rank = {kind: i for i, kind in enumerate(KINDS)}
    order = lambda s: (rank[s[0]], s[1], s[2])
    return [(sorted(b, key=order), sorted(b + a, key=order)) for b, a in zip(base, added, strict=True)]


def _joined(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_added long"
)


def find_personal_data(docs: DataFrame, examples: tuple[str, ...] = EXAMPLES) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    field = train(examples)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = find_spans(texts_of(batch), field)
            counts = [
                pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64())
                for kind in KINDS
            ]
            digests = [sha256(_joined(base).encode()).hexdigest() for base, _ in found]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *counts, pa.array(digests, pa.string()),
                    pa.array([_joined(spans) for _, spans in found], pa.string()),
                    pa.array([len(spans) - len(base) for base, spans in found], pa.int64()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

        return run

    typed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(typed, make, SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """A text with every span replaced by its kind; spans that overlap become one mask."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask_personal_data(docs: DataFrame, examples: tuple[str, ...] = EXAMPLES) -> DataFrame:
    """All rows and columns, with personal data in ``text`` masked; null texts stay null."""
    field = train(examples)
    at = place_of(docs, "text")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            found = find_spans([t or "" for t in texts], field)
            new = [
                t if t is None else masked(t, spans)
                for t, (_, spans) in zip(texts, found, strict=True)
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return run

    return map_batches(docs, make, docs.schema)
