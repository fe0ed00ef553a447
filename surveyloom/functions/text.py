"""Text normalisation as Column expressions.

Everything here is built from native Spark SQL functions, so it stays inside the JVM. Spark has
no Unicode-normalise function: accents are removed with one ``translate`` whose table is derived
from the Unicode database when the module is imported.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping
from string import ascii_lowercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.fixed_values import MISSING_TOKENS

# White space as Unicode defines it. Java's \s and Spark's trim only know ASCII blanks, while survey
# exports also hold no-break and typographic ones.
_ASCII_SPACE = r"\s\x1c-\x1f"
_WIDE_SPACES = (
    "\x85\xa0            "
    "    　"
)
_ANY_SPACE = rf"[{_ASCII_SPACE}\x85   -     　]"
_NO_SPACE = f"[^{_ANY_SPACE[1:]}"
_EDGE_SPACES = rf"^{_ANY_SPACE}++|{_ANY_SPACE}++\z"
# Cheap test that lets most texts pass: both ends are visible ASCII characters.
_MAY_HAVE_EDGE_SPACES = r"^[^!-~]|[^!-~]\z"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_MISSING = "^(" + "|".join(MISSING_TOKENS) + r")\z"
_SURELY_ANSWERED = (
    "(?i)[" + "".join(sorted(set(ascii_lowercase + digits) - set("".join(MISSING_TOKENS)))) + "]"
)

_LAST_POINT = 0x10FFFF
_SURROGATES = range(0xD800, 0xE000)

# Hangul syllables, by the arithmetic that composes them: a lead, a vowel and maybe a tail.
_SYLLABLES, _VOWELS, _TAILS = (0xAC00, 0xD7A3), 21, 28
_LEAD_JAMO, _VOWEL_JAMO, _TAIL_JAMO = 0x1100, 0x1161, 0x11A7


def _folding_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one or none, and those that become several, of all code points.

    Compatibility decomposition without combining marks. Surrogates are no characters; syllables of
    Hangul are left to arithmetic, and spaces to the caller.
    """
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for point in range(0x80, _LAST_POINT + 1):
        if point in _SURROGATES or _SYLLABLES[0] <= point <= _SYLLABLES[1]:
            continue
        char = chr(point)
        if not unicodedata.combining(char) and not unicodedata.decomposition(char):
            continue
        if char.isspace():
            continue
        parts = unicodedata.normalize("NFKD", char)
        plain = "".join(c for c in parts if not unicodedata.combining(c))
        if plain != char:
            (single if len(plain) <= 1 else several)[char] = plain
    return single, several


_SINGLE, _SEVERAL = _folding_tables()
_SINGLE.update((space, " ") for space in _WIDE_SPACES + "\t\n\x0b\f\r\x1c\x1d\x1e\x1f")


def _translation(table: Mapping[str, str]) -> tuple[str, str]:
    """Arguments of ``translate``: it deletes characters of the first that have no partner."""
    kept = [c for c, plain in table.items() if plain]
    dropped = [c for c, plain in table.items() if not plain]
    return "".join(kept + dropped), "".join(table[c] for c in kept)


_FROM, _TO = _translation(_SINGLE)
_SHORT = 3
#: The first, second and third character of each short expansion, dropped where there is none.
_NTH = [
    _translation({c: plain[n : n + 1] for c, plain in _SEVERAL.items() if len(plain) <= _SHORT})
    for n in range(_SHORT)
]
_LONGER = {c: plain for c, plain in _SEVERAL.items() if len(plain) > _SHORT}
#: Longer expansions behind a mark and their character, one after the other.
_PACKED = "".join(f"\x01{c}{plain}" for c, plain in _LONGER.items()) + "\x01"


def _exactly(chars: Iterable[str]) -> str:
    """Regex class of exactly these characters."""
    points = sorted(map(ord, chars))
    spans = [[points[0], points[0]]]
    for point in points[1:]:
        if point == spans[-1][1] + 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


_CONTROL_SPACE = r"[\t-\r\x1c-\x1f]"
_EXPANDS = _exactly(_SEVERAL)
_LOW = [c for c in _SEVERAL if ord(c) < 0x130]
# Few characters of accented Latin text lie here, so that most rows never meet the exact class.
_MAY_EXPAND = "[" + "".join(_LOW) + r"\x{130}-\x{10ffff}]"
_SYLLABLE = rf"[\x{{{_SYLLABLES[0]:x}}}-\x{{{_SYLLABLES[1]:x}}}]"


def _jamo(syllable: Column) -> Column:
    """Lead, vowel and tail of one syllable."""
    number = F.ascii(syllable) - _SYLLABLES[0]
    leads, vowels, tails = (
        F.lit("".join(map(chr, range(first, first + count))))
        for first, count in ((_LEAD_JAMO, 19), (_VOWEL_JAMO, _VOWELS), (_TAIL_JAMO + 1, _TAILS - 1))
    )
    one = F.lit(1)
    tail = number % _TAILS
    lead = (number / (_VOWELS * _TAILS)).cast("int")
    vowel = (number % (_VOWELS * _TAILS) / _TAILS).cast("int")
    return F.concat(
        F.substr(leads, lead + 1, one), F.substr(vowels, vowel + 1, one),
        F.when(tail > 0, F.substr(tails, tail, one)).otherwise(""),
    )


def _expansion(char: Column) -> Column:
    mark = F.concat(F.lit("\x01"), char)
    behind = F.call_function("substring_index", F.lit(_PACKED), mark, F.lit(-1))
    longer = F.substring_index(behind, "\x01", 1)
    short = F.concat(*[F.translate(char, *nth) for nth in _NTH])
    return F.when(F.contains(F.lit("".join(_LONGER)), char), longer).otherwise(short)


def _replace_each(text: Column, one: str, replace: Callable[[Column], Column]) -> Column:
    """The text with each character of a class replaced: cut before them, looked up, joined."""

    def replaced(piece: Column) -> Column:
        first = replace(F.left(piece, F.lit(1)))
        return F.concat(first, F.substr(piece, F.lit(2)))

    pieces = F.transform(
        F.split(text, f"(?={one})"), lambda p: F.when(p.rlike(f"^{one}"), replaced(p)).otherwise(p)
    )
    return F.array_join(pieces, "")


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose, drop combining marks (``Sênior`` -> ``Senior``), unify white space.

    ASCII rows pass through, and characters that become one other or none are looked up in one
    ``translate``. Rare rows hold some that become several: they are cut around these, and each of
    those is looked up place by place of its expansion. Hangul follows from arithmetic. All steps take
    time in proportion to the text.
    """
    holds = text.rlike(_MAY_EXPAND)
    expanded = F.when(
        text.rlike(_EXPANDS), _replace_each(text, _EXPANDS, _expansion)
    ).otherwise(text)
    # No expansion holds a syllable, so what is cut here was in the text.
    syllables = F.when(
        text.rlike(_SYLLABLE), _replace_each(expanded, _SYLLABLE, _jamo)
    ).otherwise(expanded)
    decomposed = F.when(holds, syllables).otherwise(text)
    # More bytes than characters: not ASCII. Told without decoding the text.
    wide = F.octet_length(text) > F.length(text)
    return F.when(
        wide | text.rlike(_CONTROL_SPACE), F.translate(decomposed, _FROM, _TO)
    ).otherwise(text)


def strip_spaces(text: Column) -> Column:
    """Trim every kind of space, which ``trim`` (ASCII blank only) does not.

    Blanks go first, so that few texts meet the pattern.
    """
    trimmed = F.trim(text)
    edged = trimmed.rlike(_MAY_HAVE_EDGE_SPACES)
    return F.when(edged, F.regexp_replace(trimmed, _EDGE_SPACES, "")).otherwise(trimmed)


def holds_text(text: Column) -> Column:
    """Whether ``strip_spaces`` leaves anything, known at the first character that is no space."""
    return text.rlike(_NO_SPACE)


def normalise(value: Column) -> Column:
    """Lower-case, accent-free, single-spaced text; every spelling of "missing" gives ``""``."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    single_spaced = F.regexp_replace(fold_accents(text), " {2,}+", " ")
    return F.regexp_replace(F.lower(F.trim(single_spaced)), _MISSING, "")


def normalise_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add ``{new: normalise(source)}`` for several columns of a table.

    The same result as ``normalise``, in three projections, so that each step can look at the
    previous result before it does any work.
    """
    def source(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    folded = df.withColumns({new: fold_accents(source(old)) for new, old in columns.items()})

    def single_spaced(text: Column) -> Column:
        runs = text.contains("  ")
        return F.when(runs, F.regexp_replace(text, " {2,}+", " ")).otherwise(text)

    lowered = folded.withColumns(
        {new: F.lower(F.trim(single_spaced(F.col(new)))) for new in columns}
    )
    return lowered.withColumns(
        {
            new: F.when(F.col(new).isin(*MISSING_TOKENS), F.lit("")).otherwise(F.col(new))
            for new in columns
        }
    )


def is_missing(value: Column) -> Column:
    """Whether ``normalise`` gives ``""``, decided by a glance for nearly every text.

    One letter or digit that no spelling of "missing" contains settles that there is an answer.
    """
    answered = value.cast("string").rlike(_SURELY_ANSWERED)
    return F.when(answered, F.lit(False)).otherwise(normalise(value) == "")


def normalise_code(code: Column) -> Column:
    """Dotted question code: ``P2_h`` and ``2.h`` both become ``2.h``."""
    text = F.regexp_replace(F.replace(normalise(code), F.lit(" "), F.lit("")), r"^p(?=\d)", "")
    dotted = F.regexp_replace(F.translate(text, "_", "."), r"\.+", ".")
    return F.regexp_replace(dotted, r"^\.|\.\z", "")


def snake_case(value: Column) -> Column:
    """Normalised text with every run of other characters turned into one underscore."""
    text = F.regexp_replace(normalise(value), "[^a-z0-9]+", "_")
    return F.regexp_replace(text, r"^_|_\z", "")


def to_integer(value: Column) -> Column:
    """Whole number in a text answer; text that is no number gives NULL (also under ANSI).

    The cast alone would take ``34d`` for a number.
    """
    text = strip_spaces(value.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double").try_cast("int"))


def display_label(value: Column, length: int = 45) -> Column:
    """Label for a report: underscores as blanks, at most ``length`` characters shown."""
    return F.substring(F.translate(value, "_", " "), 1, length)
