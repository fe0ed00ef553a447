"""A word-level byte-pair vocabulary: reading its file, and splitting text into words and pieces.

The file is the JSON of a tokenizer that normalises (NFC, white space to one blank, lower case),
cuts text into letters, single digits and runs of other characters, writes bytes as printable
characters and marks the last symbol of a piece with a suffix. Anything else is refused, so that a
file of another kind can't give wrong tokens silently.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from pathlib import Path

import regex

# Fixed values of the file format: white space as Unicode defines it, and the cutting pattern.
SPACE = r"\t-\r \x85\xa0  -     　"
FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Code points that this Python's pattern library takes for letters and the file's
# library, which goes by an earlier Unicode version, does not.
NO_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 "
    "16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE "
    "1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD "
    "323B0-33479 3D000-3FC3F"
)
# Capitals whose small letters the library knows and this Python does not.
LATER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x019B, **{p: p + 0x20 for p in range(0x10D50, 0x10D66)},
    **{p: p + 0x1B for p in range(0x16EA0, 0x16EB9)},
}


def _pieces_pattern() -> str:
    """The file's pattern with the letters its library knows."""
    ranges = "".join(
        "-".join(f"\\U{int(end, 16):08X}" for end in part.split("-")) for part in NO_LETTERS.split()
    )
    letters = rf"[\p{{L}}--[{ranges}]]"
    pattern = FILE_PATTERN.replace(r"[\p{L}]", letters)
    return "(?V1)" + pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{N}}{letters}]")


_SPACES = regex.compile(f"[{SPACE}]+")
_PIECES = regex.compile(_pieces_pattern())
_LATER = regex.compile("[" + "".join(map(chr, LATER_CAPITALS)) + "]")
#: Characters that str.split() takes for white space and Unicode doesn't.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


def default_path() -> str:
    """Where the shared vocabulary lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def read_vocabulary_file(path: str | None = None) -> str:
    """The file's text; read on the driver and sent to the tasks, which need no file of their own."""
    return Path(path or default_path()).read_text("utf-8")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class WordVocabulary:
    """Symbols, merges in rank order, special strings, and the split of a text."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        model = file["model"]
        cut = (file["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        if model["type"] != "BPE" or cut.get("pattern") != {"Regex": FILE_PATTERN}:
            raise ValueError("not a word-level byte-pair vocabulary")
        self.suffix: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges: list[tuple[str, str]] = [tuple(m) for m in model["merges"]]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.labels: dict[int, str] = {i: s for s, i in self.ids.items()}
        self.labels |= {i: s for s, i in self.special.items()}
        self._bytes = byte_characters()
        self._plain = {c: self.ids[c] for c in self._bytes}
        self._last = {c: self.ids[c + self.suffix] for c in self._bytes}
        self._cut_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len)) + ")"
        )

    def words(self, text: str) -> list[str]:
        """White-space words of a text; special strings stand alone, as the library takes them."""
        if "<|" in text and self._cut_special.search(text):
            out: list[str] = []
            for part in self._cut_special.split(text):
                out += [part] if part in self.special else _space_words(part)
            return out
        return _space_words(text)

    def pieces(self, word: str) -> list[str]:
        """Pieces of a word, as printable byte characters, without the suffix."""
        if word.isascii():
            lower = word.lower()
            if lower.isalpha():
                return [lower]
            if lower[:-1].isalpha() and lower[-1] in ".,":
                return [lower[:-1], lower[-1]]
            found = _PIECES.findall(lower)
        else:
            # The library lower-cases character by character, hence no final sigma.
            lower = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
            if _LATER.search(lower):
                lower = lower.translate(LATER_CAPITALS)
            found = [lower] if lower.isalpha() else _PIECES.findall(lower)
        chars = self._bytes
        return ["".join([chars[b] for b in p.encode()]) for p in found]

    def symbols(self, piece: str) -> list[int]:
        """The symbols a piece starts from."""
        plain = self._plain
        out = [plain[c] for c in piece]
        out[-1] = self._last[piece[-1]]
        return out


def _space_words(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


@lru_cache(maxsize=4)
def vocabulary(content: str) -> WordVocabulary:
    """Parsed once in each Python worker."""
    return WordVocabulary(content)
