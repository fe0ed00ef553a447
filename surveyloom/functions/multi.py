"""Multi-answer text split into items, at top-level commas only.

Option names contain slashes and bracketed commas ("Google Cloud (GCP, Firebase)"), so a comma
separates items only outside ``()`` and ``[]``. Three ways, cheapest first, chosen per row:

* no bracket: a plain split;
* brackets that are balanced and not nested (nearly every real answer): a split at commas that no
  closing bracket follows before the next opening one;
* anything else: a fold over the comma-separated pieces that carries the bracket depth.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom.functions.text import is_missing, strip_spaces

_SIMPLE_BRACKETS = r"^[^()\[\]]*+(?:[(\[][^()\[\]]*+[)\]][^()\[\]]*+)*+\z"
_TOP_LEVEL_COMMA = r",(?![^()\[\]]*[)\]])"
_MARK = "\x01"


def _has_bracket(text: Column) -> Column:
    return reduce(or_, [text.contains(bracket) for bracket in "()[]"])


def _depth_after(piece: Column, depth: Column) -> Column:
    """Bracket depth after a piece; a stray closing bracket never takes it below zero."""
    brackets = F.split(F.regexp_replace(piece, r"[^()\[\]]", ""), "")
    counted = F.aggregate(
        brackets,
        depth,
        lambda d, c: F.when(c.isin("(", "["), d + 1)
        .when(c.isin(")", "]"), F.greatest(d - 1, F.lit(0)))
        .otherwise(d),
    )
    return F.when(_has_bracket(piece), counted).otherwise(depth)


def _nested_split(text: Column) -> Column:
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.lit(True).alias("first"))

    def step(acc: Column, piece: Column) -> Column:
        comma = F.when(acc["depth"] == 0, F.lit(_MARK)).otherwise(F.lit(","))
        joined = F.when(acc["first"], piece).otherwise(F.concat(acc["text"], comma, piece))
        return F.struct(
            _depth_after(piece, acc["depth"]).alias("depth"),
            joined.alias("text"),
            F.lit(False).alias("first"),
        )

    marked = F.aggregate(F.split(text, ","), start, step, lambda acc: acc["text"])
    return F.split(marked, _MARK)


def split_pieces(value: Column) -> Column:
    """Text between top-level commas, neither stripped nor cleared of blanks."""
    # The mark cannot be typed into a form; blank it so that it never splits an item.
    given = value.cast("string")
    marked = given.contains(_MARK)
    text = F.when(marked, F.translate(given, _MARK, " ")).otherwise(given)
    return (
        F.when(is_missing(value), F.array().cast("array<string>"))
        .when(~_has_bracket(text), F.split(text, ","))
        .when(text.rlike(_SIMPLE_BRACKETS), F.split(text, _TOP_LEVEL_COMMA))
        .otherwise(_nested_split(text))
    )


def split_top_level(value: Column) -> Column:
    """Items of a multi-answer text, stripped, without empty ones; no answer gives ``[]``."""
    return F.filter(F.transform(split_pieces(value), strip_spaces), lambda item: item != "")
