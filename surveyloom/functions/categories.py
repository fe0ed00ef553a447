"""Standard labels for free-text categories.

Each rule comes in two forms: ``xxx_of(normalised)`` works on text that already went through
``normalise`` (the silver plan normalises once per column), ``standard_xxx(value)`` on raw text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom.functions import fixed_values as fixed
from surveyloom.functions.text import is_missing, normalise, strip_spaces


def first_match(text: Column, rules: Iterable[tuple[str, str]], otherwise: Column) -> Column:
    """Label of the first rule whose fragment occurs in the text. The order of rules matters."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for fragment, label in rules:
        chain = chain.when(text.contains(fragment), F.lit(label))
    return chain.otherwise(otherwise)


def seniority_of(text: Column) -> Column:
    rules = fixed.SENIORITY_RULES + tuple((t, fixed.MANAGEMENT) for t in fixed.MANAGEMENT_TERMS)
    labelled = first_match(text, rules, F.lit(fixed.OTHER))
    return F.when(text == "", F.lit(fixed.NOT_INFORMED)).otherwise(labelled)


def standard_seniority(value: Column) -> Column:
    return seniority_of(normalise(value))


def fill_manager(seniority: Column, manages: Column) -> Column:
    """Seniority of managers, who are not asked for a level.

    ``manages`` may be raw (0/1, TRUE/FALSE, Sim/Nao) or already 0/1.
    """
    known = ~normalise(seniority).isin("", fixed.NOT_INFORMED.lower())
    return (
        F.when(known, strip_spaces(seniority))
        .when(to_binary(manages) == 1, F.lit(fixed.MANAGEMENT))
        .otherwise(F.lit(fixed.NOT_INFORMED))
    )


def work_model_of(text: Column) -> Column:
    labelled = first_match(text, fixed.WORK_MODEL_RULES, F.lit(fixed.OTHER))
    return F.when(text == "", F.lit(fixed.NOT_INFORMED)).otherwise(labelled)


def standard_work_model(value: Column) -> Column:
    return work_model_of(normalise(value))


def _named(
    text: Column, rules: Iterable[tuple[tuple[str, ...], tuple[str, ...], object]]
) -> Column:
    """Value of the rule one of whose beginnings or whole words the text has; NULL without one."""
    chain = F.when(F.lit(False), F.lit(None))
    for beginnings, words, value in rules:
        hit = text.isin(*words)
        for beginning in beginnings:
            hit = hit | text.startswith(beginning)
        chain = chain.when(hit, F.lit(value))
    return chain


def gender_of(text: Column) -> Column:
    withheld = (text == "") | text.contains(fixed.GENDER_WITHHELD)
    other = F.when(withheld, F.lit(fixed.NOT_INFORMED)).otherwise(F.lit(fixed.OTHER))
    return F.coalesce(_named(text, fixed.GENDER_RULES), other)


def standard_gender(value: Column) -> Column:
    return gender_of(normalise(value))


def binary_of(text: Column) -> Column:
    return _named(text, fixed.BINARY_RULES)


def to_binary(value: Column) -> Column:
    """1, 0 or NULL, whatever encoding the edition used for a yes/no question."""
    return binary_of(normalise(value))


def _literal_map(entries: Mapping[str, str]) -> Column:
    """A constant map, folded once by the optimizer."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def region_of_state(state: Column, states: Mapping[str, str] = fixed.STATE_TO_REGION) -> Column:
    """Region of a state code; unknown and blank codes give the not-informed label."""
    region = F.try_element_at(_literal_map(states), F.upper(normalise(state)))
    return F.coalesce(region, F.lit(fixed.NOT_INFORMED))


def standard_region(
    region: Column, state: Column, states: Mapping[str, str] = fixed.STATE_TO_REGION
) -> Column:
    """The region the respondent gave, as spelled; derived from the state when blank."""
    return F.when(is_missing(region), region_of_state(state, states)).otherwise(
        strip_spaces(region)
    )


def canonical_region(
    region: Column, state: Column, states: Mapping[str, str] = fixed.STATE_TO_REGION
) -> Column:
    """``standard_region`` with one spelling per known region (``SUDESTE`` -> ``Sudeste``)."""
    known = {name.lower(): name for name in states.values()}
    one_spelling = F.try_element_at(_literal_map(known), normalise(region))
    return F.coalesce(one_spelling, standard_region(region, state, states))


def ai_flag_of(text: Column) -> Column:
    return (
        F.when(text.contains(fixed.AI_NOT_USED_PHRASE), F.lit(0))
        .when(text.contains(fixed.AI_USED_FRAGMENT), F.lit(1))
    )


def flag_use(value: Column) -> Column:
    """1 = uses generative AI, 0 = does not, NULL = not answered.

    The options of this question contain top-level commas, so they are recognised by phrase.
    """
    return ai_flag_of(normalise(value))


def use_type_of(text: Column) -> Column:
    found = []
    for fragments, label in fixed.AI_USE_RULES:
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | text.contains(fragment)
        found.append(F.when(hit, F.lit(label)))
    unused = text.contains(fixed.AI_NOT_USED_PHRASE)
    kinds = F.when(unused, F.lit(fixed.AI_USE_NONE)).otherwise(F.concat_ws("|", *found))
    return F.nullif(kinds, F.lit(""))


def classify_use(value: Column) -> Column:
    """Kinds of generative-AI use, pipe-joined (``Paga|Gratuita``); NULL when none is named."""
    return use_type_of(normalise(value))


def use_kinds(value: Column) -> Column:
    """``classify_use`` as an array; NULL when no kind is named."""
    return F.split(classify_use(value), r"\|")
