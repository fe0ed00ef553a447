"""Answer bands ("de R$ 8.001/mes a R$ 12.000/mes") as lower and upper limits.

Limits come back as a struct ``(faixa_inferior, faixa_superior)``. A NULL upper limit marks a band
that is open at the top; two NULLs mark an answer without usable information.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.text import normalise

# Pattern of a number inside a band and the wordings of "no answer" and "up to".
NUMBER_PATTERN = r"(\d[\d\.\s]*)"
NO_ANSWER_PATTERN = r"nao.*(informar|receb|aplica)|(informar|receb|aplica).*nao"
UP_TO_BEGINNINGS, UP_TO_FRAGMENT = ("menos de", "ate"), "abaixo"


def band_numbers(text: Column) -> Column:
    """Numbers of a band text in reading order; dots, commas and blanks inside are grouping."""
    return F.transform(
        _found_numbers(text), lambda x: F.regexp_replace(x, r"\D", "").try_cast("double")
    )


def _found_numbers(normalised: Column) -> Column:
    return F.regexp_extract_all(
        F.replace(normalised, F.lit(","), F.lit(".")), F.lit(NUMBER_PATTERN), 1
    )


def _no_answer(normalised: Column) -> Column:
    return normalised.contains("nao") & normalised.rlike(NO_ANSWER_PATTERN)


def _up_to(normalised: Column) -> Column:
    low = normalised.contains(UP_TO_FRAGMENT)
    for beginning in UP_TO_BEGINNINGS:
        low = low | normalised.startswith(beginning)
    return low


def _nth_number(found: Column, index: int) -> Column:
    return F.regexp_replace(F.get(found, F.lit(index)), r"\D", "").try_cast("double")


def _limits(first: Column, second: Column, no_answer: Column, up_to: Column) -> list[Column]:
    answered = ~no_answer & first.isNotNull()
    opens_low = second.isNull() & up_to
    lower = F.when(answered, F.when(opens_low, F.lit(0.0)).otherwise(first))
    # A second number below the first is a misprint in the questionnaire: keep the lower limit only.
    upper = F.when(answered, F.when(opens_low, first).when(second >= first, second))
    return [lower.alias("faixa_inferior"), upper.alias("faixa_superior")]


def with_band_limits(df: DataFrame, normalised: str) -> DataFrame:
    """Add the limits of a normalised band column, each pattern applied once per row.

    Consecutive projections keep the intermediate results; Spark fuses them into one stage and
    does not inline an expensive expression that is read twice.
    """
    text = F.col(normalised)
    parsed = df.withColumn("numeros_da_faixa", _found_numbers(text)).withColumns(
        {
            "primeiro_numero": _nth_number(F.col("numeros_da_faixa"), 0),
            "segundo_numero": _nth_number(F.col("numeros_da_faixa"), 1),
            "sem_resposta": _no_answer(text),
            "faixa_ate": _up_to(text),
        }
    )
    helpers = ["primeiro_numero", "segundo_numero", "sem_resposta", "faixa_ate"]
    limits = _limits(*[F.col(name) for name in helpers])
    return parsed.select("*", *limits).drop("numeros_da_faixa", *helpers)


def limits_of_normalised(normalised: Column) -> Column:
    """Limits of a band whose text already went through ``normalise``."""
    found = _found_numbers(normalised)
    return F.struct(
        *_limits(
            _nth_number(found, 0), _nth_number(found, 1),
            _no_answer(normalised), _up_to(normalised),
        )
    )


def band_limits(text: Column) -> Column:
    """Limits of a raw band text."""
    return limits_of_normalised(normalise(text))


def midpoint(lower: Column, upper: Column) -> Column:
    """Amount that stands for a band: its middle, or its lower limit when it is open at the top."""
    return F.coalesce((lower + upper) / F.lit(2.0), lower)


def band_midpoint(text: Column) -> Column:
    """Midpoint of a raw band text."""
    limits = band_limits(text)
    return midpoint(limits["faixa_inferior"], limits["faixa_superior"])
