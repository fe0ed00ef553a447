"""Silver to gold: one aggregate table per question. Column names follow the published schema.

Every table is one aggregation of the respondents (or answers); whatever comes after works on the
aggregated rows. ``digits`` rounds pay (and age to one place), None keeps both as computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import fixed_values as fixed
from surveyloom.operators import answers
from surveyloom.operators.cuts import multi_cut
from surveyloom.operators.grouped import banded_statistics, counts_and_statistics
from surveyloom.operators.shares import rate, rounded, sample_flag, share_of

# Decimal places of a published mean age.
AGE_DIGITS = 1

# Order of the rows of each table when it is written.
GOLD_ORDER = {
    "perfil_mercado": ("ano", "-respondentes"),
    "remuneracao": ("ano", "recorte", "-salario_mediano_interpolado"),
    "diversidade": ("ano", "senioridade", "-respondentes"),
    "tecnologias": ("ano", "categoria", "posicao"),
    "adocao_ia": ("ano", "-taxa_adocao_ia"),
    "impacto_ia": ("ano", "senioridade", "grupo"),
    "modelo_trabalho": ("ano", "regiao", "-respondentes"),
}


def profile(respondents: DataFrame, digits: int | None = None) -> DataFrame:
    """``perfil_mercado``: head count, mean age and share of the year by role and seniority."""
    counted = respondents.groupBy("ano", "cargo", "senioridade").agg(
        F.count(F.lit(1)).alias("respondentes"),
        rounded(F.avg("idade"), None if digits is None else AGE_DIGITS).alias("idade_media"),
    )
    return share_of(counted, ["ano"])


def pay(
    respondents: DataFrame, minimum: int = fixed.MIN_RESPONDENTS, digits: int | None = None,
    cuts: Mapping[str, Sequence[str]] = fixed.PAY_CUTS,
) -> DataFrame:
    """``remuneracao``: pay statistics of every cut, in long format."""
    return sample_flag(multi_cut(respondents, cuts, digits=digits), minimum)


def diversity(respondents: DataFrame, digits: int | None = None) -> DataFrame:
    """``diversidade``: head count, pay and share within the level, by gender and seniority."""
    figures = counts_and_statistics(respondents, ["ano", "genero", "senioridade"], digits)
    return share_of(figures, ["ano", "senioridade"])


def technology(items: DataFrame, respondents: DataFrame) -> DataFrame:
    """``tecnologias``: adoption and rank of every item, from the long table of answers."""
    return answers.adoption(items, respondents)


def technology_of_lists(lists: DataFrame, respondents: DataFrame) -> DataFrame:
    """``tecnologias`` from whole answers, without a shuffle of respondents."""
    return answers.adoption_of_lists(lists, respondents)


def ai_adoption(respondents: DataFrame) -> DataFrame:
    """``adocao_ia``: share of AI users among those who answered; NULL where nobody did."""
    counted = respondents.groupBy("ano", "senioridade").agg(
        F.count(F.lit(1)).alias("respondentes"),
        F.count("usa_ia").alias("base_resposta"),
        F.sum("usa_ia").alias("usuarios"),
    )
    return counted.withColumn(
        "taxa_adocao_ia", rate(F.col("usuarios"), F.col("base_resposta"))
    ).drop("usuarios")


def ai_impact(
    respondents: DataFrame, minimum: int = fixed.MIN_RESPONDENTS, digits: int | None = None
) -> DataFrame:
    """``impacto_ia``: pay of AI users and non-users by seniority; it shows what goes together."""
    figures = banded_statistics(
        respondents, ["ano", "senioridade", "usa_ia"], digits, counted=F.col("usa_ia").isNotNull()
    ).select(
        "ano", "senioridade", "usa_ia", "respondentes", "salario_medio",
        "salario_mediano_interpolado",
    )
    group = F.when(F.col("usa_ia") == 1, F.lit(fixed.AI_GROUP_USER)).otherwise(
        F.lit(fixed.AI_GROUP_NON_USER)
    )
    return sample_flag(figures.withColumn("grupo", group), minimum)


def work_model(respondents: DataFrame, digits: int | None = None) -> DataFrame:
    """``modelo_trabalho``: head count, pay and share within the region, by region and model."""
    figures = counts_and_statistics(respondents, ["ano", "regiao", "forma_trabalho"], digits)
    return share_of(figures, ["ano", "regiao"])


def all_tables(
    respondents: DataFrame, items: DataFrame, minimum: int = fixed.MIN_RESPONDENTS,
    digits: int | None = None,
) -> dict[str, DataFrame]:
    """The seven gold tables by name."""
    return {
        "perfil_mercado": profile(respondents, digits),
        "remuneracao": pay(respondents, minimum, digits),
        "diversidade": diversity(respondents, digits),
        "tecnologias": technology(items, respondents),
        "adocao_ia": ai_adoption(respondents),
        "impacto_ia": ai_impact(respondents, minimum, digits),
        "modelo_trabalho": work_model(respondents, digits),
    }
