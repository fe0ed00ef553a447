"""Frames behind the charts: pivots, row percentages and short top lists, ready to draw."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import fixed_values as fixed
from surveyloom.functions.text import display_label
from surveyloom.operators.answers import comparable_categories
from surveyloom.operators.shares import (
    in_order, latest_edition, per_edition, rate, sufficient_or_all,
)

PAY = "salario_mediano_interpolado"
LEVELS = fixed.SENIORITY_ORDER
GENDERS = ("Feminino", "Masculino", fixed.NOT_INFORMED, fixed.OTHER)
WORK_MODELS = ("Hibrido", "Presencial", "Remoto", fixed.OTHER)


def row_percentages(df: DataFrame, index: str, columns: str, labels: Sequence[str]) -> DataFrame:
    """Pivot head counts to one column per label and turn each row into percentages."""
    wide = df.groupBy(index).pivot(columns, list(labels)).agg(F.sum("respondentes"))
    filled = wide.na.fill(0, list(labels))
    total = reduce(add, [F.col(f"`{x}`") for x in labels])
    shares = [rate(F.col(f"`{x}`"), total).alias(x) for x in labels]
    return filled.where(total > 0).select(index, *shares)


def mean_by(df: DataFrame, index: str, columns: str, labels: Sequence, value: str) -> DataFrame:
    """Pivot to the mean of the cells, as a pivot table does when several rows meet in one."""
    return df.groupBy(index).pivot(columns, list(labels)).agg(F.avg(value))


def _pay_rows(pay: DataFrame, cut: str) -> DataFrame:
    return sufficient_or_all(pay.where(F.col("recorte") == cut), ["recorte"])


def _latest_pay(pay: DataFrame, cut: str, keep: Column) -> DataFrame:
    """Pay of the latest edition within what the sample filter left of a cut."""
    rows = _pay_rows(pay, cut).where(keep)
    return latest_edition(rows).select("ano", "dimensao_1", F.col(PAY).alias("salario"))


def _in_levels(name: str = "senioridade") -> Column:
    return F.col(name).isin(*LEVELS)


def seniority_mix(profile: DataFrame) -> DataFrame:
    """Percentage of each level among the five levels, per edition."""
    return row_percentages(profile, "ano", "senioridade", LEVELS).orderBy("ano")


def top_role_bars(profile: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent roles of the latest edition."""
    named = latest_edition(profile).where(F.col("cargo").isNotNull())
    counted = named.groupBy("cargo").agg(F.sum("respondentes").alias("respondentes"))
    return counted.orderBy(F.col("respondentes").desc(), "cargo").limit(k)


def pay_by_level(pay: DataFrame) -> DataFrame:
    """Pay per edition, one column per level."""
    return mean_by(_pay_rows(pay, "senioridade"), "ano", "dimensao_1", LEVELS, PAY).orderBy("ano")


def pay_by_region(pay: DataFrame) -> DataFrame:
    """Pay by region in the latest edition that has rows."""
    rows = _pay_rows(pay, "regiao")
    return (
        latest_edition(rows)
        .where(F.col("dimensao_1") != fixed.NOT_INFORMED)
        .select("ano", F.col("dimensao_1").alias("regiao"), F.col(PAY).alias("salario"))
        .orderBy("salario", "regiao")
    )


def pay_by_work_model(pay: DataFrame, editions: Sequence[int]) -> DataFrame:
    """Pay by work model, one column per edition."""
    rows = _pay_rows(pay, "forma_trabalho").where(F.col("dimensao_1") != fixed.NOT_INFORMED)
    return (
        rows.groupBy(F.col("dimensao_1").alias("forma_trabalho"))
        .agg(*per_edition(F.col(PAY), editions, "salario", F.avg))
        .orderBy("forma_trabalho")
    )


def best_paid_roles(pay: DataFrame, k: int = 10) -> DataFrame:
    """Roles with the highest pay in the latest edition."""
    return (
        _latest_pay(pay, "cargo", F.col("dimensao_1").isNotNull())
        .withColumnRenamed("dimensao_1", "cargo")
        .orderBy(F.col("salario").desc_nulls_last(), "cargo")
        .limit(k)
    )


def pay_by_experience(pay: DataFrame) -> DataFrame:
    """Pay by years of experience in the latest edition."""
    return (
        _latest_pay(pay, "tempo_experiencia_dados", F.col("dimensao_1").isNotNull())
        .withColumnRenamed("dimensao_1", "tempo_experiencia_dados")
        .orderBy("salario", "tempo_experiencia_dados")
    )


def top_tech_bars(technology: DataFrame, k: int = 10) -> DataFrame:
    """Top items of each question in the latest edition, with short labels."""
    return (
        latest_edition(technology)
        .where(F.col("posicao") <= k)
        .select(
            display_label(F.col("categoria")).alias("categoria"),
            F.substring("tecnologia", 1, 45).alias("tecnologia"),
            "taxa_adocao", "posicao",
        )
        .orderBy("categoria", "taxa_adocao", F.col("posicao").desc())
    )


def adoption_trend(
    technology: DataFrame, categories: Sequence[str] = fixed.COMPARABLE_CATEGORIES,
    top: int = 5, tolerance: float = 0.5,
) -> DataFrame:
    """Adoption over time of the items that lead their question in its latest edition.

    Questions seen in one edition only, or whose format changed, are left out.
    """
    asked = technology.where(F.col("categoria").isin(*categories))
    kept = asked.join(
        comparable_categories(asked, tolerance).select("categoria"), "categoria", "left_semi"
    )
    last = F.max("ano").over(Window.partitionBy("categoria"))
    leaders = (
        kept.withColumn("ultimo", last)
        .where((F.col("ano") == F.col("ultimo")) & (F.col("posicao") <= top))
        .select("categoria", "tecnologia")
    )
    return (
        kept.join(leaders, ["categoria", "tecnologia"], "left_semi")
        .select("categoria", "ano", "tecnologia", "taxa_adocao")
        .orderBy("categoria", "tecnologia", "ano")
    )


def ai_by_level(ai: DataFrame, editions: Sequence[int]) -> DataFrame:
    """AI adoption by level, one column per edition, levels in reading order."""
    return (
        ai.where((F.col("base_resposta") > 0) & _in_levels())
        .groupBy("senioridade")
        .agg(*per_edition(F.col("taxa_adocao_ia"), editions, "taxa", F.avg))
        .orderBy(in_order("senioridade", LEVELS))
    )


def ai_pay_by_level(impact: DataFrame) -> DataFrame:
    """Pay of AI users and non-users by level: mean over editions, levels with both sides."""
    groups = (fixed.AI_GROUP_NON_USER, fixed.AI_GROUP_USER)
    rows = impact.where(F.col("amostra_suficiente") & _in_levels())
    return (
        mean_by(rows, "senioridade", "grupo", groups, PAY)
        .na.drop(subset=list(groups))
        .select(
            "senioridade",
            F.col(groups[0]).alias("salario_nao_usa_ia"),
            F.col(groups[1]).alias("salario_usa_ia"),
        )
        .orderBy(in_order("senioridade", LEVELS))
    )


def gender_mix(diversity: DataFrame) -> DataFrame:
    """Percentage of each gender per edition."""
    return row_percentages(diversity, "ano", "genero", GENDERS).orderBy("ano")


def pay_gap_bars(diversity: DataFrame) -> DataFrame:
    """Pay of women and men by level in the latest edition, levels with both sides."""
    sides = ("Feminino", "Masculino")
    rows = latest_edition(diversity.where(F.col("genero").isin(*sides)))
    return (
        mean_by(rows, "senioridade", "genero", sides, PAY)
        .na.drop(subset=list(sides))
        .where(_in_levels())
        .orderBy(in_order("senioridade", LEVELS))
    )


def female_share_bars(diversity: DataFrame) -> DataFrame:
    """Percentage of women among women and men by level, over all editions."""
    sides = ("Feminino", "Masculino")
    counted = (
        diversity.where(F.col("genero").isin(*sides) & _in_levels())
        .groupBy("senioridade")
        .pivot("genero", list(sides))
        .agg(F.sum("respondentes"))
        .na.drop(subset=list(sides))
    )
    return counted.select(
        "senioridade",
        rate(F.col("Feminino"), F.col("Feminino") + F.col("Masculino")).alias("pct_feminino"),
    ).orderBy(in_order("senioridade", LEVELS))


def work_model_mix(work_model: DataFrame) -> DataFrame:
    """Percentage of each work model by region in the latest edition."""
    rows = latest_edition(work_model).where(
        (F.col("regiao") != fixed.NOT_INFORMED) & (F.col("forma_trabalho") != fixed.NOT_INFORMED)
    )
    return row_percentages(rows, "regiao", "forma_trabalho", WORK_MODELS).orderBy("regiao")
