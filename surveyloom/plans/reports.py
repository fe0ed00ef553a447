"""Analytical reports on the silver and gold tables.

Each function takes the table it reads and returns a frame in reading order. Reports that put
editions side by side take the list of editions, so their columns are known beforehand.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import fixed_values as fixed
from surveyloom.operators.answers import comparable_categories, top_per_category
from surveyloom.operators.shares import latest_edition, per_edition, rate

PAY = "salario_mediano_interpolado"


def _count_if_label(column: str, labels: Iterable[str]) -> Column:
    return F.sum(F.when(F.col(column).isin(*labels), F.col("respondentes")).otherwise(F.lit(0)))


def _pay_cut(pay: DataFrame, *cuts: str) -> DataFrame:
    """Rows of the named cuts with a sufficient sample and an answered first dimension."""
    return pay.where(
        F.col("recorte").isin(*cuts)
        & F.col("amostra_suficiente")
        & F.col("dimensao_1").isNotNull()
    )


def coverage(respondents: DataFrame) -> DataFrame:
    """Volume and coverage of the critical fields per edition. Read this first."""
    counted = respondents.groupBy("ano").agg(
        F.count(F.lit(1)).alias("respondentes"),
        F.count("salario_mensal_estimado").alias("com_salario"),
        F.count("cargo").alias("com_cargo"),
        F.count("usa_ia").alias("com_resposta_ia"),
        F.count_if(F.col("senioridade") == fixed.NOT_INFORMED).alias("sem_senioridade"),
    )
    share = rate(F.col("com_salario"), F.col("respondentes"), 1)
    return counted.select(
        "ano", "respondentes", "com_salario", share.alias("pct_com_salario"), "com_cargo",
        "com_resposta_ia", "sem_senioridade",
    ).orderBy("ano")


def mix_by_year(profile: DataFrame, editions: Sequence[int]) -> DataFrame:
    """Head count by seniority, editions side by side; an absent cell is zero."""
    cells = [
        F.sum(F.when(F.col("ano") == y, F.col("respondentes")).otherwise(F.lit(0))).alias(
            f"resp_{y}"
        )
        for y in editions
    ]
    return profile.groupBy("senioridade").agg(*cells).orderBy(F.col(f"resp_{editions[-1]}").desc())


def top_roles(profile: DataFrame, k: int = 15) -> DataFrame:
    """Most frequent roles of the latest edition."""
    named = latest_edition(profile).where(F.col("cargo").isNotNull())
    return (
        named.groupBy("cargo")
        .agg(
            F.sum("respondentes").alias("respondentes"),
            F.round(F.sum("percentual"), 2).alias("pct_do_ano"),
        )
        .orderBy(F.col("respondentes").desc(), "cargo")
        .limit(k)
    )


def pay_by_role(pay: DataFrame) -> DataFrame:
    """Pay by role in the latest edition, sufficient samples only."""
    return (
        latest_edition(pay)
        .transform(_pay_cut, "cargo")
        .select(
            F.col("dimensao_1").alias("cargo"), "respondentes", F.col(PAY).alias("salario"),
            "p25", "p75",
        )
        .orderBy(F.col("salario").desc())
    )


def pay_progress(pay: DataFrame, editions: Sequence[int]) -> DataFrame:
    """Pay by seniority, editions side by side."""
    kept = pay.where((F.col("recorte") == "senioridade") & F.col("amostra_suficiente"))
    return (
        kept.groupBy(F.col("dimensao_1").alias("senioridade"))
        .agg(*per_edition(F.col(PAY), editions, "salario"))
        .orderBy(f"salario_{editions[-1]}")
    )


def pay_return(pay: DataFrame) -> DataFrame:
    """Return on experience and on education in the latest edition."""
    return (
        latest_edition(pay)
        .transform(_pay_cut, "tempo_experiencia_dados", "nivel_ensino")
        .select("recorte", "dimensao_1", "respondentes", F.col(PAY).alias("salario"))
        .orderBy("recorte", F.col("salario").desc())
    )


def female_share(diversity: DataFrame) -> DataFrame:
    """Share of women among women and men, by seniority, over all editions."""
    counted = diversity.groupBy("senioridade").agg(
        _count_if_label("genero", ["Feminino"]).alias("mulheres"),
        _count_if_label("genero", ["Masculino"]).alias("homens"),
    )
    return counted.withColumn(
        "pct_feminino", rate(F.col("mulheres"), F.col("mulheres") + F.col("homens"), 1)
    ).orderBy(F.col("pct_feminino").desc())


def pay_gap(diversity: DataFrame) -> DataFrame:
    """Pay of women against men at the same level, in the latest edition."""
    sides = latest_edition(diversity).groupBy("senioridade").agg(
        F.max(F.when(F.col("genero") == "Masculino", F.col(PAY))).alias("salario_masc"),
        F.max(F.when(F.col("genero") == "Feminino", F.col(PAY))).alias("salario_fem"),
    )
    gap = F.round(
        100 * (F.col("salario_fem") - F.col("salario_masc"))
        / F.nullif(F.col("salario_masc"), F.lit(0.0)), 1
    )
    return (
        sides.where(F.col("salario_masc").isNotNull() & F.col("salario_fem").isNotNull())
        .withColumn("diferenca_pct", gap)
        .orderBy("diferenca_pct")
    )


def top_tech(technology: DataFrame, k: int = 10) -> DataFrame:
    """Most adopted items of each question in the latest edition."""
    return (
        top_per_category(latest_edition(technology), k)
        .select(
            "categoria", "tecnologia", "respondentes", "base_resposta", "taxa_adocao", "posicao"
        )
        .orderBy("categoria", "posicao")
    )


def tech_growth(
    technology: DataFrame, categories: Sequence[str] | None = None, threshold: float = 5.0
) -> DataFrame:
    """Change in adoption between the first and the last edition, in percentage points.

    Compares the given questions, or else those the comparability guard lets through.
    """
    if categories is None:
        kept = technology.join(
            comparable_categories(technology).select("categoria"), "categoria", "left_semi"
        )
    else:
        kept = technology.where(F.col("categoria").isin(*categories))
    limits = kept.agg(F.min("ano").alias("ano_ini"), F.max("ano").alias("ano_fim"))
    compared = (
        kept.crossJoin(limits)  # one row
        .groupBy("categoria", "tecnologia")
        .agg(
            F.max(F.when(F.col("ano") == F.col("ano_ini"), F.col("taxa_adocao"))).alias(
                "adocao_inicial"
            ),
            F.max(F.when(F.col("ano") == F.col("ano_fim"), F.col("taxa_adocao"))).alias(
                "adocao_final"
            ),
        )
    )
    first, last = F.col("adocao_inicial"), F.col("adocao_final")
    return (
        compared.where(
            first.isNotNull() & last.isNotNull() & ((first >= threshold) | (last >= threshold))
        )
        .withColumn("variacao_pp", F.round(last - first, 2))
        .orderBy(F.col("variacao_pp").desc(), "categoria", "tecnologia")
    )


def comparability(technology: DataFrame, editions: Sequence[int]) -> DataFrame:
    """Items per answerer of each question by edition: a jump means the question changed."""
    last = F.when(F.col("ano") == editions[-1], F.col("base_resposta"))
    return (
        technology.groupBy("categoria")
        .agg(
            *per_edition(F.col("itens_por_respondente"), editions, "itens"),
            F.max(last).alias(f"base_{editions[-1]}"),
        )
        .orderBy("categoria")
    )


def adoption_by_level(ai: DataFrame) -> DataFrame:
    """AI adoption by seniority where the question was answered."""
    return (
        ai.where(F.col("base_resposta") > 0)
        .select("ano", "senioridade", "base_resposta", "taxa_adocao_ia")
        .orderBy("ano", F.col("taxa_adocao_ia").desc())
    )


def impact_by_level(impact: DataFrame) -> DataFrame:
    """Pay and sample of AI users beside non-users, sufficient samples only."""

    def of(group: str, column: str) -> Column:
        return F.max(F.when(F.col("grupo") == group, F.col(column)))

    user, other = fixed.AI_GROUP_USER, fixed.AI_GROUP_NON_USER
    return (
        impact.where(F.col("amostra_suficiente"))
        .groupBy("ano", "senioridade")
        .agg(
            of(user, PAY).alias("salario_usa_ia"),
            of(other, PAY).alias("salario_nao_usa_ia"),
            of(user, "respondentes").alias("n_usa_ia"),
            of(other, "respondentes").alias("n_nao_usa_ia"),
        )
        .orderBy("ano", "senioridade")
    )


def use_type_share(respondents: DataFrame) -> DataFrame:
    """Kinds of AI use per edition, as a share of the people who named one."""
    counted = (
        respondents.where(F.col("tipo_uso_ia").isNotNull())
        .groupBy("ano", "tipo_uso_ia")
        .agg(F.count(F.lit(1)).alias("respondentes"))
    )
    total = F.sum("respondentes").over(Window.partitionBy("ano"))
    return counted.withColumn(
        "pct_do_ano", F.round(100 * F.col("respondentes") / total, 2)
    ).orderBy("ano", F.col("respondentes").desc())


def region_work_model(work_model: DataFrame) -> DataFrame:
    """Work models by region in the latest edition."""
    return (
        latest_edition(work_model)
        .where(
            (F.col("regiao") != fixed.NOT_INFORMED)
            & (F.col("forma_trabalho") != fixed.NOT_INFORMED)
        )
        .select(
            "ano", "regiao", "forma_trabalho", "respondentes", "percentual",
            F.col(PAY).alias("salario"),
        )
        .orderBy("regiao", F.col("respondentes").desc())
    )


def region_share(pay: DataFrame, informed_only: bool = False) -> DataFrame:
    """Share of respondents and pay by region.

    The share is of everybody with pay; with ``informed_only`` of those who gave a region.
    """
    rows = pay.where(F.col("recorte") == "regiao")
    informed = F.col("dimensao_1") != fixed.NOT_INFORMED
    if informed_only:
        rows = rows.where(informed)
    total = F.sum("respondentes").over(Window.partitionBy("ano"))
    return (
        rows.withColumn("pct_do_ano", F.round(100 * F.col("respondentes") / total, 2))
        .where(informed)
        .select(
            "ano", F.col("dimensao_1").alias("regiao"), "respondentes", "pct_do_ano",
            F.col(PAY).alias("salario"),
        )
        .orderBy("ano", F.col("respondentes").desc())
    )


def work_model_pay(pay: DataFrame, editions: Sequence[int]) -> DataFrame:
    """Pay by work model, editions side by side."""
    last = F.when(F.col("ano") == editions[-1], F.col("respondentes"))
    return (
        pay.where(
            (F.col("recorte") == "forma_trabalho")
            & (F.col("dimensao_1") != fixed.NOT_INFORMED)
            & F.col("amostra_suficiente")
        )
        .groupBy(F.col("dimensao_1").alias("forma_trabalho"))
        .agg(
            *per_edition(F.col(PAY), editions, "salario"),
            F.max(last).alias(f"n_{editions[-1]}"),
        )
        .orderBy(F.col(f"salario_{editions[-1]}").desc())
    )


def sector_pay(pay: DataFrame) -> DataFrame:
    """Pay by sector in the latest edition, sufficient samples only."""
    return (
        latest_edition(pay)
        .transform(_pay_cut, "setor_empresa")
        .select(F.col("dimensao_1").alias("setor"), "respondentes", F.col(PAY).alias("salario"))
        .orderBy(F.col("salario").desc())
    )
