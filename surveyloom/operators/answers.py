"""Multi-answer questions: wide text columns to a long table, and adoption rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.multi import split_pieces, split_top_level
from surveyloom.functions.text import holds_text, strip_spaces
from surveyloom.operators.shares import rate


def answer_texts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """One row per respondent and question with a text: ``(keys, categoria, resposta)``.

    ``columns`` maps a category to the column that holds its text. All categories come out of one
    scan; each row carries its own answers, so nothing is shuffled.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(category).alias("categoria"), F.col(f"`{column}`").alias("resposta"))
            for category, column in columns.items()
        ]
    )
    return df.select(*keys, F.inline(pairs)).where(F.col("resposta").isNotNull())


def answer_lists(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """One row per respondent and answered question: ``(keys, categoria, itens)``."""
    return (
        answer_texts(df, keys, columns)
        .select(*keys, "categoria", split_top_level(F.col("resposta")).alias("itens"))
        .where(F.size("itens") > 0)
    )


def melt_answers(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Long table ``(keys, categoria, tecnologia)`` with one row per item named.

    The split is compiled in a projection of its own; in a generator it would be interpreted. An outer
    generator keeps the optimizer from splitting again to see whether there are items. Blank items are
    dropped unstripped.
    """
    split = answer_texts(df, keys, columns).select(
        *keys, "categoria", split_pieces(F.col("resposta")).alias("itens")
    )
    items = split.select(*keys, "categoria", F.explode_outer("itens").alias("item"))
    named = items.where(holds_text(F.col("item")))
    return named.select(*keys, "categoria", strip_spaces(F.col("item")).alias("tecnologia"))


def _rank_within_category() -> Column:
    # Names break ties, so that the rank does not depend on the order of rows.
    order = Window.partitionBy("ano", "categoria").orderBy(
        F.col("respondentes").desc(), F.col("tecnologia").asc()
    )
    return F.row_number().over(order)


def _adoption_columns(counted: DataFrame, totals: DataFrame) -> DataFrame:
    return (
        counted.join(totals, "ano", "left")
        .withColumn(
            "itens_por_respondente",
            F.round(F.col("total_mencoes") / F.col("base_resposta"), 2),
        )
        .withColumn("taxa_adocao", rate(F.col("respondentes"), F.col("base_resposta")))
        .withColumn("posicao", _rank_within_category())
        .select(
            "ano", "categoria", "tecnologia", "respondentes", "base_resposta",
            "itens_por_respondente", "total_respondentes", "taxa_adocao", "posicao",
        )
    )


def edition_totals(respondents: DataFrame) -> DataFrame:
    return respondents.groupBy("ano").agg(F.count(F.lit(1)).alias("total_respondentes"))


def adoption(items: DataFrame, respondents: DataFrame) -> DataFrame:
    """Adoption of each item among the people who answered its question, from the long table.

    A person who names an item twice is one adopter with two mentions. Both distinct counts start
    from one de-duplicated frame, whose shuffle Spark reuses; every step combines before it
    shuffles, so a person or item that fills a third of the table does not fill one task.
    """
    person = ["ano", "categoria", "id_respondente"]
    once = items.groupBy(*person, "tecnologia").agg(F.count(F.lit(1)).alias("mencoes"))
    per_item = (
        once.groupBy("ano", "categoria", "tecnologia")
        .agg(F.count_if(F.col("mencoes") > 0).alias("respondentes"))
    )
    # Both branches read the mentions and the join is null-safe, which adds no filter to one side:
    # so both need exactly the same ``once``, and Spark computes and shuffles it a single time.
    base = (
        once.groupBy(*person)
        .agg(F.sum("mencoes").alias("mencoes"))
        .groupBy("ano", "categoria")
        .agg(
            F.count_if(F.col("mencoes") > 0).alias("base_resposta"),
            F.sum("mencoes").alias("total_mencoes"),
        )
        .withColumnsRenamed({"ano": "ano_base", "categoria": "categoria_base"})
    )
    same_question = F.col("ano").eqNullSafe(F.col("ano_base")) & F.col("categoria").eqNullSafe(
        F.col("categoria_base")
    )
    counted = per_item.join(base, same_question, "left").drop("ano_base", "categoria_base")
    return _adoption_columns(counted, edition_totals(respondents))


def adoption_of_lists(lists: DataFrame, respondents: DataFrame) -> DataFrame:
    """``adoption`` from one row per respondent and question, as ``answer_lists`` gives them.

    With a respondent's whole answer in one row the de-duplication is local (``array_distinct``),
    and nothing but counts is shuffled. The totals of a question are an aggregate of their own over
    the stored lists, a few rows, so no task holds all items of a question for them.
    """
    per_item = (
        lists.select("ano", "categoria", F.explode(F.array_distinct("itens")).alias("tecnologia"))
        .groupBy("ano", "categoria", "tecnologia")
        .agg(F.count(F.lit(1)).alias("respondentes"))
    )
    base = lists.where(F.size("itens") > 0).groupBy(
        F.col("ano").alias("ano_base"), F.col("categoria").alias("categoria_base")
    ).agg(
        F.count(F.lit(1)).alias("base_resposta"),
        F.sum(F.size("itens")).alias("total_mencoes"),
    )
    same_question = F.col("ano").eqNullSafe(F.col("ano_base")) & F.col("categoria").eqNullSafe(
        F.col("categoria_base")
    )
    counted = per_item.join(base, same_question, "left").drop("ano_base", "categoria_base")
    return _adoption_columns(counted, edition_totals(respondents))


def items_per_answerer(items: DataFrame) -> DataFrame:
    """Mentions, answerers and mentions per answerer of each question and edition."""
    return (
        items.groupBy("ano", "categoria", "id_respondente")
        .agg(F.count(F.lit(1)).alias("mencoes"))
        .groupBy("ano", "categoria")
        .agg(
            F.count(F.lit(1)).alias("base_resposta"),
            F.sum("mencoes").alias("total_mencoes"),
        )
        .withColumn(
            "itens_por_respondente",
            F.round(F.col("total_mencoes") / F.col("base_resposta"), 2),
        )
    )


def top_per_category(adopted: DataFrame, k: int = 10) -> DataFrame:
    """The k most named items of each question and edition."""
    return adopted.where(F.col("posicao") <= k)


def comparable_categories(
    adopted: DataFrame, tolerance: float = 0.5, minimum_editions: int = 2
) -> DataFrame:
    """Questions asked alike in several editions.

    A question whose items per answerer move by more than ``tolerance`` changed its format
    (single choice to multiple choice), so its rates cannot be compared over time.
    """
    per_year = adopted.groupBy("categoria", "ano").agg(
        F.max("itens_por_respondente").alias("itens")
    )
    return (
        per_year.groupBy("categoria")
        .agg(
            F.count(F.lit(1)).alias("edicoes"),
            (F.max("itens") - F.min("itens")).alias("variacao_itens"),
        )
        .where((F.col("edicoes") >= minimum_editions) & (F.col("variacao_itens") <= tolerance))
    )
