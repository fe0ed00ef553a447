"""The survey view in the catalog: reports as SQL text, SQL functions, buckets, sketches, ranks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.sql_functions import register_functions
from surveyloom.operators import grouped, sketches
from surveyloom.operators.ranks import rank_in_groups
from surveyloom.plans import gold
from surveyloom.plans.silver import respondents
from surveyloom.plans.sql_reports import REPORTS, report_sql, run_report
from surveyloom.sources import sinks
from verification import star_survey as star

_databases: dict[tuple, str] = {}
_published: set[tuple[str, str]] = set()


def location_of(stored: DataFrame) -> str:
    """Folder of a stored table with editions."""
    return stored.inputFiles()[0].split("/ano=")[0]


def database(spark: SparkSession, sf_dir: str, wanted: Collection[str]) -> str:
    """Database with stored silver and gold tables of the view; each is registered when first wanted."""
    name = _databases.setdefault(star.version(spark, sf_dir), f"relatorios_{uuid.uuid4().hex}")

    def people() -> DataFrame:
        return star.survey_respondents(spark, sf_dir)

    tables = {
        "gold_perfil_mercado": lambda: gold.profile(people(), digits=2),
        "gold_remuneracao": lambda: gold.pay(people(), digits=2),
        "gold_diversidade": lambda: gold.diversity(people(), digits=2),
        "gold_tecnologias": lambda: gold.technology_of_lists(
            star.survey_answer_lists(spark, sf_dir), star.edition_members(spark, sf_dir)
        ),
        "gold_adocao_ia": lambda: gold.ai_adoption(people()),
        "gold_impacto_ia": lambda: gold.ai_impact(people(), digits=2),
        "gold_modelo_trabalho": lambda: gold.work_model(people(), digits=2),
        "silver_respondentes": people,
        "silver_tecnologias": lambda: star.survey_answers(spark, sf_dir),
    }
    for table in wanted:
        if (name, table) in _published:
            continue
        df = tables[table]()
        if not table.startswith("silver_"):
            df = star.stored(f"catalogo_{table}", lambda *_, df=df: df, spark, sf_dir)
        sinks.publish(spark, name, table, df, location_of(df))
        _published.add((name, table))
    return name


def tables_of(report: str) -> set[str]:
    """Tables that the text of a report names, with the profile where its columns follow the editions."""
    text = report_sql(report, "silver_", "gold_", editions=[0])
    named = set(re.findall(r"\b(?:silver|gold)_\w+", text))
    return named if isinstance(REPORTS[report], str) else named | {"gold_perfil_mercado"}


def _report(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        place = database(spark, sf_dir, tables_of(name))
        return run_report(spark, name, f"{place}.silver_", f"{place}.gold_")

    run.__name__ = f"sql_{name}"
    return run


def sql_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median pay by role, called from SQL over the histogram of a view."""
    register_functions(spark)
    people = star.survey_respondents(spark, sf_dir)
    histogram = grouped.band_histogram(people, ["ano", "cargo"])
    return spark.sql(
        """SELECT ano, cargo, round(mediana, 2) AS salario_mediano_interpolado FROM (
             SELECT ano, cargo, mediana_interpolada(collect_list(struct(
               faixa_inferior, faixa_superior, na_faixa))) AS mediana
             FROM {histograma} GROUP BY ano, cargo)""",
        histograma=histogram,
    )


def sql_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases named by each respondent, split in SQL."""
    register_functions(spark)
    return spark.sql(
        """SELECT id_respondente, tecnologia, count(*) AS mencoes FROM (
             SELECT id_respondente, separar_respostas(banco_dados) AS itens FROM {respostas})
           LATERAL VIEW explode(itens) AS tecnologia
           GROUP BY id_respondente, tecnologia""",
        respostas=star.order_answers(spark, sf_dir),
    )


_buckets: dict[tuple, str] = {}


def silver_join_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions and people by level and question, over silver stored in buckets by respondent.

    Raw answers are dealt to the buckets, and silver is derived and stored there, whole, in one job a
    table; silver that is stored already is dealt instead. Buckets follow the number of people. Join
    and count of each person's mentions follow the buckets; only level totals are shuffled. Keys
    are unique over editions, so the key alone joins.
    """
    key = star.version(spark, sf_dir)
    if key not in _buckets:
        name = f"baldes_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name}")
        buckets = sinks.buckets_for(star.table(spark, sf_dir, "orders").count())
        for table, raw, rules in (
            ("respondentes", star.raw_survey, respondents),
            ("tecnologias", star.order_answers, star.melted),
        ):
            silver = star.if_stored(table, spark, sf_dir)
            df = rules(raw(spark, sf_dir).repartition(buckets, "id_respondente")) if silver is None else silver
            sinks.store_in_buckets(df, f"{name}.{table}", buckets=buckets, dealt=silver is None)
        _buckets[key] = name
    people = spark.table(f"{_buckets[key]}.respondentes").select("ano", "id_respondente", "senioridade")
    items = spark.table(f"{_buckets[key]}.tecnologias").select("id_respondente", "categoria")
    per_person = people.hint("merge").join(items, "id_respondente").groupBy(
        "ano", "senioridade", "categoria", "id_respondente"
    ).agg(F.count(F.lit(1)).alias("mencoes"))
    return per_person.groupBy("ano", "senioridade", "categoria").agg(
        F.sum("mencoes").alias("mencoes"), F.count(F.lit(1)).alias("pessoas")
    )


def adoption_rank_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of each item by respondents, sorted over all tasks instead of one for each question."""
    counted = star.lineitem_answers(spark, sf_dir).distinct().groupBy(
        "ano", "categoria", "tecnologia"
    ).agg(F.count(F.lit(1)).alias("respondentes"))
    order = [F.col("respondentes").desc(), F.col("tecnologia").asc()]
    ranked = rank_in_groups(counted, ["ano", "categoria"], order)
    return ranked.select("ano", "categoria", "tecnologia", "posicao")


def adopters_over_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who named an item in any edition: counted, and from the editions' stored sketches."""
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_respondente"), F.col("o_custkey").alias("cliente")
    )
    named = star.lineitem_answers(spark, sf_dir).join(orders, "id_respondente")
    stored = star.stored(
        "esbocos", lambda *_: sketches.people_sketches(named, person="cliente"), spark, sf_dir
    )
    exact = named.select("categoria", "tecnologia", "cliente").distinct().groupBy(
        "categoria", "tecnologia"
    ).agg(F.count(F.lit(1)).alias("pessoas"))
    both = exact.join(sketches.united_people(stored), ["categoria", "tecnologia"])
    # Five standard errors, and two for rounding where there are few.
    bound = 5 * sketches.STANDARD_ERROR * F.col("pessoas") + 2
    return both.select(
        "categoria", "tecnologia", "pessoas", "edicoes",
        (F.abs(F.col("pessoas_aprox") - F.col("pessoas")) <= bound).alias("perto"),
    )


QUERIES = (
    *map(_report, REPORTS), sql_median, sql_split, silver_join_buckets, adoption_rank_range,
    adopters_over_editions,
)
