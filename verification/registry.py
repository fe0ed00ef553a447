"""Registered queries: every operator and report on the given tables.

Pay is rounded to two decimals here, at the edge, as reports show it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import bands, text
from surveyloom.functions import categories as cat
from surveyloom.functions.multi import split_top_level
from surveyloom.operators import answers, grouped, headers, shares
from surveyloom.operators.cuts import multi_cut
from surveyloom.plans import chart_frames as charts
from surveyloom.plans import gold, reports
from surveyloom.plans.silver import align_union
from surveyloom.sources.bronze import with_respondent_key
from verification import raw_editions, sql_layer
from verification import star_survey as star
from verification.star_survey import editions_of, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _orders(
    spark: SparkSession, sf: str, name: str, raw: Column, rule: Callable[[Column], Column]
) -> DataFrame:
    """A rule over raw text of each order. The text is a column of its own, so that it is built
    once however often the rule reads it."""
    texts = table(spark, sf, "orders").select("o_orderkey", raw.alias("texto"))
    return texts.select("o_orderkey", rule(F.col("texto")).alias(name))


# Scalar functions


@query
def norm_text(spark, sf):
    plain = table(spark, sf, "documents").select(
        "doc_id", text.normalise(F.col("text")).alias("texto")
    )
    return plain.select(
        "doc_id", F.md5("texto").alias("texto_md5"), F.length("texto").alias("tamanho")
    )


@query
def snake_text(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.snake_case(F.col("text"))).alias("texto_md5")
    )


@query
def missing_tokens(spark, sf):
    raw = star.by_remainder(
        "o_orderkey", 10, "NaN", "None", "null", "<NA>", "NaT", " na ", "-", "--", None,
        "Resposta",
    )
    return _orders(spark, sf, "texto", raw, text.normalise)


@query
def code_normalise(spark, sf):
    size, letter = F.col("p_size").cast("string"), F.left(F.col("p_type"), F.lit(1))
    number = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    key = F.col("p_partkey")
    raw = (
        F.when(key % 4 == 0, F.concat(F.lit("P"), size, F.lit("_"), letter, F.lit(" ")))
        .when(key % 4 == 1, F.concat_ws("_", F.concat(F.lit(" p"), size), letter, number))
        .when(key % 4 == 2, F.concat(F.lit("."), size, F.lit(".."), letter, F.lit(".")))
    )
    texts = table(spark, sf, "part").select("p_partkey", raw.alias("texto"))
    return texts.select("p_partkey", text.normalise_code(F.col("texto")).alias("codigo"))


@query
def text_to_integer(spark, sf):
    order, age = F.col("o_orderkey"), (20 + F.col("o_custkey") % 40).cast("string")
    raw = (
        F.when(order % 9 == 0, F.lit("n/d"))
        .when(order % 9 == 1, F.concat(age, F.lit(".0")))
        .when(order % 9 == 2, F.concat(age, F.lit("d")))
        .when(order % 9 == 3, F.concat(age, F.lit("f")))
        .otherwise(F.concat(F.lit(" "), age, F.lit(" ")))
    )
    return _orders(spark, sf, "idade", raw, text.to_integer)


@query
def display_label(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.display_label(F.col("text")).alias("rotulo")
    )


@query
def band_numbers(spark, sf):
    price = F.format_number(F.floor("o_totalprice"), 0)
    raw = F.concat(F.lit("r$ "), price, F.lit(" a "), F.col("o_custkey"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.explode(bands.band_numbers(raw)).alias("numero")
    )


@query
def band_limits(spark, sf):
    raw = star.band_text(F.col("o_totalprice"))
    normal = _orders(spark, sf, "faixa", raw, text.normalise)
    return bands.with_band_limits(normal, "faixa").drop("faixa")


@query
def band_midpoint(spark, sf):
    raw = star.band_text(F.col("o_totalprice"))
    return _orders(spark, sf, "salario_mensal_estimado", raw, bands.band_midpoint)


@query
def std_seniority(spark, sf):
    return _orders(spark, sf, "senioridade", F.expr(star.SENIORITY_TEXT), cat.standard_seniority)


@query
def fill_manager(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(star.SENIORITY_TEXT).alias("nivel"), F.expr(star.MANAGER_TEXT).alias("gestor")
    )
    level = raw.withColumn("nivel", cat.standard_seniority(F.col("nivel")))
    return level.select(
        "o_orderkey", cat.fill_manager(F.col("nivel"), F.col("gestor")).alias("senioridade")
    )


@query
def std_work_model(spark, sf):
    raw = F.expr(star.WORK_MODEL_TEXT)
    return _orders(spark, sf, "forma_trabalho", raw, cat.standard_work_model)


@query
def std_gender(spark, sf):
    return _orders(spark, sf, "genero", F.expr(star.GENDER_TEXT), cat.standard_gender)


@query
def to_binary(spark, sf):
    return _orders(spark, sf, "atua_como_gestor", F.expr(star.MANAGER_TEXT), cat.to_binary)


@query
def flag_use(spark, sf):
    return _orders(spark, sf, "usa_ia", F.expr(star.AI_TEXT), cat.flag_use)


@query
def classify_use(spark, sf):
    return _orders(spark, sf, "tipo_uso_ia", F.expr(star.AI_TEXT), cat.classify_use)


@query
def std_region(spark, sf):
    return star.derived_respondents(spark, sf).select("id_respondente", "regiao")


@query
def region_of_state(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    state = F.expr(star.RAW_TEXTS["uf_moradia"])
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", state.alias("uf")
    )
    return located.select("c_custkey", cat.region_of_state(F.col("uf")).alias("regiao"))


@query
def canonical_region(spark, sf):
    raw = star.by_remainder(
        "c_custkey", 3, " SUDESTE", "centro-OESTE ", "Exterior")
    texts = table(spark, sf, "customer").select("c_custkey", raw.alias("texto"))
    return texts.select(
        "c_custkey", cat.canonical_region(F.col("texto"), F.lit(None)).alias("regiao")
    )


# Silver


@query
def split_multi(spark, sf):
    items = star.order_answers(spark, sf).select(
        "id_respondente", F.explode(split_top_level(F.col("banco_dados"))).alias("tecnologia")
    )
    return items.groupBy("id_respondente", "tecnologia").agg(
        F.count(F.lit(1)).alias("mencoes")
    )


@query
def melt_multi(spark, sf):
    return star.derived_answers(spark, sf).groupBy(
        "ano", "id_respondente", "categoria", "tecnologia"
    ).agg(F.count(F.lit(1)).alias("mencoes"))


@query
def silver_respondents(spark, sf):
    return star.derived_respondents(spark, sf).select(
        "ano", "id_respondente", "idade", "genero", "regiao", "nivel_ensino", "setor_empresa",
        "cargo", "senioridade", "tempo_experiencia_dados", "forma_trabalho", "atua_como_gestor",
        "usa_ia", "tipo_uso_ia", "faixa_inferior", "faixa_superior", "salario_mensal_estimado",
    )


@query
def silver_join(spark, sf):
    people = star.survey_respondents(spark, sf).select("ano", "id_respondente", "senioridade")
    joined = people.join(star.survey_answers(spark, sf), ["ano", "id_respondente"])
    per_person = joined.groupBy("ano", "senioridade", "categoria", "id_respondente").agg(
        F.count(F.lit(1)).alias("mencoes")
    )
    return per_person.groupBy("ano", "senioridade", "categoria").agg(
        F.sum("mencoes").alias("mencoes"), F.count(F.lit(1)).alias("pessoas")
    )


@query
def align_editions(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.lit(1).alias("ano"), F.col("c_name").alias("nome"), F.col("c_acctbal").alias("saldo"),
        F.col("c_mktsegment").alias("segmento"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.lit(2).alias("ano"), F.col("s_name").alias("nome"), F.col("s_acctbal").alias("saldo")
    )
    part = table(spark, sf, "part").select(
        F.col("p_size").alias("tamanho"), F.lit(3).alias("ano"), F.col("p_name").alias("nome")
    )
    return align_union([customer, supplier, part])


REGISTRY["align_union"] = REGISTRY.pop("align_editions")


@query
def respondent_key(spark, sf):
    keyed = with_respondent_key(table(spark, sf, "orders"), 2025)
    # One row per key first: a repeated key would lower the second count.
    per_key = keyed.groupBy("o_orderstatus", "id_respondente").agg(
        F.count(F.lit(1)).alias("linhas")
    )
    return per_key.groupBy("o_orderstatus").agg(
        F.sum("linhas").alias("linhas"), F.count(F.lit(1)).alias("chaves")
    )


# Column metadata


@query
def header_parse(spark, sf):
    return headers.parse_headers(star.part_headers(spark, sf)).select(
        "ano", "posicao", "codigo_questao", "rotulo"
    )


@query
def header_index(spark, sf):
    return headers.header_index(star.part_headers(spark, sf))


def _plan(spark, sf):
    return headers.column_plan(star.part_headers(spark, sf), star.supplier_mapping(spark, sf))


@query
def column_plan(spark, sf):
    return _plan(spark, sf)


@query
def plan_report(spark, sf):
    return headers.plan_report(star.part_headers(spark, sf), _plan(spark, sf))


@query
def critical_gate(spark, sf):
    return headers.critical_missing(_plan(spark, sf), lambda field: field.endswith("1"))


@query
def header_inventory(spark, sf):
    return headers.header_inventory(star.part_headers(spark, sf))


# Grouped statistics


@query
def band_histogram(spark, sf):
    return grouped.band_histogram(star.survey_respondents(spark, sf), ["ano", "regiao"])


@query
def grouped_median_region(spark, sf):
    """Flagship: pay by year and region, with share of the year and sample flag."""
    medians = grouped.grouped_median(
        star.survey_respondents(spark, sf), ["ano", "regiao"], name="salario", digits=2
    )
    return shares.sample_flag(shares.share_of(medians, ["ano"], name="pct_do_ano"))


@query
def grouped_median_role(spark, sf):
    return grouped.grouped_median(
        star.survey_respondents(spark, sf), ["ano", "cargo"], digits=2
    )


@query
def share_of_group(spark, sf):
    counted = star.survey_respondents(spark, sf).groupBy("ano", "forma_trabalho").agg(
        F.count(F.lit(1)).alias("respondentes")
    )
    return shares.share_of(counted, ["ano"])


def _small_groups(spark, sf):
    counted = star.survey_respondents(spark, sf).groupBy(
        "ano", "cargo", "senioridade", "genero"
    ).agg(F.count(F.lit(1)).alias("respondentes"))
    return shares.sample_flag(counted)


@query
def sample_flag(spark, sf):
    return _small_groups(spark, sf)


@query
def sufficient_or_all(spark, sf):
    return shares.sufficient_or_all(_small_groups(spark, sf), ["ano", "cargo"]).drop(
        "amostra_suficiente"
    )


@query
def pay_quartiles_exact(spark, sf):
    people = star.survey_respondents(spark, sf)
    return multi_cut(people, digits=4, exact_interpolation=True).select(
        "ano", "recorte", "dimensao_1", "dimensao_2", "salario_mediano", "p25", "p75"
    )


@query
def pay_quartiles_approx(spark, sf):
    return grouped.approximate_quartiles(star.survey_respondents(spark, sf), ["ano", "regiao"])


# Gold


@query
def gold_profile(spark, sf):
    return gold.profile(star.survey_respondents(spark, sf), digits=2)


@query
def gold_pay_cuts(spark, sf):
    return gold.pay(star.survey_respondents(spark, sf), digits=2)


@query
def gold_diversity(spark, sf):
    return gold.diversity(star.survey_respondents(spark, sf), digits=2)


@query
def gold_adoption(spark, sf):
    return gold.technology(star.lineitem_answers(spark, sf), star.edition_members(spark, sf))


@query
def gold_adoption_answers(spark, sf):
    return gold.technology(star.survey_answers(spark, sf), star.edition_members(spark, sf))


@query
def gold_adoption_lists(spark, sf):
    return gold.technology_of_lists(
        star.survey_answer_lists(spark, sf), star.edition_members(spark, sf)
    )


@query
def gold_adoption_flag(spark, sf):
    return gold.ai_adoption(star.survey_respondents(spark, sf))


@query
def gold_impact(spark, sf):
    return gold.ai_impact(star.survey_respondents(spark, sf), digits=2)


@query
def gold_work_model(spark, sf):
    return gold.work_model(star.survey_respondents(spark, sf), digits=2)


@query
def items_per_answerer(spark, sf):
    return answers.items_per_answerer(star.survey_answers(spark, sf))


@query
def adoption_rank(spark, sf):
    return gold_adoption(spark, sf).select("ano", "categoria", "tecnologia", "posicao")


@query
def topk_per_category(spark, sf):
    return answers.top_per_category(gold_adoption(spark, sf)).select(
        "ano", "categoria", "tecnologia", "respondentes", "posicao"
    )


# Reports and chart frames: (name, gold or silver input, report)


def _register(name: str, source: Query, report: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf: report(stored_gold(source, spark, sf))


def stored_gold(source: Query, spark: SparkSession, sf: str) -> DataFrame:
    """A gold table as the pipeline leaves it: written once, partitioned by edition.

    Reports then read some rows of a small table; "latest edition" prunes partitions, and nothing
    below a report goes back to respondents or answers. Silver sources are stored already.
    """
    if source.__name__ in REGISTRY:
        return star.stored(source.__name__, source, spark, sf)
    return source(spark, sf)


def _with_editions(report):
    return lambda df: report(df, editions_of(df))


for _name, _source, _report in (
    ("coverage", star.survey_respondents, reports.coverage),
    ("mix_by_year", gold_profile, _with_editions(reports.mix_by_year)),
    ("top_roles", gold_profile, reports.top_roles),
    ("pay_by_role", gold_pay_cuts, reports.pay_by_role),
    ("pay_progress", gold_pay_cuts, _with_editions(reports.pay_progress)),
    ("pay_return", gold_pay_cuts, reports.pay_return),
    ("female_share", gold_diversity, reports.female_share),
    ("pay_gap", gold_diversity, reports.pay_gap),
    ("top_tech", gold_adoption, reports.top_tech),
    ("tech_growth", gold_adoption_lists, reports.tech_growth),
    (
        "tech_growth_listed", gold_adoption,
        lambda df: reports.tech_growth(df, ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]),
    ),
    ("comparability", gold_adoption_lists, _with_editions(reports.comparability)),
    ("adoption_by_level", gold_adoption_flag, reports.adoption_by_level),
    ("impact_by_level", gold_impact, reports.impact_by_level),
    ("use_type_share", star.survey_respondents, reports.use_type_share),
    ("region_work_model", gold_work_model, reports.region_work_model),
    ("region_share", gold_pay_cuts, reports.region_share),
    (
        "region_share_informed", gold_pay_cuts,
        lambda df: reports.region_share(df, informed_only=True),
    ),
    ("work_model_pay", gold_pay_cuts, _with_editions(reports.work_model_pay)),
    ("sector_pay", gold_pay_cuts, reports.sector_pay),
    ("pivot_share", gold_profile, charts.seniority_mix),
    ("top_role_bars", gold_profile, charts.top_role_bars),
    ("pivot_pay", gold_pay_cuts, charts.pay_by_level),
    ("pay_by_region", gold_pay_cuts, charts.pay_by_region),
    ("pay_by_work_model", gold_pay_cuts, _with_editions(charts.pay_by_work_model)),
    ("best_paid_roles", gold_pay_cuts, charts.best_paid_roles),
    ("pay_by_experience", gold_pay_cuts, charts.pay_by_experience),
    ("top_tech_bars", gold_adoption_lists, charts.top_tech_bars),
    ("trend_comparable", gold_adoption_lists, charts.adoption_trend),
    ("ai_by_level", gold_adoption_flag, _with_editions(charts.ai_by_level)),
    (
        "ai_pay_by_level", gold_impact,
        lambda df: charts.ai_pay_by_level(df).withColumns(
            {
                c: F.round(c, 2) for c in ("salario_nao_usa_ia", "salario_usa_ia")
            }
        ),
    ),
    ("gender_mix", gold_diversity, charts.gender_mix),
    ("pay_gap_pivot", gold_diversity, charts.pay_gap_bars),
    ("female_share_bars", gold_diversity, charts.female_share_bars),
    ("work_model_pivot", gold_work_model, charts.work_model_mix),
):
    _register(_name, _source, _report)


for _query in (*raw_editions.QUERIES, *sql_layer.QUERIES):
    query(_query)


@query
def median_of_bands(spark, sf):
    histogram = grouped.band_histogram(star.survey_respondents(spark, sf), ["ano", "cargo"])
    bands_of = F.collect_list(F.struct("faixa_inferior", "faixa_superior", "na_faixa"))
    return histogram.groupBy("ano", "cargo").agg(
        F.round(grouped.median_of_bands(bands_of), 2).alias("salario_mediano_interpolado")
    )
