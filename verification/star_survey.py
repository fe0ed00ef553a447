"""A survey view over the star schema, so that every operator runs on the given tables.

Each order is a respondent and its year the edition. Answers are raw questionnaire text derived
from columns of the order and its customer; nothing is sampled or cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.answers import answer_lists, melt_answers
from surveyloom.plans.silver import respondents
from surveyloom.sources.workspace import changed_at, written

# State of each nation key.
STATES = (
    "AC AP AM PA RO RR TO AL BA CE MA PB PE PI RN SE DF GO MT MS ES MG RJ SP PR".split()
)

NOT_USED = "Não utilizo nenhum tipo de solução, por enquanto"
FREE = "Utilizo apenas soluções gratuitas (por exemplo, um chat), no dia a dia"
PAID = "Utilizo soluções pagas (por exemplo, assinatura), no trabalho"
CODE = "Utilizo soluções no estilo Copilot (editor, terminal)"

ANSWER_COLUMNS = ("linguagem_preferida", "banco_dados", "cloud_uso", "ferramenta_bi")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def editions_of(df: DataFrame) -> tuple[int, ...]:
    """Editions of a stored table: the values of its partition column, a handful."""
    return tuple(sorted(r["ano"] for r in df.select("ano").distinct().collect()))


def quoted(text: str | None) -> str:
    """SQL literal of a text; None is NULL."""
    return "CAST(NULL AS STRING)" if text is None else "'" + text.replace("'", "\\'") + "'"


def by_remainder(number: str, modulus: int, *choices: str | None) -> Column:
    """Text picked by the remainder of a number, which is given as SQL."""
    return F.expr(remainder_sql(number, modulus, *choices))


def remainder_sql(number: str, modulus: int, *choices: str | None) -> str:
    whens = " ".join(f"WHEN {rest} THEN {quoted(x)}" for rest, x in enumerate(choices))
    return f"(CASE ({number}) % {modulus} {whens} END)"


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, nation and region; Spark picks the joins from the table sizes."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    orders = table(spark, sf_dir, "orders")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def band_text(price: Column) -> Column:
    """Band text of a price: closed, open low, open high, misprinted and unanswered ones."""
    return (
        F.when(price < 20000, F.lit("Menos de R$ 20.000/mês"))
        .when(price < 60000, F.lit("de R$ 20.001/mês a R$ 60.000/mês"))
        .when(price < 120000, F.lit("de R$ 60.001/mês a R$ 120.000/mês"))
        .when(price < 200000, F.lit("de R$ 120.001/mês a R$ 200.000/mês"))
        .when(price < 250000, F.lit("de R$ 200.001/mês a R$ 20000/mês"))
        .when(price < 320000, F.lit("De R$ 250.001/mês  a R$ 320.000/mês"))
        .when(price < 330000, F.lit("Prefiro não informar"))
        .when(price < 335000, F.lit("Não recebo salário"))
        .when(price < 340000, F.lit("nan"))
        .when(price < 420000, F.lit("de R$ 340.001/mês a R$ 420.000/mês"))
        .otherwise(F.lit("Acima de R$ 420.001/mês"))
    )


SENIORITY_TEXT = f"""CASE left(o_orderpriority, 1) WHEN '1' THEN 'Júnior' WHEN '2' THEN ' PLENO'
  WHEN '3' THEN 'Sênior' WHEN '4' THEN {remainder_sql("o_orderkey", 3, "", None, "nan")}
  ELSE {remainder_sql("o_custkey", 3, "Especialista/Staff+", "Gerente de dados", "Analista")} END"""

WORK_MODEL_TEXT = f"""CASE o_orderstatus WHEN 'F' THEN 'Modelo 100% remoto'
  WHEN 'O' THEN 'Modelo híbrido com dias fixos de trabalho presencial'
  ELSE {remainder_sql("o_custkey", 4, None, "Home  Office", "100% presencial", "Nômade")} END"""

MANAGER_TEXT = remainder_sql(
    "o_orderkey", 7, "1", "0", "TRUE", "FALSE", "Sim, sou gestor", "Não", ""
)

GENDER_TEXT = remainder_sql(
    "o_custkey", 8, "Masculino", "Feminino", " MULHER", "homem", "Prefiro não informar",
    "Não-binário", None, "Feminino (cis)",
)

AI_TEXT = remainder_sql(
    "o_orderkey", 11, None, NOT_USED, FREE, PAID, CODE, f"{PAID}, {CODE}", f"{FREE}, {PAID}",
    "Utilizo outra coisa", "Talvez", NOT_USED.upper(), "A empresa fornece o Copilot",
)


def _items(*conditions: tuple[str, str]) -> str:
    whens = ", ".join(f"CASE WHEN {when} THEN {quoted(item)} END" for when, item in conditions)
    return f"concat_ws(', ', {whens})"


def _preferred(number: str) -> str:
    return remainder_sql(number, 4, "SQL", "Python", "R", "SAS/Stata")


_CLOUD = _items(
    ("o_orderkey % 2 = 0", "Azure (Microsoft)"),
    ("o_orderkey % 3 = 0", "Amazon Web Services (AWS)"),
    ("o_orderkey % 5 = 0", "Google Cloud (GCP, Firebase)"),
    ("o_orderkey % 7 = 0", "Servidores On Premise/Não utilizamos Cloud"),
    ("o_orderkey % 10 = 0", "Azure (Microsoft)"),
)
# Multi-answer texts: slashes, bracketed commas, nested and stray brackets, empty items.
ANSWER_TEXTS = {
    # Multiple choice since 1998, single choice before.
    "linguagem_preferida": f"""CASE WHEN year(o_orderdate) < 1998 THEN {_preferred("o_orderkey")}
      ELSE concat_ws(', ', {_preferred("o_orderkey")}, {_preferred("o_orderkey + 1")},
        CASE WHEN o_orderkey % 2 = 0 THEN {_preferred("o_orderkey + 2")} END) END""",
    "banco_dados": _items(
        ("o_custkey % 2 = 0", "PostgreSQL"),
        ("o_custkey % 3 = 0", "f((a,b),c)"),
        ("o_custkey % 5 = 0", "Oracle) DB"),
        ("o_custkey % 7 = 0", "Firebird [2.5, 3.0]"),
    ),
    "cloud_uso": f"concat({_CLOUD}, CASE WHEN o_orderkey % 13 = 0 THEN ', ,' ELSE '' END)",
    # Not asked before 1997.
    "ferramenta_bi": f"""CASE WHEN year(o_orderdate) >= 1997 THEN {_items(
        ("(o_orderkey + o_custkey) % 3 < 2", "Power BI"), ("o_custkey % 4 = 0", "Tableau")
    )} END""",
}


def _answer_columns() -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in ANSWER_TEXTS.items()]


_STATE_LIST = "array(" + ", ".join(quoted(x.lower()) for x in STATES) + ")"
_AGE = "CAST(20 + o_custkey % 40 AS STRING)"
_YEARS = "CAST(floor(c_acctbal / 2000) AS BIGINT)"
RAW_TEXTS = {
    "idade": f"""CASE o_orderkey % 9 WHEN 0 THEN 'n/d' WHEN 1 THEN concat({_AGE}, '.0')
      WHEN 2 THEN concat('  ', {_AGE}, ' ') ELSE {_AGE} END""",
    "genero": GENDER_TEXT,
    "uf_moradia": f"CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE {_STATE_LIST}[n_nationkey] END",
    "regiao": """CASE WHEN o_orderkey % 4 = 0 THEN ' ' WHEN o_orderkey % 8 = 1 THEN NULL
      ELSE concat(' ', r_name) END""",
    "nivel_ensino": remainder_sql(
        "o_orderkey", 5, "Graduação/Bacharelado", "Pós-graduação", "Mestrado",
        "Doutorado ou Phd", None,
    ),
    "setor_empresa": "CASE WHEN n_nationkey % 7 <> 6 THEN concat('Setor ', n_nationkey % 7) END",
    "cargo": "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END",
    "senioridade": SENIORITY_TEXT,
    "tempo_experiencia_dados": f"""CASE WHEN c_acctbal >= 0
      THEN concat('de ', {_YEARS}, ' a ', {_YEARS} + 1, ' anos') END""",
    "forma_trabalho": WORK_MODEL_TEXT,
    "atua_como_gestor": MANAGER_TEXT,
    "uso_ia_pessoal": AI_TEXT,
}


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers under canonical names; every answer is text or NULL."""
    return orders_with_customer(spark, sf_dir).select(
        F.expr("year(o_orderdate)").alias("ano"),
        F.expr("CAST(o_orderkey AS STRING)").alias("id_respondente"),
        *[F.expr(sql).alias(name) for name, sql in RAW_TEXTS.items()],
        band_text(F.col("o_totalprice")).alias("faixa_salarial"),
        *_answer_columns(),
    )


def derived_respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical respondents, derived from the raw answers in the same plan."""
    return respondents(raw_survey(spark, sf_dir))


_stored: dict[tuple, DataFrame] = {}


def melted(texts: DataFrame) -> DataFrame:
    """Long table of the answers in a table of multi-answer texts."""
    return melt_answers(texts, _KEYS, _SAME)

SOURCES = ("orders", "customer", "nation", "region", "lineitem", "part")


def version(spark: SparkSession, sf_dir: str) -> tuple:
    """Application, data folder and state of its tables: results are kept only for these."""
    changed = [changed_at(spark, f"{sf_dir}/{name}.parquet") for name in SOURCES]
    return (spark.sparkContext.applicationId, sf_dir, *changed)


def stored(
    name: str, build: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str
) -> DataFrame:
    """A silver or gold table, written once per application and state of the data, by edition.

    Gold tables and reports read stored, columnar silver, as in the pipeline: each touches the few
    columns it needs, and a filter on a derived label reaches the scan as a pushed-down comparison
    instead of repeating the derivation.
    """
    key = (*version(spark, sf_dir), name)
    if key not in _stored:
        _stored[key] = written(build(spark, sf_dir), name, ["ano"])
    return _stored[key]


def if_stored(name: str, spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """The table where ``stored`` has written it already."""
    return _stored.get((*version(spark, sf_dir), name))


def survey_respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored("respondentes", derived_respondents, spark, sf_dir)


def order_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-answer texts alone: they need no join."""
    return table(spark, sf_dir, "orders").select(
        F.expr("year(o_orderdate)").alias("ano"),
        F.expr("CAST(o_orderkey AS STRING)").alias("id_respondente"),
        *_answer_columns(),
    )


_KEYS = ("ano", "id_respondente")
_SAME = {name: name for name in ANSWER_COLUMNS}


def derived_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table of the answers given in the orders, split from the raw texts."""
    return melted(order_answers(spark, sf_dir))


def derived_answer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order and question with the list of items named."""
    return answer_lists(order_answers(spark, sf_dir), _KEYS, _SAME)


def survey_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored("tecnologias", derived_answers, spark, sf_dir)


def survey_answer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored("respostas", derived_answer_lists, spark, sf_dir)


def edition_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edition and key of every respondent, without the joins of the full view."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("ano"), F.col("o_orderkey").alias("id_respondente")
    )


def lineitem_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long table that grows with the largest table: brands by part type, per order and edition.

    The edition is that of the order, as it is of the members.
    """
    part = table(spark, sf_dir, "part")
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    dated = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return dated.join(part, items.l_partkey == part.p_partkey).select(
        F.year("o_orderdate").alias("ano"),
        F.col("l_orderkey").alias("id_respondente"),
        F.col("p_type").alias("categoria"),
        F.col("p_brand").alias("tecnologia"),
    )


def part_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questionnaire headers in both formats, one per part."""
    key, name = F.col("p_partkey"), F.col("p_name")
    section = (1 + key % 9).cast("string")
    letter = F.char(97 + F.col("p_size") % 8)
    flat = F.concat(section, F.lit("."), letter)
    quoted = F.concat(F.lit("('P"), section, F.lit("_"), letter, F.lit(" ', "))
    number = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    header = (
        F.when(key % 5 == 0, F.concat(quoted, F.lit("'"), name, F.lit("')")))
        .when(key % 5 == 1, F.concat(flat, F.lit("_"), F.translate(name, " ", "_")))
        .when(key % 5 == 2, F.concat(flat, F.lit("."), number, F.lit(" "), name))
        .when(key % 5 == 3, F.concat(quoted, F.lit("\"LLM's "), name, F.lit('")')))
        .otherwise(name)
    )
    return table(spark, sf_dir, "part").select(
        (2023 + F.col("p_size") % 3).cast("int").alias("ano"),
        key.alias("posicao"),
        header.alias("cabecalho"),
    )


def supplier_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical fields, one per supplier, with a code, a wrong code or none in three editions."""
    year = F.explode(F.array(F.lit(2023), F.lit(2024), F.lit(2025)))
    rest = (F.col("s_suppkey") + F.col("ano")) % 5
    letter = F.char(97 + F.col("s_nationkey") % 8)
    return (
        table(spark, sf_dir, "supplier")
        .select("*", year.alias("ano"))
        .select(
            "ano",
            by_remainder("s_suppkey", 3, "campos", "ia", "tecnologias").alias("grupo"),
            F.col("s_name").alias("campo"),
            F.when(rest == 0, F.lit(None).cast("string"))
            .when(rest == 1, F.lit("9.z"))
            .otherwise(F.concat(1 + F.col("s_suppkey") % 9, F.lit("."), letter))
            .alias("codigo"),
        )
    )
