"""The survey view as raw CSV editions, taken through both jobs as a user's files would be.

Editions up to 1997 carry tuple headers and the question codes of the oldest shipped questionnaire,
later ones flat headers and the newest codes. One edition is written in Latin-1, one has files of both
encodings. Everything is written below the shared folder once per application and data folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.plans import pipeline
from surveyloom.plans.gold import GOLD_ORDER
from surveyloom.plans.silver import align_union
from surveyloom.sources import bronze, sinks, workspace
from surveyloom.sources.mapping import DEFAULT_FILE, GROUPS, read_mapping
from surveyloom.sources.workspace import new_table_path, written
from verification import star_survey as star

LAST_WITH_TUPLES = 1997
OLDEST, NEWEST = "2023", "2025"
LATIN, LATIN_EDITION, MIXED_EDITION = "ISO-8859-1", 1996, 1999


def _questions() -> dict[str, dict[str, dict[str, str | None]]]:
    """Codes of the asked fields by group, from the shipped mapping."""
    shipped = json.loads(DEFAULT_FILE.read_text("utf-8"))
    asked = {*star.RAW_TEXTS, "faixa_salarial", *star.ANSWER_COLUMNS}
    return {
        group: {name: rule["codigos"] for name, rule in shipped[group].items() if name in asked}
        for group in GROUPS
    }


def _header(code: str, field: str, tuples: bool) -> str:
    """``('P1_b ', 'genero')`` or ``1.b_genero``."""
    return f"('P{code.replace('.', '_')} ', '{field}')" if tuples else f"{code}_{field}"


def _as_files(raw: DataFrame, year: int) -> DataFrame:
    """The rows of an edition under the headers of its questionnaire."""
    codes = {name: c for group in _questions().values() for name, c in group.items()}
    tuples = year <= LAST_WITH_TUPLES
    columns = [
        F.col(name).alias(_header(code[OLDEST if tuples else NEWEST], name, tuples))
        for name, code in codes.items()
    ]
    return raw.where(F.col("ano") == year).select(F.lit("x").alias("0.a_token"), *columns)


def _write_csv(rows: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    writer = rows.write.mode("append").option("header", True).option("encoding", encoding)
    writer.option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_editions(spark: SparkSession, sf_dir: str, base: str) -> dict[int, str]:
    """A folder of CSV files for each edition of the view."""
    raw = star.stored("brutos", star.raw_survey, spark, sf_dir)
    paths = {}
    for year in star.editions_of(raw):
        paths[year] = f"{base}/edicao_{year}"
        if year == MIXED_EDITION:
            even = F.col("id_respondente").cast("long") % 2 == 0
            _write_csv(_as_files(raw.where(even), year), paths[year], LATIN)
            _write_csv(_as_files(raw.where(~even), year), paths[year])
        else:
            encoding = LATIN if year == LATIN_EDITION else "UTF-8"
            _write_csv(_as_files(raw, year), paths[year], encoding)
    return paths


def write_mapping(spark: SparkSession, years: list[int], path: str) -> None:
    """A mapping file for these editions."""
    groups = {
        group: {
            name: {"codigos": {
                str(y): codes[OLDEST if y <= LAST_WITH_TUPLES else NEWEST] for y in years
            }}
            for name, codes in fields.items()
        }
        for group, fields in _questions().items()
    }
    config = groups | {
        "edicoes": [{"ano": y} for y in years], "campos_criticos": ["campos.faixa_salarial"],
    }
    spark.createDataFrame([(json.dumps(config),)], "value string").write.text(path)


_raw: dict[tuple, tuple[dict[str, str], dict[int, str]]] = {}
_done: dict[tuple, dict[str, str]] = {}


def raw_files(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], dict[int, str]]:
    """Raw files and mapping as a user has them before any job; all folders, and those of editions."""
    key = star.version(spark, sf_dir)
    if key not in _raw:
        base = new_table_path(spark, "pesquisa")
        folders = {
            name: f"{base}/{name}" for name in ("bronze", "mapeamento", "silver", "gold", "csv")
        }
        paths = write_editions(spark, sf_dir, folders["bronze"])
        write_mapping(spark, list(paths), folders["mapeamento"])
        _raw[key] = folders, paths
    return _raw[key]


def pipeline_folders(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Raw files to gold; the folders of silver and gold."""
    key = star.version(spark, sf_dir)
    if key not in _done:
        folders, paths = raw_files(spark, sf_dir)
        pipeline.bronze_to_silver(
            spark, paths, folders["silver"], read_mapping(spark, folders["mapeamento"]), "auto"
        )
        pipeline.silver_to_gold(spark, folders["silver"], folders["gold"], digits=2)
        _done[key] = folders
    return _done[key]


def pipeline_respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver respondents without their key, which depends on the place of a row in the files."""
    people = sinks.read_table(spark, f"{pipeline_folders(spark, sf_dir)['silver']}/respondentes")
    return people.select(
        "ano", "idade", "genero", "regiao", "nivel_ensino", "setor_empresa", "cargo", "senioridade",
        "tempo_experiencia_dados", "forma_trabalho", "atua_como_gestor", "usa_ia", "tipo_uso_ia",
        "faixa_inferior", "faixa_superior", "salario_mensal_estimado",
    )


def pipeline_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = sinks.read_table(spark, f"{pipeline_folders(spark, sf_dir)['silver']}/tecnologias")
    return items.groupBy("ano", "categoria", "tecnologia").agg(
        F.count(F.lit(1)).alias("mencoes")
    )


def pipeline_gold_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.read_table(spark, f"{pipeline_folders(spark, sf_dir)['gold']}/remuneracao")


def pipeline_gold_adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.read_table(spark, f"{pipeline_folders(spark, sf_dir)['gold']}/tecnologias")


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold tables as CSV; pay read back from there."""
    folders = pipeline_folders(spark, sf_dir)
    tables = {name: sinks.read_table(spark, f"{folders['gold']}/{name}") for name in GOLD_ORDER}
    sinks.export_all(tables, folders["csv"], GOLD_ORDER)
    schema = tables["diversidade"].schema
    return spark.read.schema(schema).option("header", True).csv(f"{folders['csv']}/diversidade")


def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold tables in the catalog; the profile read by name, as SQL users do."""
    folders = pipeline_folders(spark, sf_dir)
    tables = {name: sinks.read_table(spark, f"{folders['gold']}/{name}") for name in GOLD_ORDER}
    prefix = "t" + folders["gold"].rstrip("/").split("-")[-1].split("/")[0] + "_"
    sinks.publish_all(spark, "pesquisa", tables, folders["gold"], prefix)
    return spark.table(f"pesquisa.{prefix}perfil_mercado")


def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys made from three answers of each order, so that very many rows are equal."""
    answers = star.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("ano"), F.col("o_orderstatus").alias("estado"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderpriority")).alias("prioridade"),
        (F.col("o_custkey") % 50).cast("string").alias("cliente"),
    )
    return bronze.with_content_key(written(answers, "respostas"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data lines of the raw files of each edition, and how many have a place of their own."""
    bronze_folder = raw_files(spark, sf_dir)[0]["bronze"]
    lines = bronze.read_raw_lines(spark, f"{bronze_folder}/*")
    edition = F.regexp_extract("arquivo", r"edicao_(\d{4})/", 1).cast("int")
    placed = lines.groupBy(edition.alias("ano"), "arquivo", "linha").agg(
        F.count(F.lit(1)).alias("linhas")
    )
    return placed.groupBy("ano").agg(
        F.sum("linhas").alias("linhas"), F.count(F.lit(1)).alias("lugares"),
        F.min("linha").alias("primeira"),
    )


def edition_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all editions in one folder, told apart by the year in their names."""
    base = new_table_path(spark, "nomes")
    raw = star.stored("brutos", star.raw_survey, spark, sf_dir)
    years = star.editions_of(raw)
    for year in years:
        source = f"{base}-{year}"
        _write_csv(_as_files(raw, year), source)
        for number, name in enumerate(workspace.children(spark, source)):
            if name.endswith(".csv"):
                workspace.move(spark, f"{source}/{name}", f"{base}/pesquisa_{year}_{number}.csv")
    write_mapping(spark, list(years), f"{base}-mapeamento")
    mapping = read_mapping(spark, f"{base}-mapeamento")
    landed = pipeline.land_editions(spark, bronze.editions_by_name(spark, base), mapping)
    people = align_union(part.rows.select("ano", "cargo") for part in landed)
    return people.groupBy("ano").agg(
        F.count(F.lit(1)).alias("respondentes"), F.count("cargo").alias("com_cargo")
    )


_reloaded: dict[tuple, str] = {}


def _reload(spark: SparkSession, sf_dir: str) -> str:
    """Three editions loaded, one replaced, one dropped, a late one added; the catalog's database.

    Replaced is 1996, by a file without respondents whose role is unknown; dropped is 1995; 1998 comes
    late. Only what changed is computed again, and the catalog follows the folders.
    """
    key = star.version(spark, sf_dir)
    if key in _reloaded:
        return _reloaded[key]
    given = raw_files(spark, sf_dir)[0]
    base = new_table_path(spark, "recarga")
    silver, gold, corrected = f"{base}/silver", f"{base}/gold", f"{base}/edicao_1996"
    mapping = read_mapping(spark, given["mapeamento"])

    def load(paths: dict[int, str]) -> None:
        pipeline.bronze_to_silver(spark, paths, silver, mapping, "auto")
        pipeline.silver_to_gold(spark, silver, gold, digits=2, years=list(paths))

    load({year: f"{given['bronze']}/edicao_{year}" for year in (1995, 1996, 1997)})
    database = "recarga_" + base.rsplit("-", 1)[-1]
    for folder, names in ((silver, pipeline.SILVER), (gold, tuple(GOLD_ORDER))):
        tables = {name: sinks.read_table(spark, f"{folder}/{name}") for name in names}
        prefix = "silver_" if folder == silver else "gold_"
        sinks.publish_all(spark, database, tables, folder, prefix)
    raw = star.stored("brutos", star.raw_survey, spark, sf_dir)
    _write_csv(_as_files(raw.where("cargo IS NOT NULL"), 1996), corrected)
    load({1996: corrected})
    pipeline.drop_editions(spark, [1995], silver, gold)
    load({1998: f"{given['bronze']}/edicao_1998"})
    # Temporary views of the session are listed beside the tables of any database.
    for row in spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect():
        sinks.register_partitions(spark, f"`{database}`.`{row['tableName']}`")
    _reloaded[key] = database
    return database


def reload_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Respondents and answers by edition after the reload, read through the catalog."""
    database = _reload(spark, sf_dir)
    people, items = (spark.table(f"{database}.silver_{name}") for name in pipeline.SILVER)
    named = items.groupBy("ano", "id_respondente").agg(F.count(F.lit(1)).alias("mencoes"))
    both = people.join(named, ["ano", "id_respondente"], "left")
    return both.groupBy("ano", "senioridade").agg(
        F.count(F.lit(1)).alias("respondentes"), F.count("cargo").alias("com_cargo"),
        F.sum("mencoes").alias("mencoes"),
    )


def reload_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_reload(spark, sf_dir)}.gold_perfil_mercado")


QUERIES = (
    pipeline_respondents, pipeline_answers, pipeline_gold_pay, pipeline_gold_adoption, csv_export,
    catalog_publish, content_key, raw_lines, edition_routing, reload_silver, reload_gold,
)
