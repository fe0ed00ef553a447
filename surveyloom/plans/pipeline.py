"""The two jobs end to end: raw files to silver, silver to gold."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.fixed_values import MIN_RESPONDENTS
from surveyloom.operators import headers as hd
from surveyloom.plans import gold, silver
from surveyloom.session import configured
from surveyloom.sources import bronze, sinks, workspace
from surveyloom.sources.mapping import SurveyMapping, read_mapping

log = logging.getLogger(__name__)

SILVER = ("respondentes", "tecnologias")
ANSWERS = "id_respondente string, categoria string, tecnologia string, ano int"


def resolved_columns(plan: DataFrame) -> dict[int, dict[str, str]]:
    """``{edition: {canonical field: header}}``; the plan has one row per field and edition."""
    out: dict[int, dict[str, str]] = {}
    for row in plan.where(plan.situacao == hd.RESOLVED).collect():
        out.setdefault(row["ano"], {})[row["campo"]] = row["cabecalho"]
    return out


def plan_editions(
    spark: SparkSession, headers: Mapping[int, Sequence[str]], mapping: SurveyMapping
) -> tuple[DataFrame, DataFrame]:
    """Header frame and column plan of editions, given their headers.

    The plan has a row for each field and edition; it is computed once and then a local frame.
    """
    found = hd.header_frame(spark, headers)
    wanted = mapping.fields.where(mapping.fields.ano.isin(list(headers)))
    plan = hd.column_plan(found, wanted)
    return found, spark.createDataFrame(plan.collect(), plan.schema)


@dataclass
class Landed:
    """Editions that share a header, landed by one job."""

    rows: DataFrame
    path: str


def land_editions(
    spark: SparkSession, paths: Mapping[int, str | Sequence[str]], mapping: SurveyMapping,
    encoding: str = "UTF-8", strict: bool = True,
) -> list[Landed]:
    """Land all files, one job for each header and set of resolved columns.

    Files are looked at once, all together. Those of one encoding and header are one scan whatever
    their editions; the edition of a row is that of its file. Codes that an edition maps to other
    columns of the same header make a group of their own. With ``strict`` a missing critical field
    stops the job before anything is landed.
    """
    groups = bronze.group_files(spark, paths, encoding)
    raw = [bronze.read_group(spark, group) for group in groups]
    names = [tuple(c for c in df.columns if c != bronze.EDITION) for df in raw]
    # One plan for all, unless an edition has files of different headers.
    plans: list[dict[int, tuple[str, ...]]] = []
    for group, columns in zip(groups, names):
        for year in group.editions:
            fitting = (p for p in plans if p.get(year, columns) == columns)
            if (plan := next(fitting, None)) is None:
                plans.append(plan := {})
            plan[year] = columns
    resolved: dict[tuple[int, tuple[str, ...]], dict[str, str]] = {}
    for headers in plans:
        found, plan = plan_editions(spark, headers, mapping)
        if strict:
            hd.require_critical(plan, mapping.critical)
        by_year = resolved_columns(plan)
        resolved |= {(year, columns): by_year.get(year, {}) for year, columns in headers.items()}
        for row in hd.plan_report(found, plan).orderBy("ano").collect():
            log.info("edition %s", row.asDict())
    landed = []
    for group, df, columns in zip(groups, raw, names):
        alike: dict[tuple, list[int]] = {}
        for year in group.editions:
            fields = tuple(sorted(resolved[year, columns].items()))
            alike.setdefault(fields, []).append(year)
        for fields, years in alike.items():
            part = df if len(alike) == 1 else df.where(F.col(bronze.EDITION).isin(years))
            path = workspace.new_table_path(spark, "edicoes")
            landed.append(Landed(bronze.land_group(part, dict(fields), path), path))
    return landed


def bronze_to_silver(
    spark: SparkSession, paths: Mapping[int, str | Sequence[str]], silver_base: str,
    mapping: SurveyMapping | None = None, encoding: str = "UTF-8", strict: bool = True,
) -> dict[str, int]:
    """Read the raw files of some editions and write both silver tables; returns rows written.

    Editions given replace those stored, others stay. ``encoding="auto"`` falls back to Latin-1 for
    files that are not UTF-8. Keys are made from answers, so an edition loaded again keeps them.
    """
    with configured(spark):
        mapping = mapping or read_mapping(spark)
        landed = land_editions(spark, paths, mapping, encoding, strict)
        people = silver.align_union(silver.respondents(p.rows, mapping.states) for p in landed)
        items = [t for t in (silver.technologies(p.rows) for p in landed) if t is not None]
        # Where no edition asked such a question the table is there, and empty.
        technologies = silver.align_union(items) if items else spark.createDataFrame([], ANSWERS)
        years = list(paths)
        written = {
            "respondentes": sinks.replace_editions(people, f"{silver_base}/respondentes", years),
            "tecnologias": sinks.replace_editions(technologies, f"{silver_base}/tecnologias", years),
        }
        for part in landed:
            workspace.delete(spark, part.path)
    return written


def silver_to_gold(
    spark: SparkSession, silver_base: str, gold_base: str, minimum: int = MIN_RESPONDENTS,
    digits: int | None = None, years: Sequence[int] | None = None,
) -> dict[str, int]:
    """Compute and write the seven gold tables; returns rows written per table.

    Every gold figure is that of one edition, so with ``years`` only these are read and replaced;
    without, editions that silver does not hold any more are removed.
    """
    with configured(spark):
        respondents = sinks.read_table(spark, f"{silver_base}/respondentes")
        items = spark.read.schema(ANSWERS).parquet(f"{silver_base}/tecnologias")
        replaced = sinks.editions_in(spark, f"{silver_base}/respondentes")
        if years is not None:
            replaced = list(years)
            respondents, items = (t.where(F.col("ano").isin(replaced)) for t in (respondents, items))
        out = {}
        for name, df in gold.all_tables(respondents, items, minimum, digits).items():
            path, ordered = f"{gold_base}/{name}", sinks.sorted_by(df, gold.GOLD_ORDER[name])
            out[name] = sinks.replace_editions(ordered, path, replaced)
            if years is None:
                gone = set(sinks.editions_in(spark, path)) - set(replaced)
                sinks.remove_editions(spark, path, gone)
    return out


def drop_editions(spark: SparkSession, years: Sequence[int], *bases: str) -> None:
    """Remove editions from every table below the given folders."""
    for base in bases:
        for name in (*SILVER, *gold.GOLD_ORDER):
            sinks.remove_editions(spark, f"{base}/{name}", years)
