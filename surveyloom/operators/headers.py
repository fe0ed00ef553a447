"""Question headers and the column plan, as DataFrames over column metadata.

Headers change their wording and numbering between editions; the dotted question code is what
identifies a column. Inputs: a header frame ``(ano, posicao, cabecalho)`` and a mapping frame
``(grupo, campo, ano, codigo)`` in which a NULL code means the edition did not ask the question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.text import normalise_code, strip_spaces

# The two header formats, ('P2_h ', 'Faixa salarial') and 2.h_faixa_salarial.
TUPLE_HEADER = r"(?s)^\(\s*(['\"])(.*?)\1\s*,\s*(['\"])(.*)\3\s*\)$"
FLAT_HEADER = r"(?s)^(\d+(?:\.[0-9a-zA-Z]+)*)[_ ](.*)$"

RESOLVED, MISSING, NOT_ASKED = "resolvido", "faltando", "nao_aplicavel"


class CriticalFieldMissing(ValueError):
    """A field no analysis can do without has no column in some edition."""


def header_frame(spark: SparkSession, headers: Mapping[int, Sequence[str]]) -> DataFrame:
    """Header frame from the column names of each edition."""
    rows = [
        (int(year), position, name)
        for year, names in headers.items()
        for position, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, "ano int, posicao int, cabecalho string")


def parse_headers(headers: DataFrame) -> DataFrame:
    """Add ``codigo`` (as written), ``codigo_questao`` (dotted) and ``rotulo`` to a header frame.

    A header that fits neither format has an empty code and is its own label.
    """
    text = F.col("texto_do_cabecalho")
    in_tuple, in_flat = text.rlike(TUPLE_HEADER), text.rlike(FLAT_HEADER)

    def part(of_tuple: int, of_flat: int, otherwise: Column) -> Column:
        return (
            F.when(in_tuple, F.regexp_extract(text, TUPLE_HEADER, of_tuple))
            .when(in_flat, F.regexp_extract(text, FLAT_HEADER, of_flat))
            .otherwise(otherwise)
        )

    stripped = strip_spaces(F.coalesce(F.col("cabecalho"), F.lit("")))
    split = headers.withColumn("texto_do_cabecalho", stripped).withColumns(
        {"codigo": part(2, 1, F.lit("")), "rotulo": part(4, 2, text)}
    )
    clean = split.withColumns(
        {name: strip_spaces(F.col(name)) for name in ("codigo", "rotulo")}
    ).drop("texto_do_cabecalho")
    return clean.withColumn("codigo_questao", normalise_code(F.col("codigo")))


def header_index(headers: DataFrame) -> DataFrame:
    """First header of each code and edition: a question precedes the columns derived from it.

    Headers without a code drop out of the aggregate, not of its input, where the filter would
    repeat the parsing.
    """
    coded = F.when(F.col("codigo_questao") != "", F.col("cabecalho"))
    return (
        parse_headers(headers)
        .groupBy("ano", "codigo_questao")
        .agg(F.min_by(coded, "posicao").alias("cabecalho"))
        .where(F.col("cabecalho").isNotNull())
    )


def column_plan(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Column of every canonical field in every edition, with the status of the search.

    Codes match exactly, never by prefix: ``4.h`` is not ``4.h.3``.
    """
    wanted = mapping.withColumn("codigo_questao", normalise_code(F.col("codigo")))
    return wanted.join(header_index(headers), ["ano", "codigo_questao"], "left").select(
        "ano", "grupo", "campo", "codigo", "cabecalho",
        F.when(F.col("codigo").isNull(), F.lit(NOT_ASKED))
        .when(F.col("cabecalho").isNull(), F.lit(MISSING))
        .otherwise(F.lit(RESOLVED))
        .alias("situacao"),
    )


def plan_report(
    headers: DataFrame, plan: DataFrame, rows: Mapping[int, int] | None = None
) -> DataFrame:
    """Columns read and fields resolved, missing and not asked, per edition.

    ``rows`` adds the number of rows read of each edition.
    """
    read = headers.groupBy("ano").agg(F.count(F.lit(1)).alias("colunas"))
    found = plan.groupBy("ano").agg(
        *[
            F.count_if(F.col("situacao") == status).alias(name)
            for status, name in (
                (RESOLVED, "resolvidos"), (MISSING, "faltando"), (NOT_ASKED, "nao_aplicavel"),
            )
        ]
    )
    report = read.join(found, "ano", "left")
    if rows is None:
        return report
    cases = F.coalesce(*[F.when(F.col("ano") == year, F.lit(n)) for year, n in rows.items()])
    return report.withColumn("linhas", cases.cast("long"))


def critical_missing(
    plan: DataFrame, critical: Iterable[str] | Callable[[Column], Column]
) -> DataFrame:
    """Critical fields (``grupo.campo``) whose code is mapped but has no column.

    ``critical`` lists the fields, or tells from the field name whether it is critical.
    """
    field = F.concat_ws(".", "grupo", "campo")
    chosen = critical(field) if callable(critical) else field.isin(list(critical))
    return plan.where((F.col("situacao") == MISSING) & chosen).select(
        "ano", field.alias("campo_critico"), "codigo"
    )


def require_critical(plan: DataFrame, critical: Iterable[str]) -> None:
    """Raise when a critical field is missing. The plan has one row per field and edition."""
    lost = critical_missing(plan, critical).orderBy("ano", "campo_critico").collect()
    if lost:
        raise CriticalFieldMissing(
            "; ".join(f"{r['ano']}: {r['campo_critico']} ({r['codigo']})" for r in lost)
        )


def header_inventory(headers: DataFrame) -> DataFrame:
    """Every header with its code and label, for review."""
    return parse_headers(headers).select(
        "ano", "codigo_questao", "rotulo", F.col("cabecalho").alias("cabecalho_original")
    )
