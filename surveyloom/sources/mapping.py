"""The mapping file: canonical fields, their question code in each edition, and the editions.

The file is JSON with one object per field group (``campos``, ``binarios``, ``tecnologias``,
``ia``), each ``{field: {"codigos": {"2023": "2.h", ...}}}`` where a null code means "not asked",
plus optionally ``regiao_por_uf`` (the known states otherwise), ``edicoes`` and ``campos_criticos``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.fixed_values import STATE_TO_REGION

GROUPS = ("campos", "binarios", "tecnologias", "ia")
DEFAULT_FILE = Path(__file__).with_name("mapping.json")


@dataclass(frozen=True)
class SurveyMapping:
    """A loaded mapping file."""

    fields: DataFrame
    """``(grupo, campo, ano, codigo)``, one row per field and edition."""
    editions: tuple[int, ...]
    states: Mapping[str, str] = field(default_factory=dict)
    critical: tuple[str, ...] = ()


def mapping_fields(text: DataFrame) -> DataFrame:
    """Field rows from a frame with the whole JSON text in ``value``.

    A map keeps a JSON null as an entry, so "not asked" and "not mapped" stay apart.
    """
    group = "map<string,struct<codigos:map<string,string>>>"
    schema = ", ".join(f"{name} {group}" for name in GROUPS)
    parsed = text.select(F.from_json("value", schema).alias("m"))
    groups = F.array(
        *[F.struct(F.lit(g).alias("grupo"), F.col(f"m.{g}").alias("campos")) for g in GROUPS]
    )
    return (
        parsed.select(F.inline(groups))
        .select("grupo", F.explode("campos").alias("campo", "regra"))
        .select("grupo", "campo", F.explode("regra.codigos").alias("ano", "codigo"))
        .select("grupo", "campo", F.col("ano").try_cast("int").alias("ano"), "codigo")
    )


def read_mapping(spark: SparkSession, path: str | None = None) -> SurveyMapping:
    """Load a mapping file from any path Spark can read, or the one shipped with the package."""
    if path:
        text = spark.read.text(path, wholetext=True)
    else:
        text = spark.createDataFrame([(DEFAULT_FILE.read_text("utf-8"),)], "value string")
    # The file describes a questionnaire: a few hundred lines, read on the driver like any config.
    config = json.loads(text.first()["value"])
    return SurveyMapping(
        fields=mapping_fields(text),
        editions=tuple(int(e["ano"]) for e in config.get("edicoes", ())),
        states=config.get("regiao_por_uf") or STATE_TO_REGION,
        critical=tuple(config.get("campos_criticos", ())),
    )
