"""Bronze to silver: one canonical respondent table and one long table of answers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import categories as cat
from surveyloom.functions import fixed_values as fixed
from surveyloom.functions.bands import midpoint, with_band_limits
from surveyloom.functions.text import normalise_columns, to_integer
from surveyloom.operators.answers import melt_answers

BINARY_FIELDS = ("satisfacao_empresa", "atua_como_gestor")
ANSWER_FIELDS = (
    "linguagem_uso", "linguagem_preferida", "banco_dados", "cloud_uso", "cloud_preferida",
    "ferramenta_bi",
)
AI_FIELD = "uso_ia_pessoal"

# Order of the columns of the respondent table.
RESPONDENT_COLUMNS = (
    "ano", "id_respondente", "idade", "genero", "cor_raca_etnia", "pcd", "estado_moradia",
    "uf_moradia", "regiao", "nivel_ensino", "area_formacao", "situacao_trabalho",
    "setor_empresa", "porte_empresa", "cargo", "senioridade", "faixa_salarial",
    "tempo_experiencia_dados", "tempo_experiencia_ti", "forma_trabalho", "forma_trabalho_ideal",
    "salario_mensal_estimado", "faixa_inferior", "faixa_superior", "satisfacao_empresa",
    "atua_como_gestor", "usa_ia", "tipo_uso_ia", "tipo_uso_ia_empresa", "ia_prioridade_empresa",
)
# Fields whose text is matched against rules, and therefore normalised.
_MATCHED = (
    "genero", "senioridade", "faixa_salarial", "forma_trabalho", "forma_trabalho_ideal",
    *BINARY_FIELDS, AI_FIELD,
)


def respondents(
    edition: DataFrame, states: Mapping[str, str] = fixed.STATE_TO_REGION
) -> DataFrame:
    """Canonical respondents of one edition whose columns already carry canonical names.

    A field the edition did not ask is left out, as are the columns derived from it. Each matched
    text is normalised once, in a projection of its own; the rules read that column.
    """
    given = set(edition.columns)
    clean = normalise_columns(
        edition, {f"{name}_normal": name for name in _MATCHED if name in given}
    )
    if "faixa_salarial" in given:
        clean = with_band_limits(clean, "faixa_salarial_normal")
    derived = _derived_columns(given, states)
    kept = [
        (derived.get(name) if name in derived else F.col(name)).alias(name)
        for name in RESPONDENT_COLUMNS
        if name in derived or name in given
    ]
    return clean.select(*kept)


def _derived_columns(given: set[str], states: Mapping[str, str]) -> dict[str, Column]:
    def normal(name: str) -> Column:
        return F.col(f"{name}_normal")

    def optional(name: str) -> Column:
        return F.col(name) if name in given else F.lit(None).cast("string")

    out: dict[str, Column] = {
        # The survey states the region; the state only fills gaps.
        "regiao": cat.standard_region(optional("regiao"), optional("uf_moradia"), states)
    }
    if "idade" in given:
        out["idade"] = to_integer(F.col("idade"))
    if "genero" in given:
        out["genero"] = cat.gender_of(normal("genero"))
    for name in ("forma_trabalho", "forma_trabalho_ideal"):
        if name in given:
            out[name] = cat.work_model_of(normal(name))
    for name in BINARY_FIELDS:
        if name in given:
            out[name] = cat.binary_of(normal(name))
    if "senioridade" in given:
        level = cat.seniority_of(normal("senioridade"))
        if "atua_como_gestor" in given:
            # Managers are not asked for a level.
            level = F.when(
                (normal("senioridade") == "") & (cat.binary_of(normal("atua_como_gestor")) == 1),
                F.lit(fixed.MANAGEMENT),
            ).otherwise(level)
        out["senioridade"] = level
    if "faixa_salarial" in given:
        lower, upper = F.col("faixa_inferior"), F.col("faixa_superior")
        out["faixa_inferior"], out["faixa_superior"] = lower, upper
        out["salario_mensal_estimado"] = midpoint(lower, upper)
    if AI_FIELD in given:
        out["usa_ia"] = cat.ai_flag_of(normal(AI_FIELD))
        out["tipo_uso_ia"] = cat.use_type_of(normal(AI_FIELD))
    return out


def technologies(edition: DataFrame) -> DataFrame | None:
    """Long table (ano, id_respondente, categoria, tecnologia); None when nothing was asked."""
    asked = {name: name for name in ANSWER_FIELDS if name in edition.columns}
    if not asked:
        return None
    return melt_answers(edition, ["ano", "id_respondente"], asked)


def align_union(frames: Iterable[DataFrame]) -> DataFrame:
    """Editions on top of each other; a column an edition lacks is a NULL of the right type."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
