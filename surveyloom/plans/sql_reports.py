"""The reports as SQL text over published tables or views.

``{silver}`` and ``{gold}`` are what stands before a table's name: ``mydb.gold_`` for a catalog,
``gold_`` for temporary views. Texts whose columns follow the editions are made by a function of
them. "Latest edition" is a scalar sub-query on the partition column, so that Spark prunes the other
partitions when the query runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from surveyloom.functions.fixed_values import NOT_INFORMED

Editions = Sequence[int]


def _latest(table: str) -> str:
    return f"ano = (SELECT max(ano) FROM {{gold}}{table})"


def _by_edition(editions: Editions, value: str, name: str, where: str = "") -> str:
    condition = f" AND {where}" if where else ""
    return ", ".join(
        f"max({value}) FILTER (WHERE ano = {year}{condition}) AS {name}_{year}" for year in editions
    )


COVERAGE = f"""
SELECT ano, count(*) AS respondentes, count(salario_mensal_estimado) AS com_salario,
       round(100 * count(salario_mensal_estimado) / count(*), 1) AS pct_com_salario,
       count(cargo) AS com_cargo, count(usa_ia) AS com_resposta_ia,
       count_if(senioridade = '{NOT_INFORMED}') AS sem_senioridade
FROM {{silver}}respondentes
GROUP BY ano
ORDER BY ano
"""


def mix_by_year(editions: Editions) -> str:
    columns = ", ".join(f"sum(if(ano = {y}, respondentes, 0)) AS resp_{y}" for y in editions)
    return f"SELECT senioridade, {columns} FROM {{gold}}perfil_mercado GROUP BY senioridade"


TOP_ROLES = f"""
SELECT cargo, sum(respondentes) AS respondentes, round(sum(percentual), 2) AS pct_do_ano
FROM {{gold}}perfil_mercado
WHERE {_latest("perfil_mercado")} AND cargo IS NOT NULL
GROUP BY cargo
ORDER BY respondentes DESC, cargo
LIMIT 15
"""

PAY_BY_ROLE = f"""
SELECT dimensao_1 AS cargo, respondentes, salario_mediano_interpolado AS salario, p25, p75
FROM {{gold}}remuneracao
WHERE recorte = 'cargo' AND dimensao_1 IS NOT NULL AND amostra_suficiente
  AND {_latest("remuneracao")}
ORDER BY salario DESC
"""


def pay_progress(editions: Editions) -> str:
    return f"""
SELECT dimensao_1 AS senioridade, {_by_edition(editions, "salario_mediano_interpolado", "salario")}
FROM {{gold}}remuneracao
WHERE recorte = 'senioridade' AND amostra_suficiente
GROUP BY dimensao_1
"""


PAY_RETURN = f"""
SELECT recorte, dimensao_1, respondentes, salario_mediano_interpolado AS salario
FROM {{gold}}remuneracao
WHERE recorte IN ('nivel_ensino', 'tempo_experiencia_dados') AND dimensao_1 IS NOT NULL
  AND amostra_suficiente AND {_latest("remuneracao")}
ORDER BY recorte, salario
"""

FEMALE_SHARE = """
WITH pessoas AS (
    SELECT senioridade, sum(if(genero = 'Feminino', respondentes, 0)) AS mulheres,
           sum(if(genero = 'Masculino', respondentes, 0)) AS homens
    FROM {gold}diversidade
    GROUP BY senioridade
)
SELECT *, round(100 * mulheres / nullif(mulheres + homens, 0), 1) AS pct_feminino
FROM pessoas
ORDER BY pct_feminino DESC
"""

PAY_GAP = f"""
WITH medianas AS (
    SELECT senioridade,
           max(salario_mediano_interpolado) FILTER (WHERE genero = 'Masculino') AS salario_masc,
           max(salario_mediano_interpolado) FILTER (WHERE genero = 'Feminino') AS salario_fem
    FROM {{gold}}diversidade
    WHERE {_latest("diversidade")}
    GROUP BY senioridade
)
SELECT *, round(100 * (salario_fem - salario_masc) / salario_masc, 1) AS diferenca_pct
FROM medianas
WHERE salario_masc IS NOT NULL AND salario_fem IS NOT NULL
"""

TOP_TECH = f"""
SELECT categoria, tecnologia, respondentes, base_resposta, taxa_adocao, posicao
FROM {{gold}}tecnologias
WHERE posicao <= 10 AND {_latest("tecnologias")}
ORDER BY categoria, posicao
"""

TECH_GROWTH = """
WITH formatos AS (
    SELECT categoria, ano, max(itens_por_respondente) AS itens
    FROM {gold}tecnologias GROUP BY categoria, ano
), comparaveis AS (
    SELECT categoria FROM formatos GROUP BY categoria
    HAVING count(*) >= 2 AND max(itens) - min(itens) <= 0.5
), taxas AS (
    SELECT categoria, tecnologia, ano, taxa_adocao FROM {gold}tecnologias
    WHERE categoria IN (SELECT categoria FROM comparaveis)
), pontas AS (
    SELECT *, ano = (SELECT min(ano) FROM taxas) AS e_primeira,
           ano = (SELECT max(ano) FROM taxas) AS e_ultima
    FROM taxas
), lado_a_lado AS (
    SELECT categoria, tecnologia, max(taxa_adocao) FILTER (WHERE e_primeira) AS adocao_inicial,
           max(taxa_adocao) FILTER (WHERE e_ultima) AS adocao_final
    FROM pontas GROUP BY categoria, tecnologia
)
SELECT *, round(adocao_final - adocao_inicial, 2) AS variacao_pp
FROM lado_a_lado
WHERE adocao_inicial IS NOT NULL AND adocao_final IS NOT NULL
  AND greatest(adocao_inicial, adocao_final) >= 5
ORDER BY variacao_pp DESC
"""


def comparability(editions: Editions) -> str:
    last = max(editions)
    return f"""
SELECT categoria, {_by_edition(editions, "itens_por_respondente", "itens")},
       {_by_edition([last], "base_resposta", "base")}
FROM {{gold}}tecnologias
GROUP BY categoria
"""


ADOPTION_BY_LEVEL = """
SELECT ano, senioridade, base_resposta, taxa_adocao_ia
FROM {gold}adocao_ia
WHERE base_resposta > 0
ORDER BY ano, taxa_adocao_ia DESC
"""

IMPACT_BY_LEVEL = """
SELECT ano, senioridade,
       max(salario_mediano_interpolado) FILTER (WHERE usa_ia = 1) AS salario_usa_ia,
       max(salario_mediano_interpolado) FILTER (WHERE usa_ia = 0) AS salario_nao_usa_ia,
       max(respondentes) FILTER (WHERE usa_ia = 1) AS n_usa_ia,
       max(respondentes) FILTER (WHERE usa_ia = 0) AS n_nao_usa_ia
FROM {gold}impacto_ia
WHERE amostra_suficiente
GROUP BY ano, senioridade
ORDER BY ano, senioridade
"""

USE_TYPE_SHARE = """
WITH tipos AS (
    SELECT ano, tipo_uso_ia, count(*) AS respondentes
    FROM {silver}respondentes WHERE tipo_uso_ia IS NOT NULL GROUP BY ano, tipo_uso_ia
)
SELECT *, round(100 * respondentes / sum(respondentes) OVER (PARTITION BY ano), 2) AS pct_do_ano
FROM tipos
ORDER BY ano, respondentes DESC
"""

REGION_WORK_MODEL = f"""
SELECT ano, regiao, forma_trabalho, respondentes, percentual,
       salario_mediano_interpolado AS salario
FROM {{gold}}modelo_trabalho
WHERE '{NOT_INFORMED}' NOT IN (regiao, forma_trabalho) AND {_latest("modelo_trabalho")}
ORDER BY regiao, respondentes DESC
"""

REGION_SHARE = f"""
WITH regioes AS (
    SELECT ano, dimensao_1 AS regiao, respondentes, salario_mediano_interpolado AS salario,
           sum(respondentes) OVER (PARTITION BY ano) AS todos
    FROM {{gold}}remuneracao WHERE recorte = 'regiao'
)
SELECT ano, regiao, respondentes, round(100 * respondentes / todos, 2) AS pct_do_ano, salario
FROM regioes
WHERE regiao <> '{NOT_INFORMED}'
ORDER BY ano, respondentes DESC
"""


def work_model_pay(editions: Editions) -> str:
    last = max(editions)
    return f"""
SELECT dimensao_1 AS forma_trabalho,
       {_by_edition(editions, "salario_mediano_interpolado", "salario")},
       {_by_edition([last], "respondentes", "n")}
FROM {{gold}}remuneracao
WHERE recorte = 'forma_trabalho' AND dimensao_1 <> '{NOT_INFORMED}' AND amostra_suficiente
GROUP BY dimensao_1
"""


SECTOR_PAY = f"""
SELECT dimensao_1 AS setor, respondentes, salario_mediano_interpolado AS salario
FROM {{gold}}remuneracao
WHERE recorte = 'setor_empresa' AND dimensao_1 IS NOT NULL AND amostra_suficiente
  AND {_latest("remuneracao")}
ORDER BY salario DESC
"""

REPORTS: dict[str, str | Callable[[Editions], str]] = {
    "coverage": COVERAGE, "mix_by_year": mix_by_year, "top_roles": TOP_ROLES,
    "pay_by_role": PAY_BY_ROLE, "pay_progress": pay_progress, "pay_return": PAY_RETURN,
    "female_share": FEMALE_SHARE, "pay_gap": PAY_GAP, "top_tech": TOP_TECH,
    "tech_growth": TECH_GROWTH, "comparability": comparability,
    "adoption_by_level": ADOPTION_BY_LEVEL, "impact_by_level": IMPACT_BY_LEVEL,
    "use_type_share": USE_TYPE_SHARE, "region_work_model": REGION_WORK_MODEL,
    "region_share": REGION_SHARE, "work_model_pay": work_model_pay, "sector_pay": SECTOR_PAY,
}


def report_sql(name: str, silver: str, gold: str, editions: Editions = ()) -> str:
    """Text of a report over tables whose names begin with ``silver`` and ``gold``."""
    text = REPORTS[name]
    return (text if isinstance(text, str) else text(editions)).format(silver=silver, gold=gold)


def run_report(
    spark: SparkSession, name: str, silver: str, gold: str, editions: Editions | None = None
) -> DataFrame:
    """Run a report; editions that are not given are those of the profile table's partitions."""
    if editions is None and not isinstance(REPORTS[name], str):
        rows = spark.sql(f"SELECT DISTINCT ano FROM {gold}perfil_mercado ORDER BY ano").collect()
        editions = [row["ano"] for row in rows]
    return spark.sql(report_sql(name, silver, gold, editions or ()))
