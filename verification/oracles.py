"""Independent SQL for each registered query, run by DuckDB on the same tables.

The canonical columns are computed straight from the table columns, without building and parsing
the answer texts, and medians from cumulative counts, so an error in the parsing or aggregation
code cannot hide in the oracle.
"""

from __future__ import annotations

# Facts of the given tables and of the questionnaire, stated here anew: an edition, cut or state that
# the engine loses or adds shows as a difference.
EDITIONS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
REGIONS_BY_NATION = (
    ["Norte"] * 7 + ["Nordeste"] * 9 + ["Centro-oeste"] * 4 + ["Sudeste"] * 4 + ["Sul"]
)
CUTS = (
    ("senioridade", None), ("cargo", None), ("cargo", "senioridade"), ("regiao", None),
    ("regiao", "senioridade"), ("forma_trabalho", None), ("forma_trabalho", "senioridade"),
    ("nivel_ensino", None), ("tempo_experiencia_dados", None), ("genero", None),
    ("setor_empresa", None),
)


def r(expression: str, digits: int = 2) -> str:
    """Round half up on the shortest decimal that stands for the double, as Spark does."""
    decimal = f"CAST(CAST(CAST({expression} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 12))"
    return f"CAST(round({decimal}, {digits}) AS DOUBLE)"


def pick(number: str, modulus: int, *choices: str | int | None) -> str:
    def literal(x):
        return "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"

    whens = " ".join(f"WHEN {i} THEN {literal(x)}" for i, x in enumerate(choices))
    return f"CASE ({number}) % {modulus} {whens} END"


BAND_LOWER = """CAST(CASE WHEN o_totalprice < 20000 THEN 0.0 WHEN o_totalprice < 60000 THEN 20001.0
  WHEN o_totalprice < 120000 THEN 60001.0 WHEN o_totalprice < 200000 THEN 120001.0
  WHEN o_totalprice < 250000 THEN 200001.0 WHEN o_totalprice < 320000 THEN 250001.0
  WHEN o_totalprice < 340000 THEN NULL WHEN o_totalprice < 420000 THEN 340001.0
  ELSE 420001.0 END AS DOUBLE)"""
BAND_UPPER = """CAST(CASE WHEN o_totalprice < 20000 THEN 20000.0 WHEN o_totalprice < 60000 THEN 60000.0
  WHEN o_totalprice < 120000 THEN 120000.0 WHEN o_totalprice < 200000 THEN 200000.0
  WHEN o_totalprice < 250000 THEN NULL WHEN o_totalprice < 320000 THEN 320000.0
  WHEN o_totalprice < 340000 THEN NULL WHEN o_totalprice < 420000 THEN 420000.0
  ELSE NULL END AS DOUBLE)"""
BAND_MIDDLE = """CAST(CASE WHEN o_totalprice < 20000 THEN 10000.0 WHEN o_totalprice < 60000 THEN 40000.5
  WHEN o_totalprice < 120000 THEN 90000.5 WHEN o_totalprice < 200000 THEN 160000.5
  WHEN o_totalprice < 250000 THEN 200001.0 WHEN o_totalprice < 320000 THEN 285000.5
  WHEN o_totalprice < 340000 THEN NULL WHEN o_totalprice < 420000 THEN 380000.5
  ELSE 420001.0 END AS DOUBLE)"""

YEAR = "CAST(year(o_orderdate) AS INTEGER)"
GENDER = pick(
    "o_custkey", 8, "Masculino", "Feminino", "Feminino", "Masculino", "Nao informado", "Outro",
    "Nao informado", "Feminino",
)
MANAGES = pick("o_orderkey", 7, 1, 0, 1, 0, 1, 0, None)
SENIORITY = f"""CASE left(o_orderpriority, 1) WHEN '1' THEN 'Junior' WHEN '2' THEN 'Pleno'
  WHEN '3' THEN 'Senior'
  WHEN '4' THEN CASE WHEN o_orderkey % 7 IN (0, 2, 4) THEN 'Gestao' ELSE 'Nao informado' END
  ELSE {pick("o_custkey", 3, "Especialista", "Gestao", "Outro")} END"""
LEVEL_ONLY = f"""CASE left(o_orderpriority, 1) WHEN '1' THEN 'Junior' WHEN '2' THEN 'Pleno'
  WHEN '3' THEN 'Senior' WHEN '4' THEN 'Nao informado'
  ELSE {pick("o_custkey", 3, "Especialista", "Gestao", "Outro")} END"""
WORK_MODEL = f"""CASE o_orderstatus WHEN 'F' THEN 'Remoto' WHEN 'O' THEN 'Hibrido'
  ELSE {pick("o_custkey", 4, "Nao informado", "Remoto", "Presencial", "Outro")} END"""
USES_AI = pick("o_orderkey", 11, None, 0, 1, 1, 1, 1, 1, 1, None, 0, None)
AI_TYPE = pick(
    "o_orderkey", 11, None, "Nenhuma", "Gratuita", "Paga", "Assistente de codigo",
    "Paga|Assistente de codigo", "Paga|Gratuita", None, None, "Nenhuma", "Assistente de codigo",
)
REGION_OF_NATION = (
    "CASE WHEN n_nationkey % 6 = 0 THEN 'Nao informado' ELSE CASE n_nationkey "
    + " ".join(f"WHEN {i} THEN '{region}'" for i, region in enumerate(REGIONS_BY_NATION))
    + " END END"
)
REGION = f"""CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 8 = 1 THEN {REGION_OF_NATION}
  ELSE r_name END"""
JOINED = """orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

RESP = f"""resp AS (SELECT {YEAR} AS ano, CAST(o_orderkey AS VARCHAR) AS id_respondente,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(20 + o_custkey % 40 AS INTEGER) END AS idade,
  {GENDER} AS genero, {REGION} AS regiao,
  {pick("o_orderkey", 5, "Graduação/Bacharelado", "Pós-graduação", "Mestrado",
        "Doutorado ou Phd", None)} AS nivel_ensino,
  CASE WHEN n_nationkey % 7 <> 6 THEN 'Setor ' || (n_nationkey % 7) END AS setor_empresa,
  nullif(c_mktsegment, 'HOUSEHOLD') AS cargo, {SENIORITY} AS senioridade,
  CASE WHEN c_acctbal >= 0 THEN 'de ' || CAST(floor(c_acctbal / 2000) AS BIGINT) || ' a '
    || CAST(floor(c_acctbal / 2000) + 1 AS BIGINT) || ' anos' END AS tempo_experiencia_dados,
  {WORK_MODEL} AS forma_trabalho, {MANAGES} AS atua_como_gestor,
  {USES_AI} AS usa_ia, {AI_TYPE} AS tipo_uso_ia,
  {BAND_LOWER} AS lo, {BAND_UPPER} AS hi, {BAND_MIDDLE} AS mid
  FROM {JOINED})"""


def median_cte(name: str, source: str, keys: str) -> str:
    """CTE with the interpolated median ``med`` of each group, from cumulative band counts."""
    return f"""{name}_h AS (SELECT {keys}, lo, hi, count(*) AS c FROM {source}
    WHERE lo IS NOT NULL GROUP BY ALL),
  {name}_w AS (SELECT *, sum(c) OVER (PARTITION BY {keys}) AS n,
    sum(c) OVER (PARTITION BY {keys} ORDER BY lo, hi NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM {name}_h),
  {name} AS (SELECT {keys}, CASE WHEN hi IS NULL OR hi <= lo THEN lo
      ELSE lo + ((n / 2 - (cum - c)) / c) * (hi - lo) END AS med
    FROM {name}_w WHERE cum * 2 >= n
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY cum) = 1)"""


def on(a: str, b: str, keys: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", "))


# Long form of all cuts: one copy of each respondent per cut.
CUT_ROWS = "cut_rows AS (" + " UNION ALL ".join(
    f"SELECT ano, '{first}{'_' + second if second else ''}' AS recorte, {first} AS dimensao_1, "
    f"{second or 'CAST(NULL AS VARCHAR)'} AS dimensao_2, lo, hi, mid "
    "FROM resp WHERE mid IS NOT NULL"
    for first, second in CUTS
) + ")"
CUT_KEYS = "ano, recorte, dimensao_1, dimensao_2"


def pay_table(quantile: str = "quantile_disc", digits: int = 2) -> str:
    return f"""{CUT_ROWS}, {median_cte("cm", "cut_rows", CUT_KEYS)},
  pay AS (SELECT g.*, {r("cm.med", digits)} AS salario_mediano_interpolado,
    g.respondentes >= 30 AS amostra_suficiente FROM (
      SELECT {CUT_KEYS}, count(*) AS respondentes,
        {r(f"{quantile}(mid, 0.5)", digits)} AS salario_mediano,
        {r("avg(mid)", digits)} AS salario_medio,
        {r(f"{quantile}(mid, 0.25)", digits)} AS p25,
        {r(f"{quantile}(mid, 0.75)", digits)} AS p75
      FROM cut_rows GROUP BY ALL) g LEFT JOIN cm ON {on("g", "cm", CUT_KEYS)})"""


PAY = pay_table()

PROFILE = f"""profile AS (SELECT *, {r("100 * respondentes / sum(respondentes) OVER (PARTITION BY ano)")}
    AS percentual FROM (SELECT ano, cargo, senioridade, count(*) AS respondentes,
    {r("avg(idade)", 1)} AS idade_media FROM resp GROUP BY ALL))"""


def counted_pay(name: str, dims: str, within: str) -> str:
    keys = f"ano, {dims}"
    return f"""{median_cte(name + "_m", "resp", keys)},
  {name} AS (SELECT g.*, {r("m.med")} AS salario_mediano_interpolado,
    {r(f"100 * respondentes / sum(respondentes) OVER (PARTITION BY {', '.join('g.' + k for k in within.split(', '))})")}
      AS percentual
    FROM (SELECT {keys}, count(*) AS respondentes, {r("avg(mid)")} AS salario_medio
      FROM resp GROUP BY ALL) g LEFT JOIN {name}_m m ON {on("g", "m", keys)})"""


DIVERSITY = counted_pay("diversity", "genero, senioridade", "ano, senioridade")
WORK = counted_pay("work", "regiao, forma_trabalho", "ano, regiao")

AI = f"""ai AS (SELECT ano, senioridade, count(*) AS respondentes, count(usa_ia) AS base_resposta,
    {r("100 * sum(usa_ia) / nullif(count(usa_ia), 0)")} AS taxa_adocao_ia
    FROM resp GROUP BY ALL)"""

_IMPACT_KEYS = "ano, senioridade, usa_ia"
IMPACT = f"""paid AS (SELECT * FROM resp WHERE usa_ia IS NOT NULL AND mid IS NOT NULL),
  {median_cte("impact_m", "paid", _IMPACT_KEYS)},
  impact AS (SELECT g.*, {r("m.med")} AS salario_mediano_interpolado,
    CASE WHEN g.usa_ia = 1 THEN 'Usa IA' ELSE 'Nao usa IA' END AS grupo,
    g.respondentes >= 30 AS amostra_suficiente
    FROM (SELECT {_IMPACT_KEYS}, count(*) AS respondentes, {r("avg(mid)")} AS salario_medio
      FROM paid GROUP BY ALL) g LEFT JOIN impact_m m ON {on("g", "m", _IMPACT_KEYS)})"""

# Every item of every answer, without going through the concatenated text.
_ITEM_RULES = (
    ("linguagem_preferida", None, pick("o_orderkey", 4, "SQL", "Python", "R", "SAS/Stata")),
    ("linguagem_preferida", "year(o_orderdate) >= 1998",
     pick("o_orderkey + 1", 4, "SQL", "Python", "R", "SAS/Stata")),
    ("linguagem_preferida", "year(o_orderdate) >= 1998 AND o_orderkey % 2 = 0",
     pick("o_orderkey + 2", 4, "SQL", "Python", "R", "SAS/Stata")),
    # A stray closing bracket opens nothing, so the comma after it still separates.
    ("banco_dados", "o_custkey % 2 = 0", "'PostgreSQL'"),
    ("banco_dados", "o_custkey % 3 = 0", "'f((a,b),c)'"),
    ("banco_dados", "o_custkey % 5 = 0", "'Oracle) DB'"),
    ("banco_dados", "o_custkey % 7 = 0", "'Firebird [2.5, 3.0]'"),
    ("cloud_uso", "o_orderkey % 2 = 0", "'Azure (Microsoft)'"),
    ("cloud_uso", "o_orderkey % 3 = 0", "'Amazon Web Services (AWS)'"),
    ("cloud_uso", "o_orderkey % 5 = 0", "'Google Cloud (GCP, Firebase)'"),
    ("cloud_uso", "o_orderkey % 7 = 0", "'Servidores On Premise/Não utilizamos Cloud'"),
    ("cloud_uso", "o_orderkey % 10 = 0", "'Azure (Microsoft)'"),
    ("ferramenta_bi", "year(o_orderdate) >= 1997 AND (o_orderkey + o_custkey) % 3 < 2",
     "'Power BI'"),
    ("ferramenta_bi", "year(o_orderdate) >= 1997 AND o_custkey % 4 = 0", "'Tableau'"),
)
ITEMS = "items AS (" + " UNION ALL ".join(
    f"SELECT {YEAR} AS ano, CAST(o_orderkey AS VARCHAR) AS id_respondente, "
    f"'{category}' AS categoria, {item} AS tecnologia FROM orders"
    + (f" WHERE {condition}" if condition else "")
    for category, condition, item in _ITEM_RULES
) + ")"
LINE_ITEMS = """items AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
  l_orderkey AS id_respondente, p_type AS categoria, p_brand AS tecnologia
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
TECH = f"""totals AS (SELECT {YEAR} AS ano, count(*) AS total_respondentes FROM orders GROUP BY ALL),
  base AS (SELECT ano, categoria, count(DISTINCT id_respondente) AS base_resposta,
    count(*) AS total_mencoes FROM items GROUP BY ALL),
  tech AS (SELECT c.ano, c.categoria, c.tecnologia, c.respondentes, b.base_resposta,
    {r("b.total_mencoes / b.base_resposta")} AS itens_por_respondente,
    t.total_respondentes, {r("100 * c.respondentes / b.base_resposta")} AS taxa_adocao,
    CAST(row_number() OVER (PARTITION BY c.ano, c.categoria
      ORDER BY c.respondentes DESC, c.tecnologia) AS INTEGER) AS posicao
    FROM (SELECT ano, categoria, tecnologia, count(DISTINCT id_respondente) AS respondentes
      FROM items GROUP BY ALL) c
    JOIN base b USING (ano, categoria) LEFT JOIN totals t USING (ano))"""
COMPARABLE = """comparable AS (SELECT categoria FROM (SELECT DISTINCT ano, categoria,
    itens_por_respondente AS i FROM tech) GROUP BY categoria
    HAVING count(*) >= 2 AND max(i) - min(i) <= 0.5)"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def by_year(value: str, prefix: str, aggregate: str = "max", extra: str = "") -> str:
    return ", ".join(
        f"{aggregate}(CASE WHEN ano = {y} THEN {value}{extra} END) AS {prefix}_{y}"
        for y in EDITIONS
    )


def latest(table: str) -> str:
    return f"ano = (SELECT max(ano) FROM {table})"


NI = "'Nao informado'"
LEVELS = "('Junior', 'Pleno', 'Senior', 'Especialista', 'Gestao')"


def percentages(source: str, index: str, column: str, labels: list[str], where: str = "TRUE") -> str:
    inside = ", ".join(f"'{x}'" for x in labels)
    cells = ", ".join(
        r(f"100 * coalesce(sum(respondentes) FILTER ({column} = '{x}'), 0) / sum(respondentes)")
        + f' AS "{x}"'
        for x in labels
    )
    return (
        f"SELECT {index}, {cells} FROM {source} WHERE {where} AND {column} IN ({inside}) "
        f"GROUP BY {index}"
    )


def kept(cut: str) -> str:
    """Rows of a cut with a sufficient sample, or all of them when none is sufficient."""
    return f"""(SELECT * FROM pay WHERE recorte = '{cut}' AND (amostra_suficiente OR NOT
      (SELECT bool_or(amostra_suficiente) FROM pay WHERE recorte = '{cut}')))"""


_LAST = EDITIONS[-1]
_HEADER_CODE = "(1 + p_partkey % 9) || '.' || chr(CAST(97 + p_size % 8 AS INTEGER))"
HEADERS = f"""headers AS (SELECT CAST(2023 + p_size % 3 AS INTEGER) AS ano, p_partkey AS posicao,
    CASE p_partkey % 5 WHEN 4 THEN '' ELSE {_HEADER_CODE}
      || CASE WHEN p_partkey % 5 = 2 THEN '.' || replace(p_brand, 'Brand#', '') ELSE '' END
    END AS codigo_questao,
    CASE p_partkey % 5 WHEN 1 THEN replace(p_name, ' ', '_')
      WHEN 3 THEN 'LLM''s ' || p_name ELSE p_name END AS rotulo,
    CASE p_partkey % 5
      WHEN 0 THEN '(''P' || replace({_HEADER_CODE}, '.', '_') || ' '', ''' || p_name || ''')'
      WHEN 1 THEN {_HEADER_CODE} || '_' || replace(p_name, ' ', '_')
      WHEN 2 THEN {_HEADER_CODE} || '.' || replace(p_brand, 'Brand#', '') || ' ' || p_name
      WHEN 3 THEN '(''P' || replace({_HEADER_CODE}, '.', '_') || ' '', "LLM''s ' || p_name || '")'
      ELSE p_name END AS cabecalho FROM part)"""
MAPPING = """mapping AS (SELECT CAST(a.ano AS INTEGER) AS ano,
    CASE s_suppkey % 3 WHEN 0 THEN 'campos' WHEN 1 THEN 'ia' ELSE 'tecnologias' END AS grupo,
    s_name AS campo,
    CASE WHEN (s_suppkey + a.ano) % 5 = 0 THEN NULL
      WHEN (s_suppkey + a.ano) % 5 = 1 THEN '9.z'
      ELSE (1 + s_suppkey % 9) || '.' || chr(CAST(97 + s_nationkey % 8 AS INTEGER)) END AS codigo
    FROM supplier CROSS JOIN (VALUES (2023), (2024), (2025)) a(ano))"""
PLAN = """first_header AS (SELECT ano, codigo_questao, arg_min(cabecalho, posicao) AS cabecalho
    FROM headers WHERE codigo_questao <> '' GROUP BY ALL),
  plan AS (SELECT m.ano, m.grupo, m.campo, m.codigo, f.cabecalho,
    CASE WHEN m.codigo IS NULL THEN 'nao_aplicavel' WHEN f.cabecalho IS NULL THEN 'faltando'
      ELSE 'resolvido' END AS situacao
    FROM mapping m LEFT JOIN first_header f ON m.ano = f.ano AND m.codigo = f.codigo_questao)"""

_NORMAL = r"trim(regexp_replace(lower(strip_accents({})), '\s+', ' ', 'g'))"

ORACLES: dict[str, str] = {
    # Scalar functions
    "norm_text": f"""SELECT doc_id, md5(t) AS texto_md5, CAST(length(t) AS INTEGER) AS tamanho
      FROM (SELECT doc_id, {_NORMAL.format("text")} AS t FROM documents)""",
    "snake_text": f"""SELECT doc_id, md5(trim(regexp_replace({_NORMAL.format("text")},
      '[^a-z0-9]+', '_', 'g'), '_')) AS texto_md5 FROM documents""",
    "missing_tokens": """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN 'resposta'
      ELSE '' END AS texto FROM orders""",
    "code_normalise": """SELECT p_partkey, CASE p_partkey % 4
        WHEN 3 THEN '' ELSE p_size || '.' || lower(left(p_type, 1))
          || CASE WHEN p_partkey % 4 = 1 THEN '.' || replace(p_brand, 'Brand#', '') ELSE '' END
      END AS codigo FROM part""",
    "text_to_integer": """SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (0, 2, 3) THEN NULL
      ELSE CAST(20 + o_custkey % 40 AS INTEGER) END AS idade FROM orders""",
    "display_label": """SELECT doc_id, left(replace(text, '_', ' '), 45) AS rotulo
      FROM documents""",
    "band_numbers": """SELECT o_orderkey, CAST(unnest([CAST(floor(o_totalprice) AS BIGINT),
      o_custkey]) AS DOUBLE) AS numero FROM orders""",
    "band_limits": f"""SELECT o_orderkey, {BAND_LOWER} AS faixa_inferior,
      {BAND_UPPER} AS faixa_superior FROM orders""",
    "band_midpoint": f"SELECT o_orderkey, {BAND_MIDDLE} AS salario_mensal_estimado FROM orders",
    "std_seniority": f"SELECT o_orderkey, {LEVEL_ONLY} AS senioridade FROM orders",
    "fill_manager": f"SELECT o_orderkey, {SENIORITY} AS senioridade FROM orders",
    "std_work_model": f"SELECT o_orderkey, {WORK_MODEL} AS forma_trabalho FROM orders",
    "std_gender": f"SELECT o_orderkey, {GENDER} AS genero FROM orders",
    "to_binary": f"SELECT o_orderkey, {MANAGES} AS atua_como_gestor FROM orders",
    "flag_use": f"SELECT o_orderkey, {USES_AI} AS usa_ia FROM orders",
    "classify_use": f"SELECT o_orderkey, {AI_TYPE} AS tipo_uso_ia FROM orders",
    "std_region": with_([RESP], "SELECT id_respondente, regiao FROM resp"),
    "region_of_state": f"""SELECT c_custkey, {REGION_OF_NATION} AS regiao
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "canonical_region": """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Sudeste'
      WHEN 1 THEN 'Centro-oeste' ELSE 'Exterior' END AS regiao FROM customer""",
    # Silver
    "split_multi": with_([ITEMS], """SELECT id_respondente, tecnologia, count(*) AS mencoes
      FROM items WHERE categoria = 'banco_dados' GROUP BY ALL"""),
    "melt_multi": with_([ITEMS], """SELECT ano, id_respondente, categoria, tecnologia,
      count(*) AS mencoes FROM items GROUP BY ALL"""),
    "silver_respondents": with_([RESP], """SELECT ano, id_respondente, idade, genero, regiao,
      nivel_ensino, setor_empresa, cargo, senioridade, tempo_experiencia_dados, forma_trabalho,
      atua_como_gestor, usa_ia, tipo_uso_ia, lo AS faixa_inferior, hi AS faixa_superior,
      mid AS salario_mensal_estimado FROM resp"""),
    "pipeline_respondents": with_([RESP], """SELECT ano, idade, genero, regiao,
      nivel_ensino, setor_empresa, cargo, senioridade, tempo_experiencia_dados, forma_trabalho,
      atua_como_gestor, usa_ia, tipo_uso_ia, lo AS faixa_inferior, hi AS faixa_superior,
      mid AS salario_mensal_estimado FROM resp"""),
    "pipeline_answers": with_([ITEMS], """SELECT ano, categoria, tecnologia, count(*) AS mencoes
      FROM items GROUP BY ALL"""),
    "pipeline_gold_pay": with_([RESP, PAY], "SELECT * FROM pay"),
    "pipeline_gold_adoption": with_([ITEMS, TECH], "SELECT * FROM tech"),
    "csv_export": with_([RESP, DIVERSITY], "SELECT * FROM diversity"),
    "catalog_publish": with_([RESP, PROFILE], "SELECT * FROM profile"),
    "silver_join": with_([RESP, ITEMS], """SELECT r.ano, r.senioridade, i.categoria,
      count(*) AS mencoes, count(DISTINCT r.id_respondente) AS pessoas
      FROM resp r JOIN items i ON r.id_respondente = i.id_respondente AND r.ano = i.ano
      GROUP BY ALL"""),
    "align_union": """SELECT CAST(1 AS INTEGER) AS ano, c_name AS nome, c_acctbal AS saldo,
        c_mktsegment AS segmento, CAST(NULL AS INTEGER) AS tamanho FROM customer
      UNION ALL SELECT 2, s_name, s_acctbal, NULL, NULL FROM supplier
      UNION ALL SELECT 3, p_name, NULL, NULL, p_size FROM part""",
    "respondent_key": """SELECT o_orderstatus, count(*) AS linhas, count(*) AS chaves
      FROM orders GROUP BY ALL""",
    "content_key": f"""SELECT ano, estado, prioridade, cliente, ano || '-' || left(digest, 32) || '-'
        || row_number() OVER (PARTITION BY ano, digest) AS id_respondente
      FROM (SELECT *, sha256('cliente=' || length(cliente) || ':' || cliente || 'estado='
          || length(estado) || ':' || estado
          || coalesce('prioridade=' || length(prioridade) || ':' || prioridade, '')) AS digest
        FROM (SELECT {YEAR} AS ano, o_orderstatus AS estado, CAST(o_custkey % 50 AS VARCHAR) AS cliente,
          CASE WHEN o_custkey % 3 > 0 THEN o_orderpriority END AS prioridade FROM orders))""",
    "raw_lines": f"""SELECT {YEAR} AS ano, count(*) AS linhas, count(*) AS lugares,
      CAST(2 AS BIGINT) AS primeira FROM orders GROUP BY ALL""",
    "edition_routing": with_([RESP], """SELECT ano, count(*) AS respondentes,
      count(cargo) AS com_cargo FROM resp GROUP BY ano"""),
    "reload_silver": with_([RESP, ITEMS], """SELECT r.ano, senioridade, count(*) AS respondentes,
      count(cargo) AS com_cargo, CAST(sum(n) AS BIGINT) AS mencoes FROM resp r
      LEFT JOIN (SELECT ano, id_respondente, count(*) AS n FROM items GROUP BY ALL) i
        ON r.ano = i.ano AND r.id_respondente = i.id_respondente
      WHERE r.ano IN (1997, 1998) OR r.ano = 1996 AND cargo IS NOT NULL GROUP BY ALL"""),
    "reload_gold": with_(
      [RESP.replace("resp AS", "everyone AS"), """resp AS (SELECT * FROM everyone
        WHERE ano IN (1997, 1998) OR ano = 1996 AND cargo IS NOT NULL)""", PROFILE],
      "SELECT * FROM profile"),
    # Column metadata
    "header_parse": with_([HEADERS], """SELECT ano, posicao, codigo_questao, rotulo
      FROM headers"""),
    "header_index": with_([HEADERS, MAPPING, PLAN], "SELECT * FROM first_header"),
    "column_plan": with_([HEADERS, MAPPING, PLAN], "SELECT * FROM plan"),
    "plan_report": with_([HEADERS, MAPPING, PLAN], """SELECT ano,
      (SELECT count(*) FROM headers h WHERE h.ano = p.ano) AS colunas,
      count(*) FILTER (situacao = 'resolvido') AS resolvidos,
      count(*) FILTER (situacao = 'faltando') AS faltando,
      count(*) FILTER (situacao = 'nao_aplicavel') AS nao_aplicavel FROM plan p GROUP BY ano"""),
    "critical_gate": with_([HEADERS, MAPPING, PLAN], """SELECT ano,
      grupo || '.' || campo AS campo_critico, codigo FROM plan WHERE situacao = 'faltando'
      AND campo LIKE '%1'"""),
    "header_inventory": with_([HEADERS], """SELECT ano, codigo_questao, rotulo,
      cabecalho AS cabecalho_original FROM headers"""),
    # Grouped statistics
    "band_histogram": with_([RESP], """SELECT ano, regiao, lo AS faixa_inferior,
      hi AS faixa_superior, count(*) AS na_faixa FROM resp GROUP BY ALL"""),
    "grouped_median_region": with_([RESP, median_cte("m", "resp", "ano, regiao")], f"""
      SELECT g.ano, g.regiao, g.respondentes, {r("m.med")} AS salario,
        {r("100 * g.respondentes / sum(g.respondentes) OVER (PARTITION BY g.ano)")} AS pct_do_ano,
        g.respondentes >= 30 AS amostra_suficiente
      FROM (SELECT ano, regiao, count(lo) AS respondentes FROM resp GROUP BY ALL) g
      LEFT JOIN m ON {on("g", "m", "ano, regiao")}"""),
    "grouped_median_role": with_([RESP, median_cte("m", "resp", "ano, cargo")], f"""
      SELECT g.ano, g.cargo, g.respondentes, {r("m.med")} AS salario_mediano_interpolado
      FROM (SELECT ano, cargo, count(lo) AS respondentes FROM resp GROUP BY ALL) g
      LEFT JOIN m ON {on("g", "m", "ano, cargo")}"""),
    "median_of_bands": with_([RESP, median_cte("m", "resp", "ano, cargo")], f"""
      SELECT g.ano, g.cargo, {r("m.med")} AS salario_mediano_interpolado
      FROM (SELECT DISTINCT ano, cargo FROM resp) g
      LEFT JOIN m ON {on("g", "m", "ano, cargo")}"""),
    "share_of_group": with_([RESP], f"""SELECT *, {r(
      "100 * respondentes / sum(respondentes) OVER (PARTITION BY ano)")} AS percentual
      FROM (SELECT ano, forma_trabalho, count(*) AS respondentes FROM resp GROUP BY ALL)"""),
    "sample_flag": with_([RESP], """SELECT ano, cargo, senioridade, genero,
      count(*) AS respondentes, count(*) >= 30 AS amostra_suficiente
      FROM resp GROUP BY ano, cargo, senioridade, genero"""),
    "sufficient_or_all": with_([RESP], """SELECT ano, cargo, senioridade, genero, respondentes
      FROM (SELECT *, bool_or(respondentes >= 30) OVER (PARTITION BY ano, cargo) AS any_enough
        FROM (SELECT ano, cargo, senioridade, genero, count(*) AS respondentes
          FROM resp GROUP BY ALL)) WHERE respondentes >= 30 OR NOT any_enough"""),
    "pay_quartiles_exact": with_([RESP, pay_table("quantile_cont", 4)], """SELECT ano, recorte,
      dimensao_1, dimensao_2, salario_mediano, p25, p75 FROM pay"""),
    "pay_quartiles_approx": with_([RESP], """SELECT ano, regiao,
      quantile_disc(mid, 0.5) AS salario_mediano, quantile_disc(mid, 0.25) AS p25,
      quantile_disc(mid, 0.75) AS p75 FROM resp WHERE mid IS NOT NULL GROUP BY ALL"""),
    # Gold
    "gold_profile": with_([RESP, PROFILE], "SELECT * FROM profile"),
    "gold_pay_cuts": with_([RESP, PAY], "SELECT * FROM pay"),
    "gold_diversity": with_([RESP, DIVERSITY], "SELECT * FROM diversity"),
    "gold_adoption": with_([LINE_ITEMS, TECH], "SELECT * FROM tech"),
    "gold_adoption_answers": with_([ITEMS, TECH], "SELECT * FROM tech"),
    "gold_adoption_lists": with_([ITEMS, TECH], "SELECT * FROM tech"),
    "gold_adoption_flag": with_([RESP, AI], "SELECT * FROM ai"),
    "gold_impact": with_([RESP, IMPACT], "SELECT * FROM impact"),
    "gold_work_model": with_([RESP, WORK], "SELECT * FROM work"),
    "items_per_answerer": with_([ITEMS], f"""SELECT ano, categoria,
      count(DISTINCT id_respondente) AS base_resposta, count(*) AS total_mencoes,
      {r("count(*) / count(DISTINCT id_respondente)")} AS itens_por_respondente
      FROM items GROUP BY ALL"""),
    "adoption_rank": with_([LINE_ITEMS, TECH], """SELECT ano, categoria, tecnologia, posicao
      FROM tech"""),
    "topk_per_category": with_([LINE_ITEMS, TECH], """SELECT ano, categoria, tecnologia,
      respondentes, posicao FROM tech WHERE posicao <= 10"""),
    # Reports
    "coverage": with_([RESP], f"""SELECT ano, count(*) AS respondentes,
      count(mid) AS com_salario, {r("100 * count(mid) / count(*)", 1)} AS pct_com_salario,
      count(cargo) AS com_cargo, count(usa_ia) AS com_resposta_ia,
      count(*) FILTER (senioridade = {NI}) AS sem_senioridade FROM resp GROUP BY ano"""),
    "mix_by_year": with_([RESP, PROFILE], "SELECT senioridade, " + ", ".join(
      f"CAST(sum(CASE WHEN ano = {y} THEN respondentes ELSE 0 END) AS BIGINT) AS resp_{y}"
      for y in EDITIONS) + " FROM profile GROUP BY senioridade"),
    "top_roles": with_([RESP, PROFILE], f"""SELECT cargo,
      CAST(sum(respondentes) AS BIGINT) AS respondentes,
      {r("sum(percentual)")} AS pct_do_ano FROM profile
      WHERE {latest("profile")} AND cargo IS NOT NULL GROUP BY cargo
      ORDER BY respondentes DESC, cargo LIMIT 15"""),
    "pay_by_role": with_([RESP, PAY], f"""SELECT dimensao_1 AS cargo, respondentes,
      salario_mediano_interpolado AS salario, p25, p75 FROM pay WHERE recorte = 'cargo'
      AND amostra_suficiente AND dimensao_1 IS NOT NULL AND {latest("pay")}"""),
    "pay_progress": with_([RESP, PAY], f"""SELECT dimensao_1 AS senioridade,
      {by_year("salario_mediano_interpolado", "salario")} FROM pay
      WHERE recorte = 'senioridade' AND amostra_suficiente GROUP BY ALL"""),
    "pay_return": with_([RESP, PAY], f"""SELECT recorte, dimensao_1, respondentes,
      salario_mediano_interpolado AS salario FROM pay
      WHERE recorte IN ('tempo_experiencia_dados', 'nivel_ensino') AND amostra_suficiente
      AND dimensao_1 IS NOT NULL AND {latest("pay")}"""),
    "female_share": with_([RESP, DIVERSITY], f"""SELECT senioridade,
      CAST(sum(CASE WHEN genero = 'Feminino' THEN respondentes ELSE 0 END) AS BIGINT) AS mulheres,
      CAST(sum(CASE WHEN genero = 'Masculino' THEN respondentes ELSE 0 END) AS BIGINT) AS homens,
      {r('''100 * sum(CASE WHEN genero = 'Feminino' THEN respondentes ELSE 0 END) / nullif(sum(
        CASE WHEN genero IN ('Feminino', 'Masculino') THEN respondentes ELSE 0 END), 0)''', 1)}
      AS pct_feminino FROM diversity GROUP BY senioridade"""),
    "pay_gap": with_([RESP, DIVERSITY], f"""SELECT *,
      {r("100 * (salario_fem - salario_masc) / salario_masc", 1)} AS diferenca_pct FROM (
        SELECT senioridade,
          max(CASE WHEN genero = 'Masculino' THEN salario_mediano_interpolado END) AS salario_masc,
          max(CASE WHEN genero = 'Feminino' THEN salario_mediano_interpolado END) AS salario_fem
        FROM diversity WHERE {latest("diversity")} GROUP BY senioridade)
      WHERE salario_masc IS NOT NULL AND salario_fem IS NOT NULL"""),
    "top_tech": with_([LINE_ITEMS, TECH], f"""SELECT categoria, tecnologia, respondentes,
      base_resposta, taxa_adocao, posicao FROM tech WHERE {latest("tech")} AND posicao <= 10"""),
    "tech_growth": with_([ITEMS, TECH, COMPARABLE], f"""SELECT *,
      {r("adocao_final - adocao_inicial")} AS variacao_pp FROM (
        SELECT categoria, tecnologia,
          max(CASE WHEN ano = lo THEN taxa_adocao END) AS adocao_inicial,
          max(CASE WHEN ano = hi THEN taxa_adocao END) AS adocao_final
        FROM tech, (SELECT min(ano) AS lo, max(ano) AS hi FROM tech
          WHERE categoria IN (SELECT categoria FROM comparable))
        WHERE categoria IN (SELECT categoria FROM comparable) GROUP BY categoria, tecnologia)
      WHERE adocao_inicial IS NOT NULL AND adocao_final IS NOT NULL
      AND (adocao_inicial >= 5 OR adocao_final >= 5)"""),
    "tech_growth_listed": with_([LINE_ITEMS, TECH], f"""SELECT *,
      {r("adocao_final - adocao_inicial")} AS variacao_pp FROM (
        SELECT categoria, tecnologia,
          max(CASE WHEN ano = lo THEN taxa_adocao END) AS adocao_inicial,
          max(CASE WHEN ano = hi THEN taxa_adocao END) AS adocao_final
        FROM tech, (SELECT min(ano) AS lo, max(ano) AS hi FROM tech WHERE categoria <> 'PROMO')
        WHERE categoria <> 'PROMO' GROUP BY categoria, tecnologia)
      WHERE adocao_inicial IS NOT NULL AND adocao_final IS NOT NULL
      AND (adocao_inicial >= 5 OR adocao_final >= 5)"""),
    "comparability": with_([ITEMS, TECH], f"""SELECT categoria,
      {by_year("itens_por_respondente", "itens")},
      max(CASE WHEN ano = {_LAST} THEN base_resposta END) AS base_{_LAST}
      FROM tech GROUP BY categoria"""),
    "adoption_by_level": with_([RESP, AI], """SELECT ano, senioridade, base_resposta,
      taxa_adocao_ia FROM ai WHERE base_resposta > 0"""),
    "impact_by_level": with_([RESP, IMPACT], "SELECT ano, senioridade, " + ", ".join(
      f"max(CASE WHEN grupo = '{g}' THEN {column} END) AS {name}"
      for g, column, name in (
        ("Usa IA", "salario_mediano_interpolado", "salario_usa_ia"),
        ("Nao usa IA", "salario_mediano_interpolado", "salario_nao_usa_ia"),
        ("Usa IA", "respondentes", "n_usa_ia"), ("Nao usa IA", "respondentes", "n_nao_usa_ia")))
      + " FROM impact WHERE amostra_suficiente GROUP BY ano, senioridade"),
    "use_type_share": with_([RESP], f"""SELECT ano, tipo_uso_ia, count(*) AS respondentes,
      {r("100 * count(*) / sum(count(*)) OVER (PARTITION BY ano)")} AS pct_do_ano FROM resp
      WHERE tipo_uso_ia IS NOT NULL GROUP BY ano, tipo_uso_ia"""),
    "region_work_model": with_([RESP, WORK], f"""SELECT ano, regiao, forma_trabalho, respondentes,
      percentual, salario_mediano_interpolado AS salario FROM work WHERE regiao <> {NI}
      AND forma_trabalho <> {NI} AND {latest("work")}"""),
    "region_share": with_([RESP, PAY], f"""SELECT p.ano, p.dimensao_1 AS regiao, p.respondentes,
      {r("100 * p.respondentes / t.total")} AS pct_do_ano,
      p.salario_mediano_interpolado AS salario FROM pay p JOIN (SELECT ano,
        sum(respondentes) AS total FROM pay WHERE recorte = 'regiao' GROUP BY ano) t
      ON t.ano = p.ano WHERE p.recorte = 'regiao' AND p.dimensao_1 <> {NI}"""),
    "region_share_informed": with_([RESP, PAY], f"""SELECT ano, dimensao_1 AS regiao, respondentes,
      {r("100 * respondentes / sum(respondentes) OVER (PARTITION BY ano)")} AS pct_do_ano,
      salario_mediano_interpolado AS salario FROM pay
      WHERE recorte = 'regiao' AND dimensao_1 <> {NI}"""),
    "work_model_pay": with_([RESP, PAY], f"""SELECT dimensao_1 AS forma_trabalho,
      {by_year("salario_mediano_interpolado", "salario")},
      max(CASE WHEN ano = {_LAST} THEN respondentes END) AS n_{_LAST} FROM pay
      WHERE recorte = 'forma_trabalho' AND dimensao_1 <> {NI} AND amostra_suficiente
      GROUP BY ALL"""),
    "sector_pay": with_([RESP, PAY], f"""SELECT dimensao_1 AS setor, respondentes,
      salario_mediano_interpolado AS salario FROM pay WHERE recorte = 'setor_empresa'
      AND amostra_suficiente AND dimensao_1 IS NOT NULL AND {latest("pay")}"""),
    # Chart frames
    "pivot_share": with_([RESP, PROFILE], percentages(
      "profile", "ano", "senioridade", ["Junior", "Pleno", "Senior", "Especialista", "Gestao"])),
    "top_role_bars": with_([RESP, PROFILE], f"""SELECT cargo,
      CAST(sum(respondentes) AS BIGINT) AS respondentes FROM profile
      WHERE {latest("profile")} AND cargo IS NOT NULL GROUP BY cargo
      ORDER BY respondentes DESC, cargo LIMIT 10"""),
    "pivot_pay": with_([RESP, PAY], "SELECT ano, " + ", ".join(
      f"max(salario_mediano_interpolado) FILTER (dimensao_1 = '{x}') AS \"{x}\""
      for x in ("Junior", "Pleno", "Senior", "Especialista", "Gestao"))
      + f" FROM {kept('senioridade')} GROUP BY ano"),
    "pay_by_region": with_([RESP, PAY], f"""SELECT ano, dimensao_1 AS regiao,
      salario_mediano_interpolado AS salario FROM {kept("regiao")}
      WHERE dimensao_1 <> {NI} AND {latest(kept("regiao"))}"""),
    "pay_by_work_model": with_([RESP, PAY], f"""SELECT dimensao_1 AS forma_trabalho,
      {by_year("salario_mediano_interpolado", "salario")} FROM {kept("forma_trabalho")}
      WHERE dimensao_1 <> {NI} GROUP BY ALL"""),
    "best_paid_roles": with_([RESP, PAY], f"""SELECT ano, dimensao_1 AS cargo,
      salario_mediano_interpolado AS salario FROM {kept("cargo")}
      WHERE dimensao_1 IS NOT NULL AND {latest(kept("cargo"))}
      ORDER BY salario DESC, cargo LIMIT 10"""),
    "pay_by_experience": with_([RESP, PAY], f"""SELECT ano,
      dimensao_1 AS tempo_experiencia_dados, salario_mediano_interpolado AS salario
      FROM {kept("tempo_experiencia_dados")} WHERE dimensao_1 IS NOT NULL
      AND {latest(kept("tempo_experiencia_dados"))}"""),
    "top_tech_bars": with_([ITEMS, TECH], f"""SELECT replace(categoria, '_', ' ') AS categoria,
      left(tecnologia, 45) AS tecnologia, taxa_adocao, posicao FROM tech
      WHERE {latest("tech")} AND posicao <= 10"""),
    "trend_comparable": with_([ITEMS, TECH, COMPARABLE], """SELECT t.categoria, t.ano,
      t.tecnologia, t.taxa_adocao FROM tech t WHERE t.categoria IN (SELECT * FROM comparable)
      AND t.categoria IN ('banco_dados', 'cloud_uso', 'cloud_preferida', 'ferramenta_bi')
      AND EXISTS (SELECT 1 FROM tech l WHERE l.categoria = t.categoria
        AND l.tecnologia = t.tecnologia AND l.posicao <= 5
        AND l.ano = (SELECT max(ano) FROM tech m WHERE m.categoria = t.categoria))"""),
    "ai_by_level": with_([RESP, AI], f"""SELECT senioridade, {by_year("taxa_adocao_ia", "taxa")}
      FROM ai WHERE base_resposta > 0 AND senioridade IN {LEVELS} GROUP BY senioridade"""),
    "ai_pay_by_level": with_([RESP, IMPACT], f"""SELECT senioridade,
      {r('''avg(salario_mediano_interpolado) FILTER (grupo = 'Nao usa IA')''')}
        AS salario_nao_usa_ia,
      {r('''avg(salario_mediano_interpolado) FILTER (grupo = 'Usa IA')''')} AS salario_usa_ia
      FROM impact WHERE amostra_suficiente AND senioridade IN {LEVELS} GROUP BY senioridade
      HAVING count(DISTINCT grupo) = 2"""),
    "gender_mix": with_([RESP, DIVERSITY], percentages(
      "diversity", "ano", "genero", ["Feminino", "Masculino", "Nao informado", "Outro"])),
    "pay_gap_pivot": with_([RESP, DIVERSITY], f"""SELECT * FROM (SELECT senioridade,
        max(salario_mediano_interpolado) FILTER (genero = 'Feminino') AS "Feminino",
        max(salario_mediano_interpolado) FILTER (genero = 'Masculino') AS "Masculino"
        FROM diversity WHERE {latest("diversity")} AND senioridade IN {LEVELS}
        GROUP BY senioridade) WHERE "Feminino" IS NOT NULL AND "Masculino" IS NOT NULL"""),
    "female_share_bars": with_([RESP, DIVERSITY], f"""SELECT senioridade,
      {r("100 * f / (f + m)")} AS pct_feminino FROM (SELECT senioridade,
        sum(respondentes) FILTER (genero = 'Feminino') AS f,
        sum(respondentes) FILTER (genero = 'Masculino') AS m FROM diversity
        WHERE senioridade IN {LEVELS} GROUP BY senioridade)
      WHERE f IS NOT NULL AND m IS NOT NULL"""),
    "work_model_pivot": with_([RESP, WORK], percentages(
      "work", "regiao", "forma_trabalho", ["Hibrido", "Presencial", "Remoto", "Outro"],
      f"regiao <> {NI} AND {latest('work')}")),
}

ORACLES |= {
    # The same facts from SQL text in Spark; all of one catalog, whose answers are those of orders.
    f"sql_{name}": ORACLES[name].replace(LINE_ITEMS, ITEMS)
    for name in (
        "coverage", "mix_by_year", "top_roles", "pay_by_role", "pay_progress", "pay_return",
        "female_share", "pay_gap", "top_tech", "tech_growth", "comparability", "adoption_by_level",
        "impact_by_level", "use_type_share", "region_work_model", "region_share", "work_model_pay",
        "sector_pay",
    )
}
ORACLES |= {
    "sql_median": ORACLES["median_of_bands"], "sql_split": ORACLES["split_multi"],
    "silver_join_buckets": ORACLES["silver_join"], "adoption_rank_range": ORACLES["adoption_rank"],
    "adopters_over_editions": """SELECT p_type AS categoria, p_brand AS tecnologia,
      count(DISTINCT o_custkey) AS pessoas, count(DISTINCT year(o_orderdate)) AS edicoes,
      TRUE AS perto FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
}
