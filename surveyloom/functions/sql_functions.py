"""The median of banded answers and the splitter as SQL functions.

They are expressions, which Spark puts in the place of the call: nothing leaves the JVM, and the
optimizer sees through them. Temporary functions last for the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from surveyloom.functions.fixed_values import MISSING_TOKENS

BANDS = "ARRAY<STRUCT<faixa_inferior: DOUBLE, faixa_superior: DOUBLE, na_faixa: BIGINT>>"

#: Bands in order, open ones last; the first band at which half of all answers is reached; then the
#: share of that band that lies below the half. Bands without width or open give their lower limit.
MEDIAN = f"""
CREATE OR REPLACE TEMPORARY FUNCTION mediana_interpolada(faixas {BANDS}) RETURNS DOUBLE
COMMENT 'Interpolated median of (lower limit, upper limit, answers); NULL without answers'
RETURN reduce(
    array_sort(transform(
        filter(faixas, f -> f.faixa_inferior IS NOT NULL AND f.na_faixa > 0),
        f -> struct(f.faixa_inferior AS de, f.faixa_superior IS NULL AS aberta,
                    f.faixa_superior AS ate, f.na_faixa AS n))),
    named_struct('antes', 0L, 'mediana', CAST(NULL AS DOUBLE)),
    (soma, f) -> named_struct(
        'antes', soma.antes + f.n,
        'mediana', CASE
            WHEN soma.mediana IS NOT NULL THEN soma.mediana
            WHEN 2 * (soma.antes + f.n) >= reduce(
                filter(faixas, g -> g.faixa_inferior IS NOT NULL AND g.na_faixa > 0),
                0L, (t, g) -> t + g.na_faixa)
            THEN CASE WHEN f.ate > f.de THEN f.de + (f.ate - f.de) * ((reduce(
                filter(faixas, g -> g.faixa_inferior IS NOT NULL AND g.na_faixa > 0),
                0L, (t, g) -> t + g.na_faixa) / 2 - soma.antes) / f.n)
                ELSE f.de END
        END),
    soma -> soma.mediana)
"""

_MISSING = ", ".join(f"'{token}'" for token in MISSING_TOKENS)
#: Pieces between all commas, put together again where a bracket is open: each piece tells by how
#: much it opens or closes, and a stray closing bracket never takes the depth below nought.
SPLIT = f"""
CREATE OR REPLACE TEMPORARY FUNCTION separar_respostas(texto STRING) RETURNS ARRAY<STRING>
COMMENT 'Items of a multiple answer, cut at commas outside brackets'
RETURN CASE WHEN texto IS NULL OR lower(trim(texto)) IN ('', {_MISSING})
THEN CAST(array() AS ARRAY<STRING>)
ELSE filter(transform(reduce(
    split(texto, ','),
    named_struct('fundo', 0, 'itens', CAST(array() AS ARRAY<STRING>)),
    (lido, pedaco) -> named_struct(
        'fundo', reduce(
            regexp_extract_all(pedaco, '[()\\\\[\\\\]]', 0), lido.fundo,
            (fundo, c) -> CASE WHEN c IN ('(', '[') THEN fundo + 1 ELSE greatest(fundo - 1, 0) END),
        'itens', CASE WHEN lido.fundo = 0 THEN array_append(lido.itens, pedaco)
            ELSE concat(slice(lido.itens, 1, size(lido.itens) - 1),
                        array(concat(element_at(lido.itens, -1), ',', pedaco))) END),
    lido -> lido.itens), i -> regexp_replace(i, '^\\\\s+|\\\\s+$', '')), i -> i <> '')
END
"""


def register_functions(spark: SparkSession) -> None:
    """``mediana_interpolada(bands)`` and ``separar_respostas(text)`` for this session's SQL."""
    spark.sql(MEDIAN)
    spark.sql(SPLIT)
