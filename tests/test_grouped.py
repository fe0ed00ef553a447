"""Grouped medians, cuts, shares and adoption against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import answers, grouped, shares
from surveyloom.operators.cuts import cut_histogram, multi_cut, usable_cuts
from surveyloom.plans import chart_frames, gold, reports

BANDS = [(0.0, 1000.0), (1001.0, 2000.0), (1001.0, 3000.0), (4001.0, None), (9.0, 9.0), (None, None)]
HISTOGRAMS = [
    ([(0, 1000, 10), (1000, 2000, 20), (2000, 3000, 10)], 1500.0),
    ([(2000, 3000, 10), (1000, 2000, 20), (0, 1000, 10)], 1500.0),
    ([(0, 1000, 40), (1000, 2000, 30), (2000, 3000, 20)], 1166.6666666666667),
    ([(0, 1000, 20), (1000, 2000, 30), (2000, 3000, 40)], 1833.3333333333333),
    ([(0, 1000, 5), (40001, None, 50)], 40001.0),
    ([(None, None, 0)], None),
]


def plain_median(bands):
    rows = sorted(
        ((lo, hi, n) for lo, hi, n in bands if lo is not None and n > 0),
        key=lambda b: (b[0], b[1] is None, b[1] or 0),
    )
    total, before = sum(n for *_, n in rows), 0
    for lo, hi, n in rows:
        if 2 * (before + n) >= total:
            if hi is None or hi <= lo:
                return lo
            return lo + ((total / 2 - before) / n) * (hi - lo)
        before += n
    return None


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        lo, hi = rng.choice(BANDS)
        # One group holds a third of everything, and one key is NULL.
        region = rng.choice(["Norte", "Norte", "Sul", "Sudeste", None, "Nao informado"])
        level = rng.choice(["Junior", "Senior", "Gestao", "Nao informado"])
        rows.append((rng.choice([2023, 2024]), f"p{i}", region, level, lo, hi,
                     None if lo is None else lo if hi is None else (lo + hi) / 2,
                     rng.choice(["Masculino", "Feminino", "Outro"]), rng.choice([0, 1, None])))
    return spark.createDataFrame(
        rows, "ano int, id_respondente string, regiao string, senioridade string, "
        "faixa_inferior double, faixa_superior double, salario_mensal_estimado double, "
        "genero string, usa_ia int"
    ).repartition(5).persist()


def by_group(rows, *keys):
    out = {}
    for row in rows:
        out.setdefault(tuple(row[k] for k in keys), []).append(row)
    return out


def histogram_of(rows):
    counts = {}
    for row in rows:
        band = (row["faixa_inferior"], row["faixa_superior"])
        counts[band] = counts.get(band, 0) + 1
    return [(lo, hi, n) for (lo, hi), n in counts.items()]


@pytest.mark.parametrize("bands, expected", HISTOGRAMS)
def test_median_of_known_histograms(spark, bands, expected):
    rows = [(1, None if lo is None else float(lo), None if hi is None else float(hi))
            for lo, hi, n in bands for _ in range(max(n, 1))]
    df = spark.createDataFrame(rows, "g int, faixa_inferior double, faixa_superior double")
    about = expected if expected is None else pytest.approx(expected)
    assert grouped.grouped_median(df, ["g"]).first()["salario_mediano_interpolado"] == about
    as_array = df.groupBy("g", "faixa_inferior", "faixa_superior").agg(
        F.count(F.lit(1)).alias("na_faixa")
    ).groupBy("g").agg(
        F.collect_list(F.struct("faixa_inferior", "faixa_superior", "na_faixa")).alias("b")
    )
    assert as_array.select(grouped.median_of_bands(F.col("b"))).first()[0] == about


def test_medians_equal_brute_force_and_keep_null_groups(people):
    expected = {k: plain_median(histogram_of(v))
                for k, v in by_group(people.collect(), "ano", "regiao").items()}
    got = {(r["ano"], r["regiao"]): r["salario_mediano_interpolado"]
           for r in grouped.grouped_median(people, ["ano", "regiao"]).collect()}
    assert got == expected and (2023, None) in got


def test_medians_do_not_depend_on_partitions_or_replication(people):
    def medians(df):
        out = grouped.banded_statistics(df, ["ano", "regiao"]).drop("respondentes")
        return sorted(map(str, out.collect()))

    once = medians(people)
    assert medians(people.repartition(13, "senioridade")) == once
    assert medians(people.unionByName(people).unionByName(people)) == once


def test_every_cut_equals_its_own_aggregate(people):
    cuts = {"regiao": ("regiao",), "senioridade": ("senioridade",),
            "regiao_senioridade": ("regiao", "senioridade"), "cargo": ("cargo",)}
    out = multi_cut(people, cuts)
    assert set(usable_cuts(people, cuts)) == {"regiao", "senioridade", "regiao_senioridade"}
    rows = [r for r in people.collect() if r["salario_mensal_estimado"] is not None]
    got = {(r["recorte"], r["ano"], r["dimensao_1"], r["dimensao_2"]): r for r in out.collect()}
    seen = 0
    for cut, dims in cuts.items():
        if cut == "cargo":
            continue
        for key, members in by_group(rows, "ano", *dims).items():
            row = got[(cut, key[0], key[1], key[2] if len(dims) > 1 else None)]
            values = sorted(m["salario_mensal_estimado"] for m in members)
            assert row["respondentes"] == len(values)
            assert row["salario_mediano_interpolado"] == plain_median(histogram_of(members))
            assert math.isclose(row["salario_medio"], sum(values) / len(values))
            for p, name in ((0.25, "p25"), (0.5, "salario_mediano"), (0.75, "p75")):
                assert row[name] == values[math.ceil(p * len(values)) - 1]
            seen += 1
    assert seen == len(got)


def test_cuts_shuffle_histogram_cells_only(people):
    plan = cut_histogram(people)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
    with pytest.raises(ValueError):
        usable_cuts(people, {"a": ("regiao",), "b": ("regiao",)})


def test_interpolated_quantiles(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1000, 1500, 3501, 9000)], "g int, v double")
    hist = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("na_faixa"))
    placed = grouped.quantile_positions(hist, ["g"], "v").groupBy("g")
    row = placed.agg(
        grouped.interpolated_quantile_agg(0.5, "v").alias("m"),
        grouped.quantile_agg(0.5, "v").alias("d"),
        grouped.interpolated_quantile_agg(0.25, "v").alias("q"),
    ).first()
    assert (row["m"], row["d"], row["q"]) == (2500.5, 1500.0, 1375.0)


def test_shares_sum_to_a_hundred(people):
    table = gold.diversity(people)
    sums = table.groupBy("ano", "senioridade").agg(F.sum("percentual").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 0.05 for r in sums)
    assert table.agg(F.sum("respondentes")).first()[0] == people.count()


def test_sample_filter_falls_back_to_all(spark):
    df = spark.createDataFrame([("a", True, 1), ("a", False, 2), ("b", False, 3)],
                               "c string, amostra_suficiente boolean, x int")
    assert sorted(r["x"] for r in shares.sufficient_or_all(df, ["c"]).collect()) == [1, 3]
    only = shares.sufficient_or_all(df.where("c = 'b'"), ["c"])
    assert [r["x"] for r in only.collect()] == [3]


def test_impact_drops_unanswered_groups(people):
    out = gold.ai_impact(people).collect()
    assert {r["usa_ia"] for r in out} == {0, 1}
    assert {r["grupo"] for r in out} == {"Usa IA", "Nao usa IA"}
    rows = [r for r in people.collect()
            if r["usa_ia"] is not None and r["salario_mensal_estimado"] is not None]
    assert sum(r["respondentes"] for r in out) == len(rows)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        person = "hot" if i % 3 == 0 else f"p{i % 80}"
        rows.append((2023 + i % 2, person, rng.choice(["cloud_uso", "banco_dados"]),
                     rng.choice("abcdef")))
    return spark.createDataFrame(
        rows, "ano int, id_respondente string, categoria string, tecnologia string"
    )


def test_adoption_counts_people_once_and_mentions_always(items, people):
    rows = items.collect()
    for r in answers.adoption(items, people).collect():
        same = [x for x in rows if (x["ano"], x["categoria"]) == (r["ano"], r["categoria"])]
        base = {x["id_respondente"] for x in same}
        users = {x["id_respondente"] for x in same if x["tecnologia"] == r["tecnologia"]}
        assert (r["respondentes"], r["base_resposta"]) == (len(users), len(base))
        assert r["itens_por_respondente"] == pytest.approx(len(same) / len(base), abs=0.006)
        assert r["taxa_adocao"] == pytest.approx(100 * len(users) / len(base), abs=0.006)


def test_both_adoption_routes_agree(items, people):
    lists = items.groupBy("ano", "id_respondente", "categoria").agg(
        F.collect_list("tecnologia").alias("itens")
    )
    a = answers.adoption(items, people).collect()
    b = answers.adoption_of_lists(lists, people).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_comparability_guard(spark):
    rows = [(2023, "cloud_uso", "x", 9, 10, 1.0, 50.0, 1), (2024, "cloud_uso", "x", 9, 10, 1.4, 60.0, 1),
            (2023, "banco_dados", "y", 9, 10, 1.0, 5.0, 1), (2024, "banco_dados", "y", 9, 10, 2.0, 90.0, 1),
            (2024, "ferramenta_bi", "z", 9, 10, 1.0, 5.0, 1)]
    tech = spark.createDataFrame(
        rows, "ano int, categoria string, tecnologia string, respondentes int, base_resposta int, "
        "itens_por_respondente double, taxa_adocao double, posicao int")
    kept = answers.comparable_categories(tech).collect()
    assert [r["categoria"] for r in kept] == ["cloud_uso"]
    assert [r["variacao_pp"] for r in reports.tech_growth(tech).collect()] == [10.0]
    assert len(chart_frames.adoption_trend(tech).collect()) == 2
