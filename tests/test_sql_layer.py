"""SQL functions, SQL reports, buckets, ranks and sketches."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.functions.multi import split_top_level
from surveyloom.functions.sql_functions import register_functions
from surveyloom.operators import sketches
from surveyloom.operators.answers import melt_answers
from surveyloom.operators.grouped import median_of_bands
from surveyloom.operators.ranks import rank_in_groups
from surveyloom.plans.sql_reports import REPORTS, report_sql, run_report
from surveyloom.sources import sinks

BANDS = "array<struct<faixa_inferior: double, faixa_superior: double, na_faixa: bigint>>"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def functions(spark):
    register_functions(spark)


@pytest.mark.parametrize(("bands", "median"), [
    ([(0, 1000, 10), (1000, 2000, 20), (2000, 3000, 10)], 1500.0),
    ([(2000, 3000, 20), (0, 1000, 40), (1000, 2000, 30)], 1000 + 1000 * 5 / 30),
    ([(0, 1000, 5), (40001, None, 50)], 40001.0),
    ([(1000, 1000, 5)], 1000.0), ([(None, None, 7), (0, 10, 0)], None), ([], None),
])
def test_median_function(spark, bands, median):
    rows = [([(None if a is None else float(a), None if b is None else float(b), n) for a, b, n in bands],)]
    df = spark.createDataFrame(rows, f"b {BANDS}")
    found = df.select(F.expr("mediana_interpolada(b)"), median_of_bands(F.col("b"))).first()
    assert found[0] == found[1]
    assert found[0] == pytest.approx(median) if median is not None else found[0] is None


def test_split_function(spark):
    texts = ["Azure (Microsoft), AWS (a, b), GCP", "f((a,b),c), SAS/Stata,, [x,y]", "a) b, c", "", None,
             "nan", " NULL ", "x", ",,", "(a, b", "a\t, b", "[(,]), z"]
    chance = random.Random(1)
    texts += ["".join(chance.choices("ab(,)[] ", k=12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.withColumns({"sql": F.expr("separar_respostas(t)"), "df": split_top_level(F.col("t"))})
    assert [tuple(r) for r in wrong.where("NOT sql <=> df").collect()] == []


def test_functions_stay_in_the_jvm(spark):
    plan = plan_of(spark.sql("SELECT separar_respostas(id || ', b') FROM range(9)"))
    assert "Python" not in plan and "Project" in plan


def test_reports_run_on_views_and_prune_editions(spark, tmp_path):
    rows = [(2023, "A", "Pleno", 4, 40.0), (2024, "A", "Pleno", 6, 60.0), (2024, None, "Senior", 4, 40.0),
            (2024, "B", "Senior", 9, 9.0)]
    profile = spark.createDataFrame(
        rows, "ano int, cargo string, senioridade string, respondentes bigint, percentual double"
    )
    sinks.write_table(profile, str(tmp_path / "p"))
    stored = sinks.read_table(spark, str(tmp_path / "p"))
    sinks.register_views(spark, {}, {"perfil_mercado": stored})
    top = run_report(spark, "top_roles", "silver_", "gold_")
    assert [tuple(r) for r in top.collect()] == [("B", 9, 9.0), ("A", 6, 60.0)]
    assert "PartitionFilters: [isnotnull(ano" in plan_of(top).replace("\n", " ")
    assert "dynamicpruning" in plan_of(top).lower() or "Subquery" in plan_of(top)
    mix = run_report(spark, "mix_by_year", "silver_", "gold_").collect()
    assert {tuple(r) for r in mix} == {("Pleno", 4, 6), ("Senior", 0, 13)}


def test_every_report_has_text():
    for name in REPORTS:
        text = report_sql(name, "s.", "g.", (2023, 2024))
        assert "{" not in text and ("s.respondentes" in text or "g." in text)


def test_buckets_join_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS baldes")
    people = spark.range(5000).select(
        (F.col("id") % 3 + 2023).cast("int").alias("ano"), F.col("id").cast("string").alias("id_respondente"),
    )
    items = people.select("ano", "id_respondente", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("t"))
    left = sinks.store_in_buckets(people, "baldes.people", buckets=4)
    right = sinks.store_in_buckets(items, "baldes.items", buckets=4).drop("ano")
    joined = left.hint("merge").join(right, "id_respondente").groupBy("id_respondente").count()
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 5000


def test_bucket_join_derives_silver_in_as_many_tasks_as_the_people_ask_for(spark, monkeypatch):
    from surveyloom.plans.silver import RESPONDENT_COLUMNS
    from verification import sql_layer
    from verification import star_survey as star

    path = "/root/testdata/sf0.001"
    monkeypatch.setattr(sql_layer, "_buckets", {})
    monkeypatch.setattr(star, "_stored", {})
    asked = []
    monkeypatch.setattr(sinks, "buckets_for", lambda people: asked.append(people) or 23)
    result = sorted(map(tuple, sql_layer.silver_join_buckets(spark, path).collect()))
    # No other copy of silver is written first.
    assert asked == [star.table(spark, path, "orders").count()] and star._stored == {}
    [place] = sql_layer._buckets.values()
    people, items = spark.table(f"{place}.respondentes"), spark.table(f"{place}.tecnologias")
    for stored, plain in (
        (people, star.derived_respondents(spark, path)), (items, star.derived_answers(spark, path)),
    ):
        plain = plain.select(*stored.columns)
        assert stored.exceptAll(plain).count() == 0 and plain.exceptAll(stored).count() == 0
        kept = {f.rsplit("/", 1)[-1].rsplit("_", 1)[-1][:5] for f in stored.inputFiles()}
        assert kept == {f"{n:05d}" for n in range(23)}
        # A bucket is one file in each edition: its rows met before they were written.
        assert len(stored.inputFiles()) <= 23 * len(star.editions_of(stored))
    assert set(people.columns) == set(star.derived_respondents(spark, path).columns) <= set(RESPONDENT_COLUMNS)
    # Silver that is stored already is dealt to the buckets, with the same result.
    star.survey_respondents(spark, path), star.survey_answers(spark, path)
    monkeypatch.setattr(sql_layer, "_buckets", {})
    monkeypatch.setattr(sql_layer, "respondents", None)
    assert sorted(map(tuple, sql_layer.silver_join_buckets(spark, path).collect())) == result


def test_buckets_follow_the_people():
    assert sinks.buckets_for(0) == sinks.buckets_for(900_000) == 16
    assert sinks.buckets_for(9_000_000) == 45 and sinks.buckets_for(54_000_001) == 271


def test_a_text_of_answers_is_split_once(spark):
    texts = ["a (b, c), d", " \u00a0, x ,\t", "f((a,b),c), Oracle) DB, [x,(y,z]), q", None, "nan", ",,", "a\x01b, c"]
    df = spark.createDataFrame([(2024, str(n), t) for n, t in enumerate(texts)], "ano int, id string, q string")
    melted = melt_answers(df, ["ano", "id"], {"q": "q"})
    plan = plan_of(melted)
    assert plan.count("(?![^()") == 1 and "explode(CASE" not in plan
    found = {}
    for row in melted.collect():
        found.setdefault(int(row["id"]), []).append(row["tecnologia"])
    assert found == {
        0: ["a (b, c)", "d"], 1: ["x"], 2: ["f((a,b),c)", "Oracle) DB", "[x,(y,z])", "q"], 6: ["a b", "c"],
    }


def ranks(spark, df, order):
    expected = df.withColumn(
        "posicao", F.row_number().over(Window.partitionBy("g").orderBy(*order))
    )
    got = rank_in_groups(df, ["g"], order)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_ranks(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 1009).alias("v"),
        F.col("id"),
    )
    ranks(spark, df, [F.col("v").desc(), F.col("id").asc()])
    ranks(spark, df.limit(0), [F.col("v").desc(), F.col("id").asc()])


def test_one_group_of_two_million_is_ranked_by_many_tasks(spark):
    df = spark.range(2_000_000).select(F.lit("q").alias("g"), (F.col("id") * 48271 % 2147483647).alias("v"))
    ranked = rank_in_groups(df, ["g"], [F.col("v").asc()])
    last = ranked.agg(F.max("posicao"), F.count_distinct("posicao"), F.max_by("v", "posicao"), F.max("v")).first()
    assert last[0] == last[1] == 2_000_000 and last[2] == last[3]
    plan = plan_of(ranked)
    assert "Window" in plan and "row_number" not in plan


def test_sketches_count_people_of_several_editions_once(spark):
    items = spark.range(60_000).select(
        (F.col("id") % 3 + 2023).alias("ano"), F.lit("c").alias("categoria"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("tecnologia"),
        (F.col("id") % 20_000).alias("id_respondente"),
    )
    sketched = sketches.people_sketches(items)
    assert sketched.count() == 6
    found = {r["tecnologia"]: (r["pessoas_aprox"], r["edicoes"]) for r in sketches.united_people(sketched).collect()}
    exact = {r[0]: r[1] for r in items.groupBy("tecnologia").agg(F.count_distinct("id_respondente")).collect()}
    for name, (about, editions) in found.items():
        assert editions == 3 and abs(about - exact[name]) <= 5 * sketches.STANDARD_ERROR * exact[name] + 2
    fewer = sketches.united_people(sketched.where("ano < 2025")).collect()
    assert all(r["edicoes"] == 2 for r in fewer)
