import itertools
import random

import duckdb
import pytest
from oracle_compare import differences
from pyspark.sql import functions as F

from surveyloom.llm import url_filter as uf

ODD = [
    None, "", "no address", "://", "http://", "http://NET/", "http://a.net", "http://a.net/",
    "HTTP://WWW.Example.NET/en/x", "http://example.net/EN/x", "http://xexample.net/en/",
    "http://a.net:80/", "http://a.b.example.com/de/", "http://example.com/de", "http://org/fr/?q",
    "http://user@x.org/fr/1", "x http://a.net/ http://b.org/fr/", "http://a.org?x=/fr/",
    "http://a.org#/fr/", "a://b://net/", "http://shop.info/login", "http://docs.info/a/login",
    "http://shop.info/loginpage", "http://cheap-pills.info/x", "http://notcheap-pills.info/x",
    "http://x.info/file.zip", "http://x.info/file.zip\n", "http://x.info/a?sessionid=1",
    "http://x.info/banner/7/8/click", "http://é.net/ü", "http://a\n.net/b\nc", "net/", "http://.net/",
]


def pages_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def against_sql(spark, df):
    connection = duckdb.connect()
    connection.register("pages", df.select("page_id", "url").toPandas())
    return differences(uf.judge_urls(df), connection, uf.oracle())


def test_odd_urls_against_sql(spark):
    assert against_sql(spark, pages_of(spark, ODD)) is None


def test_random_urls_against_sql(spark):
    chance = random.Random(3)
    pieces = ["http://", "example", ".", "net", "org", "com", "/", "en", "de", "fr", "login", "?",
              "#", "cart", "-casino.", "docs", "N", "=", "sessionid", "&", ".zip", "://", "track", "_"]
    urls = ["".join(chance.choices(pieces, k=chance.randint(1, 12))) for _ in range(1500)]
    urls += ["http://" + "".join(chance.choices(pieces, k=8)) for _ in range(1500)]
    assert against_sql(spark, pages_of(spark, urls)) is None


def test_repeated_rows_ids_and_clashing_columns(spark):
    rows = [(1, "http://a.net/", "r")] * 3 + [(None, "http://a.org/fr/", None)] * 2
    rows += [(1, "http://a.org/", "v")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    df = df.withColumn("token", F.lit("net")).withColumn("verdict", F.lit(1)).withColumn("Text", F.lit(2))
    out = sorted(map(tuple, uf.judge_urls(df).collect()), key=repr)
    assert out == sorted(
        [(1, "a.net", "/", "net/", "block")] * 3
        + [(None, "a.org", "/fr/", "org/fr/", "allow")] * 2 + [(1, "a.org", "/", None, "allow")],
        key=repr,
    )


def test_empty_tables(spark):
    assert uf.judge_urls(pages_of(spark, []).limit(0)).collect() == []
    none = uf.rule_table(spark, (), ())
    out = uf.judge_urls(pages_of(spark, ODD), none).collect()
    assert len(out) == len(ODD) and {r["verdict"] for r in out} == {"allow"}


def test_rules_are_filed_under_their_rarest_whole_token(spark):
    urls = pages_of(spark, ["http://a.net/en/"] * 5 + ["http://b.example.net/fr/"] * 2)
    rules = uf.rule_table(
        spark, [("example.net/en/", "block"), ("net/e", "block")],
        [("||example.net/en", "block"), ("xa*", "block"), ("|http://a.", "allow"), ("/en/fr|", "allow")],
    )
    filed = {(r["kind"], r["text"]): r["token"] for r in uf.rarest_tokens(urls, rules).collect()}
    assert filed == {
        ("prefix", "example.net/en/"): "example", ("prefix", "net/e"): "net",
        ("pattern", "||example.net/en"): "example", ("pattern", "xa*"): "",
        ("pattern", "|http://a."): "a", ("pattern", "/en/fr|"): "fr",
    }


def test_rules_without_a_token_meet_every_url(spark):
    urls = pages_of(spark, ["http://a.info/xab", "http://a.info/ab"])
    out = uf.judge_urls(urls, uf.rule_table(spark, (), [("xa*", "block")])).collect()
    assert {r["page_id"]: r["verdict"] for r in out} == {0: "block", 1: "allow"}


@pytest.mark.parametrize("order", list(itertools.permutations([0, 1, 2])))
def test_longest_rule_and_ties(spark, order):
    rules = [("a.io/", "allow"), ("x.a.io/", "block"), ("io/a.b/", "allow")]
    table = uf.rule_table(spark, [rules[i] for i in order], ())
    urls = pages_of(spark, ["http://x.a.io/", "http://y.a.io/", "http://x.a.io/a.b/"])
    out = {r["page_id"]: r["rule"] for r in uf.judge_urls(urls, table).collect()}
    assert out == {0: "x.a.io/", 1: "a.io/", 2: "x.a.io/"}


def test_shuffled_index_gives_the_same(spark):
    df = pages_of(spark, ODD)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert against_sql(spark, df) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plan_is_native(spark):
    plan = uf.judge_urls(pages_of(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapIn"))
