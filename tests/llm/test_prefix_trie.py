import hashlib
import random
import zlib

import duckdb
import pytest
from oracle_compare import differences
from pyspark.sql import functions as F

from surveyloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """All nodes by writing every prefix out."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole[c] = tuple(turns.get(donor, [])[:h] + own[h:])
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == node)))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(m[: len(n)] == n and len(m) > len(n) for m in below) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def nodes(df, turns=pt.SHARD_TURNS):
    got = pt.prefix_nodes(df, turns).select(*pt.RESULT).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def random_rows(seed, convs, texts, longest):
    chance = random.Random(seed)
    return [
        (c, t, chance.choice(["user", "assistant", None]), chance.choice(texts))
        for c in chance.sample(range(-convs, 2 * convs), convs)
        for t in range(chance.randint(1, longest))
    ]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_in_many_shards(spark, seed):
    rows = random_rows(seed, 120, ["a", "b", "", None, "é€"], 12)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute_force(rows)
    assert nodes(df) == expected
    assert nodes(df, 10) == expected


def test_one_popular_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 3000, 5) for t in range(10)]
    rows += random_rows(1, 60, ["x", "same 0"], 9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(df, 15) == brute_force(rows)


def test_long_conversation_and_popular_beginning(spark):
    rows = [(0, t, "user", str(t)) for t in range(400)]
    rows += [(5 * c, t, "user", str(t) if t < 90 else f"{c} {t}") for c in range(1, 9) for t in range(95)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(df, 7) == brute_force(rows)


def test_pieces_of_ids(spark, monkeypatch):
    df = spark.range(0, 1000).select(F.lit("k").alias("key"), F.col("id").alias("conv_id"))
    df = df.unionByName(spark.range(1000, 1003).select(F.lit("m").alias("key"), F.col("id").alias("conv_id")))
    monkeypatch.setattr(pt, "PIECE", 7)
    got = {r["key"]: r["ends_sha256"] for r in pt.ends(df.repartition(5)).collect()}
    for key, ids in (("k", range(1000)), ("m", range(1000, 1003))):
        assert got[key] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_odd_rows_against_sql(spark):
    rows = [
        (1, None, "user", "late"), (1, 0, "user", "first"), (1, 0, "user", "first"),
        (None, 0, "user", "nobody"), (0, 5, None, None), (0, 5, "", ""), (2, 1, "us", "er1"),
        (2, 2, "user", "1"), (-3, 0, "user", "below"), (3, 0, "user", "x" * 300_000), (7, 1, None, "a"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    connection = duckdb.connect()
    connection.execute(
        "CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)"
    )
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert differences(pt.prefix_nodes(df), connection, pt.ORACLE) is None
    clashing = df.withColumn("key", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("family", F.lit(3))
    assert differences(pt.prefix_nodes(clashing), connection, pt.ORACLE) is None


def test_empty_table(spark):
    assert pt.prefix_nodes(spark.createDataFrame([], SCHEMA)).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)
    assert pt.prefix_nodes(nobody).collect() == []


def test_siblings_are_balanced():
    tree = pt.TernaryTree()
    for place in pt.medians(1023):
        tree.insert([place])

    def height(node):
        return 0 if not node else 1 + max(height(tree.left[node]), height(tree.right[node]))

    assert height(tree.down[0]) == 10
    assert sorted(pt.medians(10)) == list(range(10))
