"""Quality rules and classifier: counts and estimates against brute force, odd rows, accuracy."""

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from surveyloom.llm import quality_classifier as qc
from surveyloom.llm import quality_rules as qr

SF_DIR = "/root/testdata/sf0.01"
given_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, grp string"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            covered |= set(range(i, i + 8))
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def test_base_counts():
    rng = random.Random(3)
    texts = ["", "\n", " \x0b\n \x0b\n", "a\x1cb c\x85d\xa0e", "x " * 9, "a b c d e f g h " * 3]
    for _ in range(400):
        letters = rng.choice(["ab \n", "a \n#", "abcdé \t\r\n|*", "a b c d e f g h i\n"])
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 120))))
    for text in texts:
        assert qr.base_counts(text) == brute_counts(text), repr(text)


def invented(rng, n, junk=False):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return " ".join(w + ("***" if junk else "") for w in words)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = []
    for i in range(700):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        rows.append((i, invented(rng, rng.randint(25, 300), i % 29 == 0), "en", source))
    rows += [(1000 + i, invented(rng, 60), "xx", "rare") for i in range(5)]
    rows += [(2000, None, "en", "hot"), (2001, "", None, None), (2002, "one two", "en", "hot"),
             (2003, "same words " * 40, "en", "hot"), (None, invented(rng, 80), None, "hot"),
             (2004, invented(rng, 40_000), "en", "hot"), rows[1], rows[1]]
    full = [(i, t, lang, s, 0, 9, "clash") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


def median(values):
    return sorted(values)[int(np.ceil(0.5 * len(values))) - 1]


def brute_vectors(counts, shapes):
    """Fixed-point vectors of one group: every text with 200 words of median shares on top."""
    sides = [[(c[1], c[0]), (s[0], c[1]), (s[1], c[0]), (s[2], c[0])]
             for c, s in zip(counts, shapes, strict=True)]
    middle = [median([row[i][0] / row[i][1] for row in sides]) for i in range(4)]
    out = []
    for row in sides:
        x = []
        for i, (part, whole) in enumerate(row):
            weight = qr.PRIOR_WORDS * (middle[0] if i == 1 else 1)
            share = (part + weight * middle[i]) / (whole + weight)
            x.append(round(qr.SCALE * np.log(share if i == 0 else 1 + 100 * share)))
        out.append(x)
    return np.array(out)


def spark_hash(start, vector):
    seed = xxhash.xxh64_intdigest(int(start).to_bytes(4, "little"), seed=42)
    for value in vector:
        seed = xxhash.xxh64_intdigest(int(value).to_bytes(8, "little", signed=True), seed=seed)
    return seed


def brute_estimate(fixed):
    """Centre, covariance and rows of one group: concentration steps with plain sorting."""
    x = fixed / qr.SCALE

    def fit(rows, factor=1.0):
        cov = np.cov(rows.T, bias=True) * factor
        return rows.mean(axis=0), cov + qr.RIDGE * np.eye(qr.DIM), len(rows)

    ordered = np.sort(x, axis=0)
    q = [ordered[int(np.ceil(p * len(x))) - 1] for p in (0.125, 0.5, 0.875)]
    starts = [fit(x), (q[1], np.diag(((q[2] - q[0]) / 2.3) ** 2 + qr.RIDGE), 0)]
    for start in range(2, 2 + qr.RANDOM_STARTS):
        drawn = np.array([spark_hash(start, v) % 2**52 / 2.0**52 for v in fixed])
        chosen = x[drawn * len(x) < qr.START_ROWS]
        starts += [fit(chosen)] if len(chosen) else []
    results = []
    for estimate in starts:
        for step in range(qr.STEPS):
            d = distances(x, estimate[0], estimate[1])
            bins = np.floor(np.log2(np.maximum(d, 2.0**-20)) * qr.BINS_PER_OCTAVE)
            cut = np.sort(bins)[int(np.ceil(qr.SUBSET * len(x))) - 1]
            estimate = fit(x[bins <= cut], qr.CONSISTENCY if step == qr.STEPS - 1 else 1.0)
        results.append((np.linalg.slogdet(estimate[1])[1], estimate))
    return min(results, key=lambda r: r[0])[1]


def distances(x, centre, cov):
    d = x - centre
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def test_distances_are_those_of_plain_concentration_steps(docs):
    found = qr.apply_rules(docs).collect()
    assert len(found) == docs.count()
    by_text = {}
    for row in docs.collect():
        text = row.text or ""
        by_text.setdefault(row.doc_id, (row, qr.base_counts(text), qr.shape_counts(text)))
    groups = {}
    for row, counts, shape in by_text.values():
        if counts[0] >= 20 and 100 * counts[4] <= 30 * counts[0]:
            times = 3 if row.doc_id == 1 else 1
            groups.setdefault((row.lang, row.source), []).extend([(row.doc_id, counts, shape)] * times)
    large = [g for g in groups.values() if len(g) >= qr.MIN_ROWS]
    assert len(large) >= 4
    members = [*large, [m for g in groups.values() if len(g) < qr.MIN_ROWS for m in g]]
    vectors = [brute_vectors([c for _, c, _ in g], [s for _, _, s in g]) for g in members]
    estimates = [brute_estimate(v) for v in vectors]
    # All groups together, and how far each leans on that.
    rows = sum(n for _, _, n in estimates)
    mean = sum(n * c for c, _, n in estimates) / rows
    square = sum(n * (v + np.outer(c, c)) for c, v, n in estimates) / rows - np.outer(mean, mean)
    k = qr.PRIOR_ROWS
    common = (rows * square + k * qr.PRIOR_SPREAD**2 * np.eye(qr.DIM)) / (rows + k)
    got = {r.doc_id: r for r in found}
    for group, fixed, (centre, cov, n) in zip(members, vectors, estimates, strict=True):
        centre, cov = (n * centre + k * mean) / (n + k), (n * cov + k * common) / (n + k)
        expected = distances(fixed / qr.SCALE, centre, cov)
        for (doc_id, _, _), d in zip(group, expected, strict=True):
            assert got[doc_id].distance == pytest.approx(d, rel=1e-6, abs=1e-9)
            assert got[doc_id].kept == (d <= qr.limit_of(n + qr.PRIOR_ROWS))
    junk = [got[i] for i in range(0, 700, 29)]
    assert not any(r.kept for r in junk)
    clean = [got[i].kept for i in range(700) if i % 29]
    assert all(clean)
    for i in (2000, 2001, 2002, 2003):
        assert got[i].base_failed and not got[i].kept and got[i].distance is None
    # A handful of rows is judged by what it shares with all others.
    assert all(got[1000 + i].kept and got[1000 + i].distance > 0 for i in range(5))
    assert got[None].kept and got[2004].kept


def test_many_groups_give_the_same_as_few(docs, monkeypatch):
    few = {r.doc_id: r for r in qr.apply_rules(docs).collect()}
    monkeypatch.setattr(qr, "BROADCAST_ROWS", 0)
    many = qr.apply_rules(docs).collect()
    assert len(many) == docs.count()
    for r in many:
        assert r.kept == few[r.doc_id].kept
        assert r.distance == pytest.approx(few[r.doc_id].distance)


def test_limit_and_consistency_are_those_of_the_chi_square_law():
    def within(x, degrees):
        """Share of a chi-square law of an even number of degrees."""
        terms = [(x / 2) ** k / math.factorial(k) for k in range(degrees // 2)]
        return 1 - math.exp(-x / 2) * sum(terms)

    # Many rows: the chi-square law. Few: the F-ratio, its density summed up in small steps.
    assert within(qr.limit_of(1e7), qr.DIM) == pytest.approx(1 - qr.BEYOND, abs=1e-8)
    for degrees in (11, 30, 200):
        f = (np.arange(4_000_000) + 0.5) / 4000
        g = math.lgamma((4 + degrees) / 2) - math.lgamma(2) - math.lgamma(degrees / 2)
        density = np.exp(g) * (4 / degrees) ** 2 * f * (1 + 4 * f / degrees) ** (-(4 + degrees) / 2)
        beyond = density[4 * f > qr.limit_of(degrees)].sum() / 4000
        assert beyond == pytest.approx(qr.BEYOND, rel=0.01)
    low, high = 0.0, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if within(mid, qr.DIM) < qr.SUBSET else (low, mid)
    assert qr.CONSISTENCY == pytest.approx(qr.SUBSET / within(low, qr.DIM + 2), rel=1e-4)


@given_tables
def test_clean_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = qr.apply_rules(docs).where(~F.col("base_failed")).join(labels, "doc_id")
    share = {r.quality: r.share for r in judged.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.995 and share[0] < 0.05
    # The distances follow the law, so the limit is no matter of taste.
    middle = judged.where("quality = 1").agg(F.percentile("distance", 0.5).alias("m")).first().m
    assert 2.0 < middle < 4.5


def test_stage_keeps_rows_and_columns(docs):
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in qr.apply_rules(docs).where("kept").collect() if r.doc_id)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == ids
    none = docs.where("false")
    assert qr.apply_rules(none).count() == 0 and qr.keep_good(none).count() == 0


def test_trees_walk_as_one_row_at_a_time():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5)).round(1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] < 0)).astype(float)
    trees = qc.grow_trees(x, y)
    scores = trees.scores(x)

    def walk(row):
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + (row[feature[at]] > threshold[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert scores == pytest.approx([walk(row) for row in x])
    assert ((scores > 0.5) == y).mean() > 0.97
    assert qc.grow_trees(x[:0], y[:0]).scores(x[:3]) == pytest.approx([0.5] * 3)
    assert qc.grow_trees(x, y * 0 + 1).scores(x[:1])[0] == pytest.approx(601 / 602)


@given_tables
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = qc.score_documents(docs, labels)
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in held)


def test_classifier_takes_odd_rows(docs, spark):
    labels = spark.createDataFrame(
        [(i, 0 if i % 29 == 0 else 1, "x") for i in range(300)]
        + [(None, 1, "x"), (5, None, "x"), (6, 7, "x"), (1, 1, "x"), (99999, 0, "x")],
        "doc_id long, quality int, score string",
    )
    found = {r.doc_id: r for r in qc.score_documents(docs, labels).collect()}
    assert found[None].held_out is False and 0 <= found[2000].score <= 1
    assert found[2000].score == found[2001].score
    held = [r for i, r in found.items() if i is not None and i < 700 and r.held_out]
    assert sum(r.predicted == (r.doc_id % 29 != 0) for r in held) / len(held) > 0.95
    none = qc.score_documents(docs.where("false"), labels.where("false"))
    assert none.count() == 0
    same = qc.score_documents(docs, labels.where("false")).select("score").distinct().collect()
    assert [r.score for r in same] == [0.5]
    remainder = docs.select("doc_id", qc.held_out(F.col("doc_id")).alias("h")).collect()
    import zlib

    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in remainder if r.doc_id)


def test_a_null_source_is_no_pool_of_small_ones(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(i, words, "en", None if i < 70 else f"s{i}") for i in range(140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    counted = docs.withColumn("base_failed", F.lit(False))
    names = {(r.g_lang, r.g_source): r.grp for r in qr.group_names(counted).collect()}
    assert names["en", None] != names["en", "s70"] == names["en", "s139"]


def test_boosting_against_a_plain_booster(monkeypatch):
    """Every split is the best of all, and every leaf the step of its rows, found row by row."""
    monkeypatch.setattr(qc, "TREES", 4)
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(200, 4)), 2)
    y = ((x[:, 0] + x[:, 1] ** 2 + rng.normal(size=200) / 2) > 0.8).astype(float)
    trees = qc.grow_trees(x, y)
    share = (y.sum() + 1) / 202
    least = min(qc.LEAST_WEIGHT, qc.LEAST_SHARE * 200 * share * (1 - share))
    edges = [sorted(np.quantile(x[:, f], k / qc.BINS, method="lower") for k in range(1, qc.BINS)) for f in range(4)]
    score = [float(np.log(share / (1 - share)))] * 200
    assert trees.base == pytest.approx(score[0])

    def sums(rows, p):
        return sum(y[r] - p[r] for r in rows), sum(p[r] * (1 - p[r]) for r in rows)

    def gain(rows, p, feature, threshold):
        left = [r for r in rows if x[r, feature] <= threshold]
        right = [r for r in rows if x[r, feature] > threshold]
        (g, h), (gl, hl), (gr, hr) = (sums(part, p) for part in (rows, left, right))
        if hl < least or hr < least:
            return 0.0
        return gl**2 / (hl + qc.PENALTY) + gr**2 / (hr + qc.PENALTY) - g**2 / (h + qc.PENALTY)

    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        p = [1 / (1 + np.exp(-s)) for s in score]
        at = {0: list(range(200))}
        for node in range(len(feature)):
            rows = at.pop(node)
            best = max((gain(rows, p, f, t) for f in range(4) for t in set(edges[f])), default=0.0)
            if np.isinf(threshold[node]):
                assert best <= 1e-9
            else:
                assert gain(rows, p, feature[node], threshold[node]) == pytest.approx(best, rel=1e-9)
            at[2 * node + 1] = [r for r in rows if x[r, feature[node]] <= threshold[node]]
            at[2 * node + 2] = [r for r in rows if x[r, feature[node]] > threshold[node]]
        for place, value in enumerate(leaf):
            rows = at[place + len(feature)]
            g, h = sums(rows, p)
            assert value == pytest.approx(qc.LEARNING_RATE * g / (h + qc.PENALTY), abs=1e-12)
            for r in rows:
                score[r] += value
    assert trees.scores(x) == pytest.approx([1 / (1 + np.exp(-s)) for s in score])
