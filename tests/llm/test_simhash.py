"""SimHash: fingerprints, covering anchors and components against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from surveyloom.llm import simhash
from surveyloom.llm.components import star_roots


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    bits = np.array(fps, np.int64).view(np.uint64)
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= simhash.THRESHOLD)
        for j in near:
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    out = defaultdict(set)
    for i, fp in enumerate(fps):
        out[find(i)].add(fp)
    return sorted(map(sorted, out.values()))


def near(fp, bits, rng):
    for bit in rng.sample(range(64), bits):
        fp ^= 1 << bit
    return fp


@pytest.mark.parametrize("homes", [simhash.HOMES, 40])
def test_components_of_random_and_crowded_fingerprints(spark, monkeypatch, homes):
    """With few homes to a task, anchors are dealt to several tasks and find the same."""
    monkeypatch.setattr(simhash, "HOMES", homes)
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(400)]
    fps += [near(f, rng.randint(1, 6), rng) for f in fps[:150] for _ in range(3)]
    fps += [near(fps[0], rng.randint(1, 3), rng) for _ in range(500)]
    chain = fps[1]
    for _ in range(30):
        chain = near(chain, 4, rng)
        fps.append(chain)
    fps = sorted(set(np.array(fps, np.uint64).view(np.int64).tolist()))
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in star_roots(simhash.near_links(nodes)).collect()}
    found = defaultdict(set)
    for fp in fps:
        found[roots.get(fp, fp)].add(fp)
    assert sorted(map(sorted, found.values())) == brute_components(fps)


def test_every_pair_within_one_bit_meets_at_a_home():
    syndrome, flips, home = simhash.code_masks(21)
    rng = random.Random(1)
    for _ in range(3000):
        x = rng.getrandbits(21)
        y = x ^ (1 << rng.randrange(21))
        own = x ^ int(home[syndrome[x & 0x7FFF]])
        assert own in (y ^ flips[syndrome[y & 0x7FFF]]).tolist()


def brute_fingerprint(spark, text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    frame = spark.createDataFrame([(s,) for s in shingles], "s string")
    hashes = [r.h % 2**64 for r in frame.select(F.xxhash64("s").alias("h")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint(spark):
    texts = ["", " \n", "One", "A b C", "Éa É b\x0bc\x1dd e F", "x y z w " * 5 + "tail end"]
    for text in texts:
        assert simhash.fingerprint(text) == brute_fingerprint(spark, text), text


def documents(spark):
    body = " ".join(f"word{i % 97} thing{i}" for i in range(400))
    texts = [body, body, body.replace("thing399", "other"), "", None, " \t", "quite different text",
             " ".join(f"much{i} else{i * 3}" for i in range(300))]
    rows = [(i + 10, t, "en", "s", 1, "clash") for i, t in enumerate(texts)]
    rows += [rows[0], (None, body, "en", "s", 1, "clash"), (None, "no one has this", "en", "s", 1, "c")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    return spark.createDataFrame(rows, schema)


def test_near_duplicates_with_nulls_ties_and_repeated_rows(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert by_id[10] == by_id[11] == 10
    assert by_id[13] == by_id[14] == by_id[15] == 13
    assert {r.fingerprint for r in found if r.doc_id in (13, 14, 15)} == {"0" * 16}
    assert sorted(str(r.component_id) for r in found if r.doc_id is None) == ["10", "None"]
    fps = sorted({int(np.uint64(int(r.fingerprint, 16)).view(np.int64)) for r in found})
    components = {r.component_id for r in found}
    assert len(components) == len(brute_components(fps))


def test_one_of_each_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(10) == 1 and 11 not in ids and 14 not in ids and ids.count(None) == 2


def test_empty_table(spark):
    none = documents(spark).where("false")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one_of_each(none).count() == 0


def test_different_texts_under_one_id_all_stay(spark):
    a = " ".join(f"alpha{i}" for i in range(60))
    b = " ".join(f"beta{i}" for i in range(60))
    rows = [(1, a, 7), (1, b, 8), (1, a, 7), (2, a, 9), (3, b, 1), (None, a, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(map(str, kept.collect()))
    assert found == sorted(map(str, docs.where("doc_id IS NULL OR digest IN (7, 8)").distinct().collect()))


def test_forest_connects_what_homes_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 6)
    fps = np.unique(np.concatenate([
        base[rng.integers(0, 6, 400)] ^ (1 << rng.integers(0, 62, 400)) ^ (1 << rng.integers(0, 62, 400)),
        base,
    ]))
    homes = rng.random(len(fps)) < 0.2
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= simhash.THRESHOLD
    near &= homes[:, None] | homes[None, :]

    def classes(pairs):
        root = {int(f): int(f) for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(int(a))] = find(int(b))
        groups = {}
        for f in root:
            groups.setdefault(find(f), set()).add(f)
        return {frozenset(g) for g in groups.values()}

    links = simhash._forest(homes, fps)
    assert classes(links.T) == classes([(fps[i], fps[j]) for i, j in np.argwhere(near) if i < j])
    assert links.shape[1] < len(fps)
