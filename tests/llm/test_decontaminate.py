"""Decontamination: alignment against the plain recurrence, planted leaks, odd rows."""

import random

import numpy as np
import pytest
from surveyloom.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, item_id string"


def brute_score(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + dc.GAP, h[i, j - 1] + dc.GAP)
    return h.max()


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (rng.integers(0, 4, rng.integers(1, 15)) for _ in range(2))
        score, end = dc.best_alignment(a, b)
        assert score == brute_score(a.tolist(), b.tolist())
        assert not score or brute_score(a.tolist(), b[:end].tolist()) == score


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(900)]
    common = vocabulary[:12]

    def prose(n):
        return [rng.choice(common if rng.random() < 0.4 else vocabulary) for _ in range(n)]

    items = [(i, prose(rng.randint(15, 50))) for i in range(30)]
    rows, leaked = [], set()
    for i in range(400):
        words = prose(rng.randint(30, 400))
        if i % 5 == 0:
            item, body = items[i // 5 % 30]
            body = list(body)
            if i % 10 == 0:  # edited: every eighth word exchanged, one left out
                body = [("edit" if k % 8 == 4 else w) for k, w in enumerate(body) if k != 9]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in body] if i % 15 == 0 else body
            leaked.add((i, item))
        rows.append((i, " ".join(words), "en", "s", 1, "clash"))
    rows += [(900, None, None, None, None, None), (901, "", "en", "s", 0, "x"),
             (902, " ".join(items[0][1] * 400), "en", "s", 0, "x"),
             (None, "so " + " ".join(items[1][1]), "en", "s", 0, "x"), rows[0]]
    leaked |= {(902, 0), (None, 1)}
    benchmark = [(i, " ".join(w)) for i, w in items] + [(77, None), (78, "two words"), (79, "")]
    return (
        spark.createDataFrame(rows, DOCS).repartition(5),
        spark.createDataFrame([(*b, 0) for b in benchmark], "item_id long, text string, score int"),
        leaked,
    )


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 200])
def test_planted_leaks(tables, block_words):
    docs, benchmark, leaked = tables
    found = dc.find_leaks(docs, benchmark, block_words).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaked
    assert len(found) == len(leaked) + 1  # row 0 is there twice
    texts = {r.doc_id: dc.words_of(r.text or "") for r in docs.collect()}
    items = {r.item_id: dc.words_of(r.text or "") for r in benchmark.collect()}
    for r in found[:40]:
        window = texts[r.doc_id][r.first_word : r.end_word]
        assert brute_score(items[r.item_id], window) == r.score
        assert r.share == pytest.approx(r.score / (2 * len(items[r.item_id])))


def test_stage_drops_leaks_only(tables):
    docs, benchmark, leaked = tables
    kept = dc.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {i for i, _ in leaked}
    expected = sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in bad)
    assert sorted(str(r.doc_id) for r in kept.collect()) == expected


def test_common_runs_are_no_seeds_unless_an_item_has_no_other(spark):
    docs = [(i, f"x{i} of the one y{i} a b c") for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = dc.build_items([(1, "of the one rare word here"), (2, "a b c")])
    rare = dc.rare_seeds(frame, items, common=0.1)
    names = {v: k for k, v in items.vocabulary.items()}

    def words(key):
        n = len(items.vocabulary)
        return " ".join(names[k] for k in (key // n // n, key // n % n, key % n))

    by_words = {words(int(k)): bool(r) for k, r in zip(items.seeds, rare)}
    assert by_words == {"of the one": False, "the one rare": True, "one rare word": True,
                        "rare word here": True, "a b c": True}


def test_empty_tables(tables):
    docs, benchmark, _ = tables
    none = benchmark.where("false")
    assert dc.find_leaks(docs, none).count() == 0
    assert dc.drop_leaks(docs, none).count() == docs.count()
    assert dc.find_leaks(docs.where("false"), benchmark).count() == 0


@pytest.mark.parametrize("n_words", [25, 40, 59])
def test_common_edited_copies_are_found(spark, n_words):
    rng = random.Random(n_words)
    item = [f"w{i}" for i in range(n_words)]
    copy = " ".join("edit" if i % 4 == 3 else w for i, w in enumerate(item))
    plain = [" ".join(rng.choice(item) + "x" for _ in range(50)) for _ in range(200)]
    rows = list(enumerate([f"before {copy} after {i}" for i in range(100)] + plain))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = dc.find_leaks(docs, benchmark).collect()
    assert sorted(r.doc_id for r in found) == list(range(100))
    assert sorted(r.doc_id for r in dc.drop_leaks(docs, benchmark).collect()) == list(range(100, 300))


def test_null_items_and_columns_of_another_case(spark):
    item = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, "nothing")], "doc_id long, Text string")
    benchmark = spark.createDataFrame([(None, item), (-1, "other words here")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in dc.find_leaks(docs, benchmark).collect()] == [(1, None)]
    kept = dc.drop_leaks(docs, benchmark)
    assert kept.columns == ["doc_id", "Text"] and [r.doc_id for r in kept.collect()] == [2]


def test_a_lone_frequent_phrase_opens_nothing_but_pairs_do(spark):
    """Each document shares words with the item, but only one of its runs of three."""
    item = [f"w{i}" for i in range(24)]
    lone = " ".join(w if i % 3 or i == 3 else "edit" for i, w in enumerate(item))
    rows = [(i, f"{lone} {i}") for i in range(40)] + [(99, " ".join(item))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = dc.build_items([(5, " ".join(item))])
    numbers = items.numbers(lone)
    at, seed = items.hits(numbers)
    assert len(dc.rare_seeds(docs, items)) == 22 and len(at) >= 1
    found = dc.find_leaks(docs, spark.createDataFrame([(5, " ".join(item))], "item_id long, text string"))
    assert 99 in {r.doc_id for r in found.collect()}


KINDS = {
    "replaced": lambda rng, words: [w if rng.random() > 0.2 else "new" for w in words],
    "dropped": lambda rng, words: [w for w in words if rng.random() > 0.2],
    "inserted": lambda rng, words: [x for w in words for x in ((w,) if rng.random() > 0.2 else (w, "new"))],
    "moved": lambda rng, words: words[len(words) // 2:] + words[: len(words) // 2],
}


@pytest.mark.parametrize("kind", KINDS)
def test_recall_over_kinds_of_edit(spark, kind):
    rng = random.Random(kind)
    bank = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("ane", "ole", "ith", "ur", "est", "ing", "ay", "o")]
    items = [[rng.choice(bank) for _ in range(rng.randint(30, 70))] for _ in range(120)]
    rows = [
        (i, " ".join(rng.choices(bank, k=40) + KINDS[kind](rng, list(item)) + rng.choices(bank, k=60)))
        for i, item in enumerate(items)
    ] + [(1000 + i, " ".join(rng.choices(bank, k=150))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, benchmark).collect()}
    assert len({(i, i) for i in range(120)} & found) >= 0.95 * 120
    assert not [pair for pair in found if pair[0] >= 1000]
