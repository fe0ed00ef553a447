"""The corpus pipeline: stages against their operators, odd rows, and what each may do."""

from pathlib import Path

import corpus_pipeline
import pytest
from surveyloom.llm import bpe_automaton, decontaminate, pii_crf, quality_rules, simhash

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_each_stage_does_what_its_operator_says(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF_DIR).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "encoding":
            assert after.columns == docs.columns
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        assert len(ids) == len(set(ids))
        kept[name] = ids
        if name == "quality_rules":
            expected = quality_rules.apply_rules(before).where("kept")
        elif name == "near_dedup":
            expected = simhash.near_duplicates(before).where("doc_id = component_id")
        elif name == "decontamination":
            leaks = decontaminate.find_leaks(before, benchmark).select("doc_id")
            expected = before.join(leaks, "doc_id", "left_anti")
        else:
            expected = before
        assert ids == sorted(r.doc_id for r in expected.select("doc_id").collect()), name
        if name == "personal_data":
            field = pii_crf.train()
            texts = {r.doc_id: r.text for r in before.collect()}
            for r in after.collect():
                ((_, spans),) = pii_crf.find_spans([texts[r.doc_id]], field)
                assert r.text == pii_crf.masked(texts[r.doc_id], spans)
                assert r.n_chars == len(r.text)
        if name == "encoding":
            assert sorted(map(tuple, after.collect())) == sorted(
                map(tuple, bpe_automaton.encoding_digests(before).collect())
            )
        before = after
    assert len(kept["encoding"]) > 100
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == kept["encoding"]


def test_odd_rows_pass_through_every_stage(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long, None, None, None), (2, None, "en", "s", 1), (3, "", "en", "s", 0),
            (1, long, None, None, None), (None, "words " + long, "en", "s", 5),
            (4, " ".join(f"token{i} a@b.co" for i in range(30)), "en", "s", 9)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], f"{SCHEMA}, kept string")
    for frame in (docs, docs.where("false")):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{frame is docs}")
            stage(spark, now, SF_DIR).write.parquet(path)
            now = spark.read.schema(now.schema).parquet(path) if name != "encoding" else \
                spark.read.parquet(path)
        ids = [r.doc_id for r in now.collect()] if frame is docs else []
        assert sorted(map(str, ids)) == (["1", "4", "None"] if frame is docs else [])
