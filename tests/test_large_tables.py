"""What keeps work in proportion to large inputs; results are those of the plain way."""

import pytest

from surveyloom.sources import bronze
from verification import raw_editions
from verification import star_survey as star

SMALL = "/root/testdata/sf0.001"


def _csv(folder, lines, end="\n"):
    folder.mkdir()
    (folder / "p.csv").write_bytes(("a,b\n" + end.join(lines) + end).encode())
    return str(folder)


def test_files_without_line_breaks_in_fields_are_split(spark, tmp_path):
    lines = [f'{n},"x ""{n}"", y"' if n % 3 else f'"{n}",plain' for n in range(4000)]
    path = _csv(tmp_path / "plain", [*lines, "", '"",'])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        [group] = bronze.group_files(spark, {2024: path})
        rows = bronze.read_group(spark, group)
        assert rows.rdd.getNumPartitions() > 4
        whole = bronze.read_survey_csv(spark, path)
        assert whole.count() == 4001
        assert sorted(r[:2] for r in rows.na.fill("-").collect()) == sorted(
            tuple(r) for r in whole.na.fill("-").collect()
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "line", ['1,"two\nlines"', '1,a""b\n', "1,a\rb", "1", "1,2,3", "   ", '"1" ,2', '1,"a", "b\n c"']
)
def test_lines_that_may_be_no_whole_rows_keep_a_file_in_one_piece(spark, tmp_path, line):
    path = _csv(tmp_path / "odd", ["0,first", line, "2,last"])
    [group] = bronze.group_files(spark, {2024: path})
    assert not group.files[0].splittable
    rows, whole = bronze.read_group(spark, group), bronze.read_survey_csv(spark, path)
    assert [r[:2] for r in rows.collect()] == [tuple(r) for r in whole.collect()]


def test_looking_at_files_sorts_no_lines(spark, tmp_path, monkeypatch):
    path = _csv(tmp_path / "seen", ["1,2"])
    plans = []
    frame = type(spark.range(0))
    collect = frame.collect
    monkeypatch.setattr(
        frame, "collect",
        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df),
    )
    bronze.inspect_files(spark, {2024: path})
    assert plans and not any("SortAggregate" in p for p in plans)


def test_raw_files_are_written_without_running_the_jobs(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("no job is asked for")

    monkeypatch.setattr(raw_editions, "_done", {})
    monkeypatch.setattr(raw_editions.pipeline, "bronze_to_silver", refuse)
    counted = raw_editions.raw_lines(spark, SMALL).collect()
    assert sum(r["linhas"] for r in counted) == star.table(spark, SMALL, "orders").count()
    assert all(r["linhas"] == r["lugares"] and r["primeira"] == 2 for r in counted)


def test_tasks_are_kept_small_unless_the_caller_says_otherwise(spark):
    from surveyloom.session import SETTINGS, configured

    split, shuffled = (
        "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    )
    spark.conf.unset(split)
    with configured(spark):
        assert (spark.conf.get(split), spark.conf.get(shuffled)) == ("8m", "8m")
        # The tests' own number stays.
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert SETTINGS["spark.sql.shuffle.partitions"] == "600"
    spark.conf.set(shuffled, "1m")
    try:
        with configured(spark):
            assert spark.conf.get(shuffled) == "1m"
    finally:
        spark.conf.unset(shuffled)


def test_editions_in_one_folder_need_no_job_before(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("no job is asked for")

    monkeypatch.setattr(raw_editions, "pipeline_folders", refuse)
    counted = raw_editions.edition_routing(spark, SMALL).collect()
    assert sum(r["respondentes"] for r in counted) == star.table(spark, SMALL, "orders").count()


def test_reload_reads_the_raw_files_only(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("the full pipeline is not asked for")

    loaded = []
    load = raw_editions.pipeline.bronze_to_silver
    monkeypatch.setattr(raw_editions, "_reloaded", {})
    monkeypatch.setattr(raw_editions, "pipeline_folders", refuse)
    monkeypatch.setattr(
        raw_editions.pipeline, "bronze_to_silver",
        lambda spark, paths, *rest: loaded.append(sorted(paths)) or load(spark, paths, *rest),
    )
    years = {r["ano"] for r in raw_editions.reload_gold(spark, SMALL).select("ano").distinct().collect()}
    assert years == {1996, 1997, 1998} and loaded == [[1995, 1996, 1997], [1996], [1998]]


def test_a_report_in_sql_has_only_its_tables_built(spark, monkeypatch):
    from verification import sql_layer

    def refuse(*_):
        raise AssertionError("answers are not asked for")

    monkeypatch.setattr(sql_layer, "_databases", {})
    monkeypatch.setattr(star, "survey_answer_lists", refuse)
    monkeypatch.setattr(star, "survey_answers", refuse)
    reports = {q.__name__: q for q in sql_layer.QUERIES}
    assert reports["sql_region_work_model"](spark, SMALL).count() > 0
    assert reports["sql_mix_by_year"](spark, SMALL).count() > 0


def test_rows_that_occur_once_leave_no_trace_in_the_numbering(spark, tmp_path, monkeypatch):
    stored = {}
    write = bronze.written

    def kept(df, name):
        stored[name] = write(df, name)
        return stored[name]

    monkeypatch.setattr(bronze, "written", kept)
    path = str(tmp_path / "landed")
    spark.range(500).selectExpr("2024 AS ano", "CAST(if(id < 20, 0, id) AS STRING) AS a").write.parquet(path)
    keyed = bronze.with_content_key(spark.read.parquet(path), block=7)
    assert keyed.select("id_respondente").distinct().count() == 500
    assert stored["iguais"].columns == ["ano", "digesto_"] and stored["iguais"].count() == 1
    assert stored["linhas_iguais"].count() == stored["repetidas"].count() == 20
