"""Headers, sources, sinks and the two jobs on small raw files."""

import pytest
from pyspark.sql import functions as F
from survey_files import FLAT_2025, ROWS_2023, ROWS_2025, TUPLE, write_all, write_edition

from surveyloom.operators import headers as hd
from surveyloom.plans import pipeline, reports
from surveyloom.plans.gold import GOLD_ORDER
from surveyloom.sources import bronze, sinks
from surveyloom.sources.mapping import read_mapping

HEADERS = {2023: list(TUPLE.values()), 2025: list(FLAT_2025.values())}


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("survey")
    write_all(base / "bronze")
    return base


@pytest.fixture(scope="module")
def stored(spark, folders):
    paths = {y: bronze.edition_path(str(folders / "bronze"), y) for y in (2023, 2024, 2025)}
    silver, gold = str(folders / "silver"), str(folders / "gold")
    written = pipeline.bronze_to_silver(spark, paths, silver, encoding="auto")
    return {"written": written, "silver": silver, "gold": gold, "paths": paths,
            "gold_rows": pipeline.silver_to_gold(spark, silver, gold)}


def test_header_parsing(spark):
    parsed = hd.parse_headers(hd.header_frame(spark, HEADERS)).collect()
    for row in parsed:
        wanted = TUPLE if row["ano"] == 2023 else FLAT_2025
        assert wanted[row["codigo_questao"]] == row["cabecalho"]
    labels = {r["cabecalho"]: r["rotulo"] for r in parsed}
    assert labels["idade"] == "idade"
    assert labels["4.d_banco_de_dados_(dia_a_dia)"] == "banco_de_dados_(dia_a_dia)"
    assert labels[TUPLE["2.r"]] == "Qual a sua forma de trabalho, 'hoje'?"


def test_first_header_of_a_code_wins(spark):
    found = hd.header_index(hd.header_frame(spark, {2023: ["('P4_h ', 'a')", "4.h_b", "x"]}))
    assert [tuple(r) for r in found.collect()] == [(2023, "4.h", "('P4_h ', 'a')")]


def test_plan_uses_the_codes_of_each_edition(spark):
    mapping = read_mapping(spark)
    wanted = mapping.fields.where("ano IN (2023, 2025)")
    plan = hd.column_plan(hd.header_frame(spark, HEADERS), wanted).collect()
    assert len(plan) == 60
    at = {(r["ano"], r["campo"]): r for r in plan}
    assert at[2023, "forma_trabalho"]["cabecalho"] == TUPLE["2.r"]
    assert at[2025, "forma_trabalho"]["cabecalho"] == "2.q_modelo_de_trabalho_atual"
    assert at[2025, "forma_trabalho_ideal"]["cabecalho"] == "2.r_modelo_de_trabalho_ideal"
    assert at[2025, "banco_dados"]["cabecalho"] == "4.d_banco_de_dados_(dia_a_dia)"
    assert at[2023, "cloud_uso"]["cabecalho"] == TUPLE["4.h"]
    assert at[2025, "linguagem_uso"]["situacao"] == "nao_aplicavel"
    assert at[2023, "ferramenta_bi"]["situacao"] == "faltando"


def test_full_mapping_resolves_every_asked_field(spark):
    mapping = read_mapping(spark)
    codes = {y: [r["codigo"] for r in mapping.fields.where(F.col("ano") == y).collect()
                 if r["codigo"]] for y in mapping.editions}
    found = hd.header_frame(spark, {y: [f"{c}_x" for c in cs] for y, cs in codes.items()})
    report = hd.plan_report(found, hd.column_plan(found, mapping.fields)).orderBy("ano").collect()
    assert [(r["resolvidos"], r["faltando"], r["nao_aplicavel"]) for r in report] == [
        (30, 0, 0), (30, 0, 0), (29, 0, 1)]


def test_missing_critical_field_stops_the_job(spark):
    mapping = read_mapping(spark)
    found = hd.header_frame(spark, {2025: [h for h in FLAT_2025.values() if "faixa" not in h]})
    plan = hd.column_plan(found, mapping.fields.where("ano = 2025"))
    with pytest.raises(hd.CriticalFieldMissing, match="2025: campos.faixa_salarial"):
        hd.require_critical(plan, mapping.critical)


def test_sources(spark, stored, folders):
    assert list(bronze.detect_encodings(spark, stored["paths"][2024])) == ["ISO-8859-1"]
    assert list(bronze.detect_encodings(spark, stored["paths"][2023])) == ["UTF-8"]
    raw = bronze.read_survey_csv(spark, stored["paths"][2023])
    assert raw.columns == list(TUPLE.values()) and raw.count() == 3
    found = bronze.locate_edition(spark, str(folders / "bronze" / "edicao_2024"), 2024)
    assert found.endswith("pesquisa_2024_0.csv")
    lines = bronze.read_raw_lines(spark, stored["paths"][2025])
    assert lines.columns == ["arquivo", "linha", "linha_bruta"] and lines.count() == 1


def test_silver_tables(spark, stored):
    assert stored["written"] == {"respondentes": 5, "tecnologias": 12}
    people = sinks.read_table(spark, f"{stored['silver']}/respondentes")
    assert dict(people.dtypes)["ano"] == "int" and dict(people.dtypes)["idade"] == "int"
    by_age = {r["idade"]: r for r in people.collect()}
    first = by_age[34]
    assert (first["ano"], first["senioridade"], first["forma_trabalho"]) == (2023, "Senior", "Remoto")
    assert (first["salario_mensal_estimado"], first["usa_ia"], first["tipo_uso_ia"]) == (
        10000.5, 1, "Paga")
    boss = by_age[None]
    assert (boss["senioridade"], boss["regiao"], boss["cargo"]) == ("Gestao", "Nordeste", None)
    assert (boss["faixa_superior"], boss["forma_trabalho"]) == (None, "Hibrido")
    latin = by_age[28]
    assert (latin["senioridade"], latin["satisfacao_empresa"], latin["usa_ia"]) == ("Junior", 1, None)
    last = by_age[51]
    assert (last["regiao"], last["forma_trabalho_ideal"]) == ("Nao informado", "Hibrido")
    assert (last["faixa_inferior"], last["faixa_superior"]) == (25001.0, None)


def test_keys_are_unique_and_shared(spark, stored):
    people = sinks.read_table(spark, f"{stored['silver']}/respondentes")
    items = sinks.read_table(spark, f"{stored['silver']}/tecnologias")
    assert people.select("id_respondente").distinct().count() == 5
    assert items.join(people, ["ano", "id_respondente"], "left_anti").count() == 0
    tools = {r["tecnologia"] for r in items.where("categoria = 'cloud_uso'").collect()}
    assert "Google Cloud (GCP, Firebase)" in tools and len(tools) == 3


def test_gold_tables(spark, stored):
    assert set(stored["gold_rows"]) == {
        "perfil_mercado", "remuneracao", "diversidade", "tecnologias", "adocao_ia", "impacto_ia",
        "modelo_trabalho"}
    for name, count in stored["gold_rows"].items():
        assert sinks.read_table(spark, f"{stored['gold']}/{name}").count() == count > 0
    pay = sinks.read_table(spark, f"{stored['gold']}/remuneracao")
    row = pay.where("recorte = 'cargo' AND dimensao_1 IS NULL").first()
    assert (row["respondentes"], row["salario_mediano_interpolado"]) == (2, 40001.0)


def test_one_edition_can_be_loaded_again(spark, stored, tmp_path):
    table = str(tmp_path / "t")
    people = sinks.read_table(spark, f"{stored['silver']}/respondentes")
    assert sinks.write_table(people, table) == 5
    assert sinks.write_table(people.where("ano = 2025").withColumn("cargo", F.lit("novo")), table) == 1
    again = sinks.read_table(spark, table)
    assert again.count() == 5 and again.where("cargo = 'novo'").count() == 1


def test_latest_edition_prunes_partitions(spark, stored):
    profile = sinks.read_table(spark, f"{stored['gold']}/perfil_mercado")
    plan = reports.top_roles(profile)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan.replace("\n", " ")
    assert [r["cargo"] for r in reports.top_roles(profile).collect()] == ["Eng"]


def test_exports_views_and_catalog(spark, stored, tmp_path):
    profile = sinks.read_table(spark, f"{stored['gold']}/perfil_mercado")
    target = tmp_path / "csv"
    sinks.export_csv(profile, str(target), order=GOLD_ORDER["perfil_mercado"])
    assert len(list(target.glob("*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(target)).count() == profile.count()

    inventory = tmp_path / "inventory"
    sinks.export_csv(hd.header_inventory(hd.header_frame(spark, HEADERS)), str(inventory), ";")
    rows = spark.read.option("header", True).option("sep", ";").csv(str(inventory))
    assert rows.columns == ["ano", "codigo_questao", "rotulo", "cabecalho_original"]
    assert rows.count() == len(TUPLE) + len(FLAT_2025)

    people = sinks.read_table(spark, f"{stored['silver']}/respondentes")
    items = sinks.read_table(spark, f"{stored['silver']}/tecnologias")
    sinks.register_views(spark, {"respondentes": people, "tecnologias": items},
                         {"perfil_mercado": profile}, plain_gold_names=True)
    sql = """SELECT cargo, SUM(CAST(respondentes AS BIGINT)) AS respondentes FROM perfil_mercado
      WHERE CAST(ano AS INTEGER) = (SELECT MAX(CAST(ano AS INTEGER)) FROM perfil_mercado)
      AND cargo IS NOT NULL GROUP BY cargo ORDER BY respondentes DESC LIMIT 15"""
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("Eng", 1)]
    assert spark.table("silver_tecnologias").count() == 12

    sinks.publish(spark, "pesquisa", "gold_perfil_mercado", profile,
                  f"{stored['gold']}/perfil_mercado")
    assert spark.table("pesquisa.gold_perfil_mercado").count() == profile.count()
    assert len(spark.sql("SHOW PARTITIONS pesquisa.gold_perfil_mercado").collect()) == 3


def test_export_keeps_the_order_of_a_sorted_frame(spark, tmp_path):
    many = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("n")).repartition(8)
    sinks.export_csv(many, str(tmp_path / "n"), order=["-n"])
    files = sorted((tmp_path / "n").glob("*.csv"))
    found = [int(x) for f in files for x in f.read_text().split()[1:]]
    assert found == sorted(found, reverse=True) and len(found) == 20_000


def test_all_tables_are_exported_and_published_in_one_call(spark, stored, tmp_path):
    tables = {name: sinks.read_table(spark, f"{stored['gold']}/{name}") for name in GOLD_ORDER}
    sinks.export_all(tables, str(tmp_path), GOLD_ORDER)
    sinks.publish_all(spark, "tudo", tables, stored["gold"], "gold_")
    for name, table in tables.items():
        back = spark.read.option("header", True).csv(str(tmp_path / name))
        assert back.count() == table.count() == spark.table(f"tudo.gold_{name}").count()


def test_files_with_other_columns_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        bronze.read_survey_csv(spark, str(tmp_path)).collect()


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("x\nSão\n".encode())
    (tmp_path / "b.csv").write_bytes("x\nJosé\n".encode("latin-1"))
    found = bronze.read_survey_csv_any(spark, str(tmp_path)).collect()
    assert sorted(r["x"] for r in found) == ["José", "São"]


def test_nothing_asked_leaves_an_empty_table(spark, folders, tmp_path):
    headers = {k: v for k, v in TUPLE.items() if not k.startswith(("4.d", "4.h"))}
    write_edition(tmp_path / "e", "p_2023", headers, ROWS_2023)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    written = pipeline.bronze_to_silver(spark, {2023: str(tmp_path / "e")}, silver)
    assert written == {"respondentes": 3, "tecnologias": 0}
    assert pipeline.silver_to_gold(spark, silver, gold)["tecnologias"] == 0


def test_lines_are_numbered_by_their_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 3 + "x,y\n")
    (tmp_path / "b.csv").write_text("".join(f"{n:06d}\n" for n in range(5000)))
    (tmp_path / "c.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = bronze.number_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {}
    for r in found:
        by_file.setdefault(r["arquivo"][-5:], {})[r["linha"]] = r["linha_bruta"]
    assert by_file["a.csv"] == {1: "x,y", 2: "1,2", 3: "1,2", 4: "1,2", 5: "x,y"}
    assert by_file["b.csv"] == {n + 1: f"{n:06d}" for n in range(5000)}
    # A data line that reads like the header stays; the header of every file goes.
    lines = bronze.read_raw_lines(spark, str(tmp_path)).collect()
    assert len(lines) == 4 + 4999
    assert sum(r["linha_bruta"] == "x,y" for r in lines) == 1


def _keyed(spark, folder, rows, files):
    write_edition(folder, "p_2023", TUPLE, rows, files=files)
    landed = pipeline.land_editions(spark, {2023: str(folder)}, read_mapping(spark))
    return [r for part in landed for r in part.rows.collect()]


def test_keys_survive_a_second_landing(spark, tmp_path):
    rows = [ROWS_2023[0] | {"1.a": str(n % 7)} for n in range(40)] + ROWS_2023[1:] * 9
    first = _keyed(spark, tmp_path / "one", rows, 1)
    second = _keyed(spark, tmp_path / "many", rows[::-1], 5)
    assert len({r["id_respondente"] for r in first}) == len(first) == 58
    assert sorted(map(str, first)) == sorted(map(str, second))
    # Another answer changes the key of its own row alone.
    third = _keyed(spark, tmp_path / "more", rows + [ROWS_2023[0] | {"1.a": "99"}], 3)
    new = {r["id_respondente"] for r in third} - {r["id_respondente"] for r in first}
    assert len(new) == 1 and len(third) == 59


def test_equal_rows_are_numbered_through_blocks_and_files(spark, tmp_path):
    same = spark.range(1000).select(F.lit(2023).alias("ano"), F.lit("sim").alias("resposta"))
    other = spark.range(10).select(F.lit(2023).alias("ano"), F.col("id").cast("string").alias("resposta"))
    same.repartition(7).unionByName(other).write.parquet(str(tmp_path / "t"))
    landed = spark.read.parquet(str(tmp_path / "t"))
    keys = [r["id_respondente"] for r in bronze.with_content_key(landed, block=30).collect()]
    assert len(set(keys)) == 1010
    hot = [k for k in keys if k[:37] == max(keys, key=[k[:37] for k in keys].count)[:37]]
    assert sorted(int(k.rsplit("-", 1)[1]) for k in hot) == list(range(1, 1001))


def test_one_job_lands_all_editions_of_a_header(spark, tmp_path):
    for year in (2024, 2026, 2027):
        write_edition(tmp_path / f"e{year}", f"p_{year}", FLAT_2025, ROWS_2025, files=2)
    write_edition(tmp_path / "e2023", "p_2023", TUPLE, ROWS_2023)
    write_edition(tmp_path / "e2027", "q 2027", FLAT_2025, ROWS_2025, "latin-1")
    paths = {y: str(tmp_path / f"e{y}") for y in (2023, 2024, 2026, 2027)}
    groups = bronze.group_files(spark, paths)
    found = sorted((g.encoding, g.editions) for g in groups)
    assert found == [("ISO-8859-1", [2027]), ("UTF-8", [2023]), ("UTF-8", [2024, 2026, 2027])]
    one = next(g for g in groups if len(g.editions) == 3)
    counted = bronze.read_group(spark, one).groupBy(bronze.EDITION).count().collect()
    assert {r[0]: r[1] for r in counted} == {2024: 1, 2026: 1, 2027: 1}


def test_files_are_found_by_the_year_in_their_names(spark, tmp_path):
    for name in ("p_2023.csv", "p 2024 b.csv", "p_2024_a.csv", "v12023.csv", "notas.csv", "p_2025.txt"):
        (tmp_path / name).write_text("x\n1\n")
    found = bronze.editions_by_name(spark, str(tmp_path))
    assert {y: [f.rsplit("/", 1)[1] for f in fs] for y, fs in found.items()} == {
        2023: ["p_2023.csv"], 2024: ["p 2024 b.csv", "p_2024_a.csv"]}
    assert bronze.locate_edition(spark, str(tmp_path), 2023).endswith("p_2023.csv")
    assert bronze.locate_edition(spark, str(tmp_path), 2020) is None


def test_reload_replaces_drops_and_adds_editions(spark, folders, tmp_path):
    base = folders / "bronze"
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    paths = {y: bronze.edition_path(str(base), y) for y in (2023, 2024)}
    pipeline.bronze_to_silver(spark, paths, silver, encoding="auto")
    pipeline.silver_to_gold(spark, silver, gold)
    people = sinks.read_table(spark, f"{silver}/respondentes")
    sinks.publish(spark, "recarga", "respondentes", people, f"{silver}/respondentes")
    before = {r["id_respondente"] for r in people.where("ano = 2023").collect()}

    write_edition(tmp_path / "novo", "p_2023", TUPLE, ROWS_2023[:2])
    pipeline.bronze_to_silver(spark, {2023: str(tmp_path / "novo")}, silver)
    pipeline.silver_to_gold(spark, silver, gold, years=[2023])
    late = {2025: bronze.edition_path(str(base), 2025)}
    pipeline.bronze_to_silver(spark, late, silver)
    pipeline.silver_to_gold(spark, silver, gold, years=[2025])
    pipeline.drop_editions(spark, [2024], silver, gold)
    sinks.register_partitions(spark, "recarga.respondentes")
    now = spark.table("recarga.respondentes")
    assert {r["ano"]: r["count"] for r in now.groupBy("ano").count().collect()} == {2023: 2, 2025: 1}
    assert {r["id_respondente"] for r in now.where("ano = 2023").collect()} < before
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS recarga.respondentes").collect()]
    assert sorted(parts) == ["ano=2023", "ano=2025"]
    profile = sinks.read_table(spark, f"{gold}/perfil_mercado")
    assert {r["ano"] for r in profile.collect()} == {2023, 2025}
    assert not [n for n in (tmp_path / "silver" / "respondentes").iterdir() if n.name.startswith("_preparo")]


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(4).select((F.col("id") % 2 + 2023).cast("int").alias("ano"), "id")
    assert sinks.replace_editions(frame, path, [2023, 2024]) == 4
    with pytest.raises(ValueError, match="expected only"):
        sinks.replace_editions(frame, path, [2023])
    broken = frame.withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_editions(broken, path, [2023, 2024])
    assert sinks.read_table(spark, path).count() == 4
    # Rows read from the table itself; an edition that has none left goes.
    kept = sinks.read_table(spark, path).where("ano = 2023 AND id = 0").select("ano", "id")
    assert sinks.replace_editions(kept, path, [2023, 2024]) == 1
    assert sinks.editions_in(spark, path) == [2023]
    assert [tuple(r) for r in sinks.read_table(spark, path).select("ano", "id").collect()] == [(2023, 0)]


def test_jobs_leave_the_session_as_it_was(spark, stored):
    from surveyloom.session import SETTINGS, configured

    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "1234")
    try:
        with configured(spark):
            assert spark.conf.get(name) == "1234"
        assert spark.conf.get(name) == "1234"
    finally:
        spark.conf.unset(name)
    with configured(spark):
        assert spark.conf.get(name) == SETTINGS[name]
    assert spark.conf.get(name, None) is None


class _Elsewhere:
    """A session on a cluster, as far as the choice of a folder looks."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}
        self.sparkContext = type("Context", (), {"master": "spark://host:7077"})


def test_local_disks_are_refused_on_a_cluster():
    from surveyloom.sources.workspace import shared_folder

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Elsewhere(spark_sql_warehouse_dir="file:/tmp/warehouse"))
    assert shared_folder(_Elsewhere(spark_sql_warehouse_dir="hdfs://n/w")) == "hdfs://n/w/_intermediate"
    shared = _Elsewhere(spark_checkpoint_dir="hdfs://n/c/", spark_sql_warehouse_dir="file:/tmp/w")
    assert shared_folder(shared) == "hdfs://n/c"
