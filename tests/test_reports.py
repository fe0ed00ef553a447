"""Reports on small gold tables with published figures of one edition."""

import pytest

from surveyloom.plans import chart_frames, reports


@pytest.fixture(scope="module")
def diversity(spark):
    rows = [
        (2024, "Masculino", "Senior", 1, 1.0), (2024, "Feminino", "Senior", 1, 2.0),
        (2025, "Masculino", "Senior", 10, 12865.30), (2025, "Feminino", "Senior", 5, 11164.39),
        (2025, "Masculino", "Junior", 10, 3652.89), (2025, "Feminino", "Junior", 4, 3223.00),
        (2025, "Masculino", "Pleno", 10, 7483.02), (2025, "Feminino", "Pleno", 6, 7592.04),
        (2025, "Outro", "Pleno", 3, 9.0), (2025, "Masculino", "Gestao", 7, 18674.75),
    ]
    return spark.createDataFrame(
        rows, "ano int, genero string, senioridade string, respondentes bigint, "
        "salario_mediano_interpolado double",
    )


@pytest.fixture(scope="module")
def work(spark):
    rows = [
        (2025, "Norte", "Remoto", 21, 43.75, 14000.5),
        (2025, "Norte", "Presencial", 10, 20.83, 3000.0),
        (2025, "Norte", "Hibrido", 5, 10.42, 13000.75),
        (2025, "Norte", "Nao informado", 12, 25.0, None),
        (2024, "Sul", "Remoto", 3, 100.0, 1.0),
    ]
    return spark.createDataFrame(
        rows, "ano int, regiao string, forma_trabalho string, respondentes bigint, "
        "percentual double, salario_mediano_interpolado double",
    )


def test_pay_gap_of_the_latest_edition(diversity):
    gaps = [(r["senioridade"], r["diferenca_pct"]) for r in reports.pay_gap(diversity).collect()]
    # Management has no women here and drops out.
    assert gaps == [("Senior", -13.2), ("Junior", -11.8), ("Pleno", 1.5)]
    bars = chart_frames.pay_gap_bars(diversity).collect()
    assert [r["senioridade"] for r in bars] == ["Junior", "Pleno", "Senior"]


def test_female_share_over_all_editions(diversity):
    shares = {r["senioridade"]: tuple(r)[1:] for r in reports.female_share(diversity).collect()}
    assert shares["Senior"] == (6, 11, 35.3) and shares["Gestao"] == (0, 7, 0.0)


def test_gender_mix_fills_missing_cells(diversity):
    rows = {r["ano"]: r.asDict() for r in chart_frames.gender_mix(diversity).collect()}
    assert rows[2024] == {"ano": 2024, "Feminino": 50.0, "Masculino": 50.0,
                          "Nao informado": 0.0, "Outro": 0.0}


def test_work_model_by_region(work):
    rows = [tuple(r)[1:] for r in reports.region_work_model(work).collect()]
    assert rows == [("Norte", "Remoto", 21, 43.75, 14000.5), ("Norte", "Presencial", 10, 20.83, 3000.0),
                    ("Norte", "Hibrido", 5, 10.42, 13000.75)]
    mix = chart_frames.work_model_mix(work).first().asDict()
    assert mix == {"regiao": "Norte", "Hibrido": 13.89, "Presencial": 27.78, "Remoto": 58.33,
                   "Outro": 0.0}
