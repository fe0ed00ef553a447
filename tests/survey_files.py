"""Three small raw editions, one per header format and numbering."""

import csv

TUPLE = {
    "0": "('P0', 'id')", "1.a": "('P1_a ', 'Idade')", "1.b": "('P1_b ', 'Genero')",
    "1.i.1": "('P1_i_1 ', 'uf onde mora')", "1.i.2": "('P1_i_2 ', 'Regiao onde mora')",
    "2.d": "('P2_d ', 'Gestor?')", "2.f": "('P2_f ', 'Cargo Atual')",
    "2.g": "('P2_g ', 'Nivel')", "2.h": "('P2_h ', 'Faixa salarial')",
    "2.k": "('P2_k ', 'Você está satisfeito?')",
    "2.r": "('P2_r ', \"Qual a sua forma de trabalho, 'hoje'?\")",
    "4.d": "('P4_d ', 'Quais linguagens?')", "4.d.15": "('P4_d_15 ', 'Não utilizo')",
    "4.h": "('P4_h ', 'Qual sua Cloud?')", "4.h.7": "('P4_h_7 ', 'Cloud Própria')",
    "4.m": "('P4_m ', 'Utiliza LLMs no trabalho?')",
}
FLAT_2024 = {
    "0.a": "0.a_token", "1.a": "1.a_idade", "1.b": "1.b_genero", "1.i.1": "1.i.1_uf_onde_mora",
    "1.i.2": "1.i.2_regiao_onde_mora", "2.d": "2.d_gestor", "2.f": "2.f_cargo_atual",
    "2.g": "2.g_nivel", "2.h": "2.h_faixa_salarial", "2.k": "2.k_satisfeito",
    "2.r": "2.r_forma_de_trabalho", "4.d": "4.d_linguagens_(dia_a_dia)",
    "4.h": "4.h_cloud_(dia_a_dia)", "4.m": "4.m_usa_llm",
}
FLAT_2025 = {
    "0.a": "0.a_token", "1.a": "1.a_idade", "1.b": "1.b_genero", "1.i.1": "1.i.1_uf_onde_mora",
    "1.i.2": "1.i.2_regiao_onde_mora", "2.d": "2.d_gestor", "2.f": "2.f_cargo_atual",
    "2.g": "2.g_nivel", "2.h": "2.h_faixa_salarial", "2.k": "2.k_satisfeito",
    "2.q": "2.q_modelo_de_trabalho_atual", "2.r": "2.r_modelo_de_trabalho_ideal",
    "3.f.8": "3.f.8 Não sei opinar", "4.d": "4.d_banco_de_dados_(dia_a_dia)",
    "4.e": "4.e_cloud_(dia_a_dia)", "4.j": "4.j_usa_llm_no_trabalho?", "": "idade",
}

CLOUDS = "Azure (Microsoft), Amazon Web Services (AWS), Google Cloud (GCP, Firebase)"
NONE = "Não utilizo nenhum tipo de solução, por ora"
PAID = "Utilizo soluções pagas (planos), sempre"

ROWS_2023 = [
    {"0": "a", "1.a": "34", "1.b": "Masculino", "1.i.1": "SP", "1.i.2": "Sudeste", "2.d": "0",
     "2.f": "Analista", "2.g": "Sênior", "2.h": "de R$ 8.001/mês a R$ 12.000/mês", "2.k": "1",
     "2.r": "Modelo 100% remoto", "4.d": "SQL, Python, SAS/Stata", "4.h": CLOUDS, "4.m": PAID},
    {"0": "b", "1.a": "n/d", "1.b": "Feminino", "1.i.1": "BA", "1.i.2": "", "2.d": "1", "2.f": "",
     "2.g": "", "2.h": "Acima de R$ 40.001/mês", "2.k": "0",
     "2.r": "Modelo híbrido\ncom \"dias\" fixos", "4.d": "", "4.h": "Azure (Microsoft)",
     "4.m": NONE},
    # The copy of a row is another respondent.
    {"0": "b", "1.a": "n/d", "1.b": "Feminino", "1.i.1": "BA", "1.i.2": "", "2.d": "1", "2.f": "",
     "2.g": "", "2.h": "Acima de R$ 40.001/mês", "2.k": "0",
     "2.r": "Modelo híbrido\ncom \"dias\" fixos", "4.d": "", "4.h": "Azure (Microsoft)",
     "4.m": NONE},
]
ROWS_2024 = [
    {"0.a": "c", "1.a": "28.0", "1.b": "Prefiro não informar", "1.i.1": "RS", "1.i.2": "Sul",
     "2.d": "FALSE", "2.f": "Cientista", "2.g": "Júnior", "2.h": "Menos de R$ 1.000/mês",
     "2.k": "TRUE", "2.r": "Modelo 100% presencial", "4.d": "R", "4.h": "", "4.m": ""},
]
ROWS_2025 = [
    {"0.a": "d", "1.a": "51", "1.b": "Outro", "1.i.1": "", "1.i.2": "", "2.d": "0", "2.f": "Eng",
     "2.g": "Especialista/Staff+", "2.h": "de R$ 25.001/mês a R$ 3000/mês", "2.k": "1",
     "2.q": "Modelo 100% remoto", "2.r": "Modelo híbrido flexível", "4.d": "Oracle, MySQL",
     "4.e": "Azure (Microsoft)", "4.j": NONE},
]


def write_edition(folder, name, headers, rows, encoding="utf-8", files=1):
    folder.mkdir(parents=True, exist_ok=True)
    for part in range(files):
        with (folder / f"{name}_{part}.csv").open("w", encoding=encoding, newline="") as out:
            writer = csv.writer(out)
            writer.writerow(headers.values())
            for row in rows[part::files]:
                writer.writerow([row.get(code, "") for code in headers])


def write_all(base):
    write_edition(base / "edicao_2023", "pesquisa_2023", TUPLE, ROWS_2023, "utf-8-sig", files=2)
    write_edition(base / "edicao_2024", "pesquisa_2024", FLAT_2024, ROWS_2024, "latin-1")
    write_edition(base / "edicao_2025", "pesquisa_2025", FLAT_2025, ROWS_2025)
