"""Small input files in the layouts of the complaint data set, and what they must give."""

from __future__ import annotations

import random
import re
from pathlib import Path

from lavra.plans import contract

COMPLAINT_HEADER = (
    "Ano;Trimestre;Categoria;Tipo;CNPJ IF;Instituição financeira;Índice;"
    "Reguladas procedentes;Reguladas outras;Não reguladas;Total reclamações;"
    "Total clientes;Clientes CCS;Clientes SCR;"
)

# tax id, institution, index text, index value
COMPLAINTS = [
    ("12.345", "BANCO UM", "16.699,13", 16699.13),
    ("222", "BANCO DOIS", "54,79", 54.79),
    ("333", "BANCO TRÊS", "0", 0.0),
    ("123456789", "BANCO LONGO", "12.5", 12.5),
    ("0", "BANCO ZERO", "", None),
    ("999", "BANCO AUSENTE", "   ", None),
    ("", "Açúcar S.A. (Conglomerado)", "1,5", 1.5),
    ("  ", " Grupo \x96 Norte (Conglomerado) ", "2", 2.0),
    ("", "Sem Avaliação (Conglomerado)", "3", 3.0),
    ("", "---", "4", 4.0),
]

# segment, tax id, name
SEGMENTS = [
    ("S1", "12345", "UM S.A. PRUDENCIAL"),
    (" S1 ", "12345", "UM S.A."),
    ("S2", "222", "DOIS - Prudencial"),
    ("S3", "333", ""),
    ("S3", "333", "TRES S.A."),
    ("S4", "0", "RESERVADO"),
    ("S4", "123456789", "LONGO"),
    ("S5", "777", "SOBRA CR�DITO"),
    ("", "abc", "SEM ID"),
]

# employer, reviews, segment, name, match
REVIEWS = [
    ("Açúcar Ltda", "608", "S2", "ACUCAR S.A.", "100"),
    ("Açúcar Holding", "1400", "S2", "Açúcar S.A.", "100"),
    ("Norte Velho", "9000", "S3", "GRUPO NORTE", "75"),
    ("Norte Novo", "10", "S3", "GRUPO NORTE", "88"),
    ("Outro", "", "S1", "OUTRO", ""),
]
LESS = [("Menor", "5", "12.345/0", "MENOR", "70")]


def write_inputs(folder: Path) -> dict[str, int]:
    """Write all ten files; returns the rows of each."""
    folder.mkdir(parents=True, exist_ok=True)
    counts = {}
    for position, spec in enumerate(contract.COMPLAINT_SOURCES):
        year, _, quarter = spec.target.split("_")
        lines = [COMPLAINT_HEADER]
        picked = COMPLAINTS if position == 0 else COMPLAINTS[position - 1 :: 3]
        for tax_id, name, index, _ in picked:
            lines.append(
                f" {year};{int(quarter)}º;Top 10;Banco;{tax_id};{name};{index};1;2;3;6;70;40;30;"
            )
        (folder / spec.file).write_bytes("\r\n".join(lines).encode("latin-1") + b"\r\n")
        counts[spec.file] = len(picked)
    rows = ["\t".join(["Segmento", "CNPJ", "Nome"]), *["\t".join(r) for r in SEGMENTS]]
    (folder / contract.SEGMENT_SOURCE.file).write_text("\n".join(rows) + "\n", "utf-8")
    counts[contract.SEGMENT_SOURCE.file] = len(SEGMENTS)
    for spec, last, values in (
        (contract.REVIEW_SOURCE, "Segmento", REVIEWS),
        (contract.REVIEW_LESS_SOURCE, "CNPJ", LESS),
    ):
        headers = [*[f"campo-{i} ção" for i in range(20)], last, "Nome", "match_percent"]
        lines = ["|".join(headers)]
        for employer, reviews, place, name, match in values:
            scores = ["3.2"] * 9
            head = [employer, reviews, "7", "8", "9", "http://x", "São Paulo", "2003.0", "ind"]
            lines.append("|".join([*head, "", "url", *scores, place, name, match]))
        (folder / spec.file).write_text("\n".join(lines) + "\n", "utf-8")
        counts[spec.file] = len(values)
    return counts


def width_key(text: str | None) -> str | None:
    digits = re.sub("[^0-9]", "", text or "")
    return digits.rjust(8, "0") if 1 <= len(digits) <= 8 else None


def expected_delivery(complaints: list[dict], segments: list[dict], reviews: list[dict]) -> list:
    """The delivery worked out row by row in plain Python (only some of its columns)."""
    from lavra.functions.text import ACCENTED, UNACCENTED

    def name_key(text):
        if text is None:
            return None
        name = re.sub(r"\s*\(CONGLOMERADO\)\s*$", "", text.strip(" ").upper())
        name = name.translate(str.maketrans(ACCENTED, UNACCENTED))
        return re.sub("[^A-Z0-9]+", " ", name).strip(" ")

    def nulls_first(value):
        return (value is not None, value if value is not None else "")

    def nulls_last_desc(value):
        return (value is None, -(value or 0))

    by_id: dict[str, dict] = {}
    for row in segments:
        key = width_key(row["cnpj"])
        if key in (None, "00000000"):
            continue
        marked = "PRUDENCIAL" in (row["nome"] or "").upper()
        rank = (
            2 if marked else 1,
            nulls_first(row["nome"]),
            nulls_first(row["segmento"]),
            nulls_first(row["cnpj"]),
        )
        if key not in by_id or rank < by_id[key]["rank"]:
            by_id[key] = {**row, "rank": rank}
    by_name: dict[str, dict] = {}
    for row in reviews:
        key = name_key(row["nome"])
        rank = (
            nulls_last_desc(row["match_percent"]),
            nulls_last_desc(row["reviews_count"]),
            nulls_first(row["employer_name"]),
        )
        if key is not None and (key not in by_name or rank < by_name[key]["rank"]):
            by_name[key] = {**row, "rank": rank}
    result = []
    for row in complaints:
        if row["cnpj_if"] is not None:
            key = width_key(row["cnpj_if"])
            hit = by_id.get(key) or {"nome": None, "segmento": None}
            found = hit["nome"] is not None
            outcome = (found, False, contract.TAX_ID_METHOD, None)
        else:
            key = name_key(row["instituicao_financeira"])
            hit = by_name.get(key) or {"nome": None, "segmento": None, "employer_name": None}
            found = hit["employer_name"] is not None
            outcome = (False, found, contract.NAME_METHOD, hit["employer_name"])
        result.append(
            (row["instituicao_financeira"], key, hit["segmento"], hit["nome"], *outcome)
        )
    return result


def random_tables(seed: int, size: int) -> tuple[list[dict], list[dict], list[dict]]:
    """Complaints, segments and reviews with many equal keys, NULLs and odd names."""
    pick = random.Random(seed)
    names = ["Açaí (Conglomerado)", "ACAI", "Banco – X", "banco x", "---", "Ñu", None, "B2 ", "ç"]
    ids = ["1", "01", "2.2", "22", "333", "0", "123456789", "", None, "77"]
    complaints = [
        {"cnpj_if": pick.choice(ids[:7] + [None] * 4), "instituicao_financeira": pick.choice(names)}
        for _ in range(size)
    ]
    segments = [
        {
            "segmento": pick.choice(["S1", "S2", None]),
            "cnpj": pick.choice(ids),
            "nome": pick.choice(["N1", "N2 prudencial", "N0", None, "PRUDENCIAL"]),
        }
        for _ in range(size // 3)
    ]
    reviews = [
        {
            "segmento": pick.choice(["S1", "S2"]),
            "nome": pick.choice(names[:-2]),
            "employer_name": f"E{i}",
            "reviews_count": pick.choice([None, 1, 2, 3]),
            "match_percent": pick.choice([None, 70.0, 100.0]),
        }
        for i in range(size // 3)
    ]
    return complaints, segments, reviews
