"""Fixed values of the complaint data set: sources, column names, labels, totals.

They are part of the results (stored column names, labels, provenance) or state
what the original files hold, and are therefore kept as they are.
"""

from __future__ import annotations

from lavra.sources.files import SourceSpec

# Sources in the order they are ingested, with the rows of the original files.
COMPLAINT_SOURCES = [
    SourceSpec("2021_tri_01.csv", "reclamacoes", "2021_tri_01", ";", "ISO-8859-1", 105),
    SourceSpec("2021_tri_02.csv", "reclamacoes", "2021_tri_02", ";", "ISO-8859-1", 111),
    SourceSpec("2021_tri_03.csv", "reclamacoes", "2021_tri_03", ";", "ISO-8859-1", 113),
    SourceSpec("2021_tri_04.csv", "reclamacoes", "2021_tri_04", ";", "ISO-8859-1", 135),
    SourceSpec("2022_tri_01.csv", "reclamacoes", "2022_tri_01", ";", "ISO-8859-1", 137),
    SourceSpec("2022_tri_03.csv", "reclamacoes", "2022_tri_03", ";", "ISO-8859-1", 163),
    SourceSpec("2022_tri_04.csv", "reclamacoes", "2022_tri_04", ";", "ISO-8859-1", 154),
]
SEGMENT_SOURCE = SourceSpec(
    "EnquadramentoInicia_v2.tsv", "enquadramento", "enquadramento_inicial", "\t", "UTF-8", 1474
)
REVIEW_LESS_SOURCE = SourceSpec(
    "glassdoor_consolidado_join_match_less_v2.csv", "glassdoor", "match_less", "|", "UTF-8", 5
)
REVIEW_SOURCE = SourceSpec(
    "glassdoor_consolidado_join_match_v2.csv", "glassdoor", "match", "|", "UTF-8", 34
)
SOURCES = [*COMPLAINT_SOURCES, SEGMENT_SOURCE, REVIEW_LESS_SOURCE, REVIEW_SOURCE]

# The column a trailing separator makes; raw complaints keep it, trusted ones do not.
TRAILING_COLUMN = "_c14"

COMPLAINT_COUNTS = [
    "qtd_reclamacoes_reguladas_procedentes",
    "qtd_reclamacoes_reguladas_outras",
    "qtd_reclamacoes_nao_reguladas",
    "qtd_total_reclamacoes",
    "qtd_total_clientes_ccs_scr",
    "qtd_clientes_ccs",
    "qtd_clientes_scr",
]
COMPLAINT_COLUMNS = [
    "ano",
    "trimestre",
    "categoria",
    "tipo",
    "cnpj_if",
    "instituicao_financeira",
    "indice",
    *COMPLAINT_COUNTS,
    TRAILING_COLUMN,
]
SOURCE_COLUMN = "arquivo_origem"
COMPLAINT_YEARS = [2021, 2022]
QUARTERS = [1, 2, 3, 4]

SEGMENT_COLUMNS = ["segmento", "cnpj", "nome"]

REVIEW_COMMON_COLUMNS = [
    "employer_name",
    "reviews_count",
    "culture_count",
    "salaries_count",
    "benefits_count",
    "employer_website",
    "employer_headquarters",
    "employer_founded",
    "employer_industry",
    "employer_revenue",
    "url",
    "geral",
    "cultura_valores",
    "diversidade_inclusao",
    "qualidade_vida",
    "alta_lideranca",
    "remuneracao_beneficios",
    "oportunidades_carreira",
    "recomendam_percentual",
    "perspectiva_positiva_percentual",
]
REVIEW_COLUMNS = [*REVIEW_COMMON_COLUMNS, "segmento", "nome", "match_percent"]
REVIEW_LESS_COLUMNS = [*REVIEW_COMMON_COLUMNS, "cnpj", "nome", "match_percent"]
REVIEW_TYPES = {
    "long": ["reviews_count", "culture_count", "salaries_count", "benefits_count"],
    "double": [
        "employer_founded",
        "geral",
        "cultura_valores",
        "diversidade_inclusao",
        "qualidade_vida",
        "alta_lideranca",
        "remuneracao_beneficios",
        "oportunidades_carreira",
        "recomendam_percentual",
        "perspectiva_positiva_percentual",
        "match_percent",
    ],
}

# Delivery columns taken from the two references, and their names there.
SEGMENT_ENRICHMENT = {"segmento": "segmento_enquadramento", "nome": "nome_enquadramento"}
REVIEW_ENRICHMENT = {
    "segmento": "segmento_glassdoor",
    "nome": "nome_glassdoor",
    "employer_name": "glassdoor_employer_name",
    "reviews_count": "glassdoor_reviews_count",
    "culture_count": "glassdoor_culture_count",
    "salaries_count": "glassdoor_salaries_count",
    "benefits_count": "glassdoor_benefits_count",
    "employer_website": "glassdoor_website",
    "employer_headquarters": "glassdoor_headquarters",
    "employer_founded": "glassdoor_founded",
    "employer_industry": "glassdoor_industry",
    "employer_revenue": "glassdoor_revenue",
    "geral": "glassdoor_geral",
    "cultura_valores": "glassdoor_cultura_valores",
    "diversidade_inclusao": "glassdoor_diversidade_inclusao",
    "qualidade_vida": "glassdoor_qualidade_vida",
    "alta_lideranca": "glassdoor_alta_lideranca",
    "remuneracao_beneficios": "glassdoor_remuneracao_beneficios",
    "oportunidades_carreira": "glassdoor_oportunidades_carreira",
    "recomendam_percentual": "glassdoor_recomendam_percentual",
    "perspectiva_positiva_percentual": "glassdoor_perspectiva_positiva_percentual",
    "match_percent": "glassdoor_match_percent",
}
TAX_ID_METHOD = "CNPJ_ENQUADRAMENTO"
NAME_METHOD = "NOME_GLASSDOOR"
DELIVERY_COLUMN_COUNT = 47
FINAL_TABLE = "public.tabela_final_reclamacoes"
DELIVERY_TABLE = "public.delivery_reclamacoes_enriquecidas"
