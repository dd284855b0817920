"""Public lists of companies: ten kinds of files with columns under changing names, reduced to the firms of a registry."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import amount, list_date
from ..functions.text import company_id, header, redacted

# Columns that may hold the company's number.
COMPANY = "CNPJ NU_CNPJ CO_CNPJ NR_CNPJ CNPJ_CPF CPF_CNPJ NUM_CNPJ CNPJ_EMPRESA".split()
# The lists; level (of the number that counts), rule (how values are summed up, `soma` unless stated) and candidate columns.
LISTS = {
    "mdic_exportadoras": {"level": "company", "label": "FAIXA_VALOR FAIXA FAIXA_FOB OPERACAO TIPO", "date": "ANO CO_ANO"},
    "bndes_operacoes": {
        "level": "company",
        "cnpj": "CPF_CNPJ CNPJ CNPJ_DO_CLIENTE CNPJ_CLIENTE",
        "value": "VALOR_CONTRATADO_R VALOR_CONTRATADO VALOR_DA_OPERACAO_EM_R VALOR_DESEMBOLSADO_R",
        "date": "DATA_DA_CONTRATACAO DATA_CONTRATACAO DATA_DA_OPERACAO",
        "label": "PRODUTO INSTRUMENTO_FINANCEIRO SUBSETOR_CNAE_NOME SETOR_BNDES",
    },
    "ibama_ctf": {
        "level": "company",
        "date": "DATA_INICIO_ATIVIDADE DATA_DE_INICIO_DA_ATIVIDADE DT_INICIO_ATIVIDADE DATA_CADASTRO",
        "label": "CATEGORIA DESCRICAO_CATEGORIA ATIVIDADE DESCRICAO_ATIVIDADE",
    },
    "iat_licencas": {
        "level": "establishment",
        "date": "DATA_VALIDADE VALIDADE DT_VALIDADE DATA_DE_VALIDADE VENCIMENTO",
        "label": "TIPO_LICENCA TIPO_DE_LICENCA MODALIDADE ATIVIDADE",
    },
    "cadastur": {
        "level": "establishment",
        "date": "VALIDADE_DO_CERTIFICADO DATA_VALIDADE VALIDADE DATA_DE_VALIDADE",
        "label": "ATIVIDADE TIPO_DE_ATIVIDADE ATIVIDADE_TURISTICA TIPO",
    },
    "anatel_scm": {
        "level": "company", "rule": "ultimo",
        "cnpj": "CNPJ CNPJ_DA_PRESTADORA NUM_CNPJ",
        "value": "ACESSOS QUANTIDADE_DE_ACESSOS QT_ACESSOS",
        "date": "DATA ANO_MES ANO",
        "label": "TECNOLOGIA MEIO_DE_ACESSO SERVICO",
    },
    "mapa_sif": {"level": "establishment", "label": "CLASSIFICACAO AREA CATEGORIA ATIVIDADE"},
    "emec": {
        "level": "company",
        "cnpj": "CNPJ NU_CNPJ CNPJ_MANTENEDORA NU_CNPJ_MANTENEDORA",
        "label": "ORGANIZACAO_ACADEMICA CATEGORIA_ADMINISTRATIVA TIPO",
        "date": "DATA_DE_INICIO_DO_FUNCIONAMENTO DT_INICIO_FUNCIONAMENTO",
    },
    "cnes": {
        "level": "establishment",
        "cnpj": "NU_CNPJ CO_CNPJ CNPJ",
        "label": "DS_TIPO_UNIDADE TIPO_UNIDADE TP_UNIDADE NO_TIPO_UNIDADE",
        "date": "DT_ATUALIZACAO DATA_ATUALIZACAO CO_COMPETENCIA",
    },
    "anp_revendas": {
        "level": "establishment", "rule": "nenhum",
        "cnpj": "CNPJ_DA_REVENDA CNPJ",
        "value": "VALOR_DE_VENDA PRECO_VENDA",
        "date": "DATA_DA_COLETA DATA_COLETA",
        "label": "PRODUTO BANDEIRA",
    },
}
# Columns that may say something about a person are not kept.
PERSONAL = (
    "CPF|E_?MAIL|TELEFONE|FONE|CELULAR|FAX|RESPONSAVEL|REPRESENTANTE|SOCIO|CONTATO|CLIENTE|NOME|TITULAR|"
    "REQUERENTE|INTERESSADO|EMPREENDEDOR|PROPRIETARIO|RAZAO"
)


def specs(spark: SparkSession) -> DataFrame:
    """list, level, rule of all lists, for the rollup."""
    return spark.createDataFrame([(n, s["level"], s.get("rule", "soma")) for n, s in LISTS.items()], "list string, level string, rule string")


def _first(columns: Sequence[str], options: str) -> str | None:
    return next((o for o in map(header, options.split()) if o in columns), None)


def number_column(columns: Sequence[str], options: Sequence[str] = COMPANY) -> str | None:
    """The first candidate that a file has, else any column named after company numbers but for those of parent institutions."""
    return _first(columns, " ".join(options)) or next((c for c in columns if "CNPJ" in c and "MANTENEDORA" not in c), None)


def entries(df: DataFrame, name: str, firms: DataFrame) -> DataFrame:
    """list, cnpj, root, label, date, value, attributes (JSON) of a list's rows (read by read_csv, so under normalised names) that belong to
    firms(key, root, person): by full number or by root, as the list's level says. Numbers must pass their check digits. Attributes are the
    file's other columns that aren't personal, without person numbers in their text; none at all where the root is a natural person."""
    spec = LISTS[name]
    col = number_column(df.columns, spec["cnpj"].split() if "cnpj" in spec else COMPANY)
    if col is None:
        raise ValueError(f"{name}: no column of company numbers; the header has {', '.join(df.columns)}")
    label, day, value = (_first(df.columns, spec.get(k, "")) for k in ("label", "date", "value"))
    kept = [c for c in df.columns if c != col and not re.search(PERSONAL, c)]
    number = company_id(col, only_companies="CPF" not in col)
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.trim(redacted(c)).alias("value")) for c in kept))
    pairs = F.filter(pairs, lambda p: F.coalesce(p["value"], F.lit("")) != "") if kept else None
    text = lambda c: F.nullif(F.trim(c), F.lit("")) if c else F.lit(None).cast("string")
    x = df.withColumn("_n", number).where("_n is not null").select(
        F.lit(name).alias("list"), F.when(F.length("_n") == 14, F.col("_n")).alias("cnpj"), F.left("_n", F.lit(8)).alias("root"),
        text(label).alias("label"), (list_date(day) if day else F.lit(None).cast("date")).alias("date"),
        (amount(value) if value else F.lit(None).cast("decimal(38,10)")).cast("double").alias("value"),
        (F.to_json(F.map_from_entries(pairs)) if kept else F.lit("{}")).alias("attributes"),
    )
    if spec["level"] == "establishment":
        x = x.join(firms.select(F.col("key").alias("cnpj")), "cnpj", "left_semi")
    people = firms.groupBy("root").agg(F.bool_or(F.coalesce("person", F.lit(False))).alias("person"))
    return x.join(people, "root").select("list", "cnpj", "root", "label", "date", "value", F.when(F.col("person"), "{}").otherwise(F.col("attributes")).alias("attributes"))
