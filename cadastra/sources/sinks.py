"""Writers: full and slice replacement, privacy gate, publication package with manifest."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# Column names that never leave, and the person numbers that no text may hold.
FORBIDDEN = r"(?i)razao|fantasia|nome_socio|socio|cpf|e_?mail|telefone|fone|logradouro|^numero$|complemento|endereco|titular"
PERSON = r"(?<![0-9])[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}(?![0-9])"


class PrivacyError(ValueError):
    pass


def _names(kind: DataType, name: str) -> list[str]:
    """A column's name and those of the fields in it."""
    if isinstance(kind, ArrayType):
        return _names(kind.elementType, name)
    if isinstance(kind, StructType):
        return [name, *(x for f in kind.fields for x in _names(f.dataType, f.name))]
    return [name]


def privacy_gate(df: DataFrame, exempt_prefix: str = "h3_") -> DataFrame:
    """column, bad (rows with a person number) of every column with text, nested text included; one pass."""
    text = [f for f in df.schema.fields if "string" in f.dataType.simpleString() and not f.name.startswith(exempt_prefix)]
    if not text:
        return df.sparkSession.createDataFrame([], "column string, bad long")
    plain = lambda f: F.col(f"`{f.name}`") if f.dataType.simpleString() == "string" else F.to_json(F.struct(f"`{f.name}`"))
    one = df.agg(*(F.count_if(plain(f).rlike(PERSON)).alias(f"c{k}") for k, f in enumerate(text)))
    pairs = F.array(*(F.struct(F.lit(f.name).alias("column"), F.col(f"c{k}").alias("bad")) for k, f in enumerate(text)))
    return one.select(F.inline(pairs))


def check_private(df: DataFrame) -> DataFrame:
    """df again, or PrivacyError for forbidden names of columns or nested fields, or person numbers in text."""
    names = [n for f in df.schema.fields for n in _names(f.dataType, f.name)]
    if names := [c for c in names if re.search(FORBIDDEN, c)]:
        raise PrivacyError(f"forbidden columns: {', '.join(names)}")
    if bad := [r["column"] for r in privacy_gate(df).where("bad > 0").collect()]:  # one row a column
        raise PrivacyError(f"person numbers in: {', '.join(bad)}")
    return df


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_slice(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Only the partitions that df has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def digest(spark: SparkSession, path: str) -> str:
    """SHA-256 over the part files of a table in name order, computed by the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    each = files.select(F.regexp_extract("path", "[^/]+$", 0).alias("p"), F.sha2("content", 256).alias("h"))
    got = each.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "h"))), lambda x: x["h"]), ""), 256).alias("d"))
    return got.first().d


def publish(spark: SparkSession, layers: dict[str, DataFrame | str], path: str) -> dict:
    """Writes every layer that passes the privacy gate and a manifest with rows, columns and digests; a layer given as text isn't there,
    for that reason. Layers of an earlier package that are no longer in it go."""
    root, fs = _fs(spark, path)
    if fs.exists(root):
        for s in fs.listStatus(root):
            if s.getPath().getName() not in layers:
                fs.delete(s.getPath(), True)
    manifest = {"created": datetime.now(timezone.utc).isoformat(timespec="seconds"), "layers": {}}
    for name, df in layers.items():
        if isinstance(df, str):
            manifest["layers"][name] = {"missing": df}
            continue
        replace(check_private(df), f"{path}/{name}")
        manifest["layers"][name] = {"rows": spark.read.parquet(f"{path}/{name}").count(), "columns": df.columns, "sha256": digest(spark, f"{path}/{name}")}
    p, fs = _fs(spark, f"{path}/manifest.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(manifest, indent=1).encode()))
    out.close()
    return manifest


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A small table as Markdown; `most` rows at most are brought to the driver."""
    rows = df.limit(most).collect()
    cell = lambda v: "" if v is None else str(v)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""])


def publication_cut(firms: DataFrame) -> DataFrame:
    """Active legal entities, no sole traders, at commercial or mixed points, located to the block."""
    precise = F.col("level").isin("estabelecimento", "endereco", "endereco_sem_cep", "numero_proximo")
    return firms.where(F.col("active") & ~F.col("person") & ~F.col("mei") & F.col("point_type").isin("commercial", "mixed") & precise)
