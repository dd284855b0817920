"""Tolerant readers. Small driver-side looks at a file's first bytes decide encoding and delimiter; Spark reads the rest. All columns come
as text; parsing is a later projection."""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header
from ..operators.geo import oriented

SNIFF = 1 << 20


def head_of(spark: SparkSession, path: str, n: int = SNIFF, member: str | None = None) -> bytes:
    """The first bytes of a file in any store that Spark reads, or of a member of a zip file, which is streamed up to there: the first
    .csv or .txt member, or the one whose name ends with `member`."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(c in path for c in "*?[{"):
        p = fs.globStatus(p)[0].getPath()
    stream = fs.open(p)
    try:
        if path.lower().endswith(".zip"):
            stream = jvm.java.util.zip.ZipInputStream(stream)
            while (entry := stream.getNextEntry()) is not None and not _wanted(entry.getName(), member):
                pass
            if entry is None:
                raise ValueError(f"{path} has no {member or '.csv or .txt'} member")
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def _wanted(name: str, member: str | None) -> bool:
    base = name.rsplit("/", 1)[-1].lower()
    return base == member.lower() if member else base.endswith((".csv", ".txt"))


def encoding_of(sample: bytes) -> str:
    """UTF-8 if the sample decodes strictly (a character cut at its end doesn't count), else Windows-1252."""
    try:
        codecs.getincrementaldecoder("utf-8-sig")("strict").decode(sample, final=len(sample) < SNIFF)
        return "UTF-8"
    except UnicodeDecodeError:
        return "windows-1252"


def delimiter_of(line: str) -> str:
    """The most frequent of ; , tab and | in the first line."""
    return max(";,\t|", key=line.count)


# The printable characters that Windows-1252 has where ISO-8859-1 has control codes.
CONTROLS = "".join(map(chr, (*range(0x80, 0x81), *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F)))
PRINTABLE = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def _breaks_inside(text: str, quote: str = '"') -> bool:
    """Whether a line of a sample ends inside quotes."""
    open_ = False
    for line in text.splitlines()[:-1]:
        open_ ^= line.count(quote) % 2 == 1
        if open_:
            return True
    return False


def read_csv(
    spark: SparkSession, path: str, required: Sequence[str] = (), skip: int = 0, delimiter: str | None = None, member: str | None = None, multiline: bool | None = None
) -> DataFrame:
    """A delimited text file, all columns as text under normalised names, blank as null. Missing required columns are an error that lists
    what is there. Plain files are split and read by Spark, unless quoted values hold line ends (multiline; without it the first MiB
    decides), which no split may cut. Zipped ones (first .csv or .txt member, or the named one) and those with `skip` lines before the
    header are read whole, each by one task, up to the 2 GB that Spark's binary files take."""
    sample = head_of(spark, path, member=member)
    latin = encoding_of(sample) != "UTF-8"
    text = sample.decode("cp1252" if latin else "utf-8-sig", "replace")
    lines = text.splitlines()
    sep = delimiter or delimiter_of(lines[skip] if len(lines) > skip else "")
    if path.lower().endswith(".zip") or skip:
        return _read_whole(spark, path, required, skip, sep, "cp1252" if latin else "utf-8-sig", lines[skip], member)
    options = {"sep": sep, "encoding": "ISO-8859-1" if latin else "UTF-8", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    options["multiLine"] = _breaks_inside(text) if multiline is None else multiline
    df = _named(spark.read.options(header=True, inferSchema=False, **options).csv(path), required)
    return df.select(*(F.translate(c, CONTROLS, PRINTABLE).alias(c) for c in df.columns)) if latin else df


def _read_whole(spark, path, required, skip, sep, encoding, head, member) -> DataFrame:
    import csv

    names = next(csv.reader([head], delimiter=sep))
    cols, zipped = [f"c{k}" for k in range(len(names))], path.lower().endswith(".zip")

    def unpack(batches):
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                raw = io.BytesIO(content)
                if zipped:
                    z = zipfile.ZipFile(raw)
                    raw = z.open(next(n for n in z.namelist() if _wanted(n, member)))
                text = io.TextIOWrapper(raw, encoding=encoding, errors="replace", newline="")
                for _ in range(skip):
                    text.readline()
                for part in pd.read_csv(text, sep=sep, dtype=str, keep_default_na=False, chunksize=50_000, index_col=False):
                    yield part.iloc[:, : len(cols)].set_axis(cols, axis=1)

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, ", ".join(f"{c} string" for c in cols))
    return _named(rows.toDF(*names), required)


def _named(df: DataFrame, required: Sequence[str]) -> DataFrame:
    names = [header(c) for c in df.columns]
    names = [n if names.index(n) == k else f"{n}_{k}" for k, n in enumerate(names)]
    if missing := [r for r in required if r not in names]:
        raise ValueError(f"missing {', '.join(missing)}; the header has {', '.join(names)}")
    df = df.toDF(*names)
    return df.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names))


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, null where the file lacks one."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def first_existing(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of several names that the table has; null without any."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast("string"))


def address_census(df: DataFrame, municipality: str) -> DataFrame:
    """Numbered rows of one municipality with coordinates (decimal comma allowed); of repeated ids the smallest row stays."""
    number = lambda c: F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double")
    x = df.where(F.col("COD_MUNICIPIO") == municipality).withColumn("lat", number("LATITUDE")).withColumn("lon", number("LONGITUDE"))
    x = x.where("lat is not null and lon is not null")
    cols = [c for c in x.columns if c != "COD_UNICO_ENDERECO"]
    return x.groupBy("COD_UNICO_ENDERECO").agg(F.min(F.struct(*cols)).alias("r")).select("COD_UNICO_ENDERECO", "r.*")


def census_long(df: DataFrame, code: str, municipality: str) -> DataFrame:
    """zone, variable, value of the municipality's rows: every V#### and AREA_KM2 column unpivoted, what isn't a number left out."""
    values = [c for c in df.columns if c == "AREA_KM2" or (c[:1] == "V" and c[1:].isdigit())]
    x = df.where(F.left(F.col(code), F.lit(7)) == municipality).withColumn("zone", F.regexp_extract(code, "^[0-9]+", 0))
    x = x.select("zone", *values).unpivot(["zone"], values, "variable", "text")
    value = F.replace(F.col("text"), F.lit(","), F.lit(".")).try_cast("double")
    return x.select("zone", "variable", value.alias("value")).where("value is not null")


def registry(df: DataFrame) -> DataFrame:
    """The company registry with its privacy rules: sole traders have no name, trade names with a person number none, numbers in names are
    masked; dates parsed."""
    from ..functions.parse import compact_date
    from ..functions.text import masked_person_id, person_id_in

    person = (F.col("opcao_mei") == "S") | (F.col("natureza_juridica") == "2135")
    person = F.coalesce(person, F.lit(False))
    return df.withColumns(
        {
            "pessoa_fisica": person,
            "cpf_mascarado": F.when(person, masked_person_id(person_id_in("razao_social"))),
            "razao_social": F.when(~person, F.col("razao_social")),
            "nome_fantasia": F.when(person_id_in("nome_fantasia").isNull(), F.col("nome_fantasia")),
            "data_inicio_atividade": compact_date("data_inicio_atividade"),
            "data_situacao_cadastral": compact_date("data_situacao_cadastral"),
        }
    )


def read_gazette(spark: SparkSession, path: str, row_tag: str = "processo") -> DataFrame:
    """Trademark gazette XML: a row per process and owner."""
    df = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "_").load(path)
    owners = "titulares.titular"
    return df.select("*", F.explode_outer(F.array(F.col(owners)) if not str(df.select(owners).schema[0].dataType).startswith("ArrayType") else F.col(owners)).alias("owner"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GeoJSON file: properties (map), type, point (x, y), rings of all parts of polygons (outer ones counter-clockwise, holes
    clockwise) and lines of all parts. Features without a geometry are left out."""
    schema = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    raw = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f"))
    raw = raw.select(F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("c"))
    at = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    many = lambda kind, depth: F.when(F.col("type") == f"Multi{kind}", F.from_json("c", depth)).when(F.col("type") == kind, F.array(F.from_json("c", depth[6:-1])))
    polygons = many("Polygon", "array<array<array<array<double>>>>")
    rings = F.flatten(F.transform(polygons, lambda poly: F.transform(poly, lambda ring, k: oriented(F.transform(ring, at), k == 0))))
    lines = F.transform(many("LineString", "array<array<array<double>>>"), lambda line: F.transform(line, at))
    point = F.when(F.col("type") == "Point", at(F.from_json("c", "array<double>")))
    return raw.where("c is not null").select("properties", "type", point.alias("point"), rings.alias("rings"), lines.alias("lines"))


def layer(features: DataFrame, names: Sequence[str], codes: Sequence[str]) -> DataFrame:
    """code, name, rings of a polygon layer: the first of several properties that a feature has; a code that repeats the name is null, a
    whole number as a decimal loses its fraction."""
    first = lambda keys: F.coalesce(*(F.nullif(F.trim(F.element_at("properties", k)), F.lit("")) for k in keys), F.lit(None).cast("string"))
    x = features.where(F.size("rings") > 0).select(first(names).alias("name"), F.regexp_replace(first(codes), r"\.0+$", "").alias("code"), "rings")
    return x.select(F.when(~F.col("code").eqNullSafe(F.col("name")), F.col("code")).alias("code"), "name", "rings").where("name is not null or code is not null")


def sector_mesh(features: DataFrame, municipality: str, codes: Sequence[str] = ("CD_SETOR", "CD_GEOCODI", "GEOCODIGO")) -> DataFrame:
    """code, rings of one municipality's census sectors: the first seven digits of a sector's code are its municipality's."""
    code = F.regexp_extract(F.coalesce(*(F.element_at("properties", c) for c in codes), F.lit("")), "^[0-9]+", 0)
    return features.where(F.size("rings") > 0).select(code.alias("code"), "rings").where(F.col("code").startswith(municipality))


# Kinds of way that nobody walks on.
NOT_WALKED = ("motorway", "motorway_link", "trunk", "trunk_link", "construction", "proposed", "raceway")


def road_lines(features: DataFrame, box: tuple[float, float, float, float], excluded: Sequence[str] = NOT_WALKED) -> DataFrame:
    """x1, y1, x2, y2 of the straight pieces of walkable ways that touch a box (x0, y0, x1, y1): no excluded kinds, none closed to feet."""
    p = lambda k: F.coalesce(F.element_at("properties", k), F.lit(""))
    ways = features.where((p("highway") != "") & ~p("highway").isin(*excluded) & (p("foot") != "no") & F.col("lines").isNotNull())
    line = ways.select(F.explode("lines").alias("l")).where(F.size("l") > 1)
    pieces = F.zip_with(F.slice("l", F.lit(1), F.size("l") - 1), F.slice("l", F.lit(2), F.size("l") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    x = line.select(F.explode(pieces).alias("s")).select(F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))
    return x.where((F.greatest("x1", "x2") >= box[0]) & (F.least("x1", "x2") <= box[2]) & (F.greatest("y1", "y2") >= box[1]) & (F.least("y1", "y2") <= box[3]))


def footprints(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows of a Parquet table of buildings whose bbox (xmin, xmax, ymin, ymax) touches a box; the comparisons reach the scan, whose
    row-group statistics skip the rest."""
    b = spark.read.parquet(path)
    return b.where((F.col("bbox.xmax") >= box[0]) & (F.col("bbox.xmin") <= box[2]) & (F.col("bbox.ymax") >= box[1]) & (F.col("bbox.ymin") <= box[3]))


def read_registry(spark: SparkSession, url: str, table: str, state: str, municipality: str, name: str, columns: Sequence[str], **options) -> DataFrame:
    """The registry's rows of one municipality (by code or name) from another database over JDBC: only these columns and this predicate
    go to it. url may also name a Parquet folder."""
    source = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load() if url.startswith("jdbc:") else spark.read.parquet(f"{url.rstrip('/')}/{table}")
    place = (F.col("municipio") == municipality) | (F.upper("nome_municipio") == name.upper())
    return source.where((F.col("uf") == state) & place).select(*columns)


def activity_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """Ten flat columns of an activity classification's nested JSON (class, group, division, section); ids as digits only."""
    level = lambda inner: f"struct<id:string,descricao:string{inner}>"
    schema = f"id string, descricao string, classe {level(',grupo:' + level(',divisao:' + level(',secao:' + level(''))))}"
    x = spark.read.schema(schema).option("multiLine", True).json(path)
    d = lambda c: F.nullif(F.regexp_replace(F.coalesce(c, F.lit("")), "[-/.]", ""), F.lit(""))
    g, dv, se = "classe.grupo", "classe.grupo.divisao", "classe.grupo.divisao.secao"
    return x.select(
        d("id").alias("subclasse"), F.col("descricao"), d("classe.id").alias("classe"), F.col("classe.descricao").alias("classe_descricao"), d(f"{g}.id").alias("grupo"), F.col(f"{g}.descricao").alias("grupo_descricao"),
        F.col(f"{dv}.id").alias("divisao"), F.col(f"{dv}.descricao").alias("divisao_descricao"), F.col(f"{se}.id").alias("secao"), F.col(f"{se}.descricao").alias("secao_descricao"),
    )


def derived_hierarchy(codes: DataFrame) -> DataFrame:
    """The same columns from seven-digit codes(codigo, descricao) alone; names of the levels are null."""
    none = F.lit(None).cast("string")
    c = F.col("codigo")
    return codes.where(F.length(c) == 7).select(
        c.alias("subclasse"), "descricao", F.left(c, F.lit(5)).alias("classe"), none.alias("classe_descricao"), F.left(c, F.lit(3)).alias("grupo"), none.alias("grupo_descricao"),
        F.left(c, F.lit(2)).alias("divisao"), none.alias("divisao_descricao"), none.alias("secao"), none.alias("secao_descricao"),
    )


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """station, ts (UTC), rain, temp, high, low of hourly station files: some lines of metadata, among them the station's code, then a
    header found by its first column. A value that is blank or begins with -9999 is missing. Each file is one station's year."""

    def parse(batches):
        import csv

        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                rows, names, station = [], None, "desconhecida"
                for cells in csv.reader(io.StringIO(content.decode("cp1252", "replace")), delimiter=";"):
                    first = header(cells[0]) if cells else ""
                    if names is None and first.startswith("CODIGO") and len(cells) > 1:
                        station = cells[1].strip()
                    elif names is None and first.startswith("DATA") and len(cells) > 1:
                        names = [header(c) for c in cells]
                        at = [next((k for k, n in enumerate(names) if n.startswith(p)), -1) for p in WEATHER]
                    elif names is not None:
                        rows.append([station, *(cells[k].strip() if 0 <= k < len(cells) else "" for k in at)])
                if names is None:
                    raise ValueError("no header of data found")
                yield pd.DataFrame(rows, columns=["station", "day", "hour", "rain", "temp", "high", "low"], dtype=str)

    raw = spark.read.format("binaryFile").load(path).select("content")
    x = raw.mapInPandas(parse, "station string, day string, hour string, rain string, temp string, high string, low string")
    day, hour = F.regexp_replace("day", "[^0-9]", ""), F.rpad(F.left(F.regexp_replace("hour", "[^0-9]", ""), F.lit(4)), 4, "0")
    ts = F.when(F.length(day) == 8, F.try_to_timestamp(F.concat(day, hour), F.lit("yyyyMMddHHmm")))
    number = lambda c: F.when(~F.col(c).startswith("-9999"), F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double")).alias(c)
    return x.select("station", ts.alias("ts"), *(number(c) for c in ("rain", "temp", "high", "low"))).where("ts is not null")


# How the columns of day, hour, rain, temperature, its maximum and minimum begin.
WEATHER = ("DATA", "HORA", "PRECIPITACAO_TOTAL", "TEMPERATURA_DO_AR_BULBO_SECO", "TEMPERATURA_MAXIMA", "TEMPERATURA_MINIMA")


# What a column's name may say about it.
INTERESTS = {"cnpj": "CNPJ", "cpf": "CPF", "address": "ENDERECO|LOGRADOURO|RUA|CEP|BAIRRO", "coordinate": "LAT|LON|COORD|GEOM|^X$|^Y$", "date": "DATA|^DT_|ANO|MES"}


def profile(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """column, filled, percent, interest of each column in long form: one aggregation over the table, or over at most so many rows. What
    isn't blank is filled; no values are shown. interest: what the name points at, joined."""
    df = df if most_rows is None else df.limit(most_rows)
    full = lambda f: F.col(f"`{f.name}`") if f.dataType.simpleString() != "string" else F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit(""))
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(full(f)).alias(f"c{k}") for k, f in enumerate(df.schema.fields)))
    words = lambda c: ",".join(k for k, p in INTERESTS.items() if re.search(p, header(c)))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"c{k}").alias("filled"), F.lit(words(c)).alias("interest")) for k, c in enumerate(df.columns)))
    return one.select("n", F.inline(pairs)).select("column", "filled", F.round(100.0 * F.col("filled") / F.nullif(F.col("n"), F.lit(0)), 1).alias("percent"), "interest")


def inventory(spark: SparkSession, path: str, most_rows: int = 200_000) -> DataFrame:
    """profile() of a file with its encoding and delimiter beside each column, over at most so many rows."""
    sample = head_of(spark, path)
    code = encoding_of(sample)
    first = next(iter(sample.decode("cp1252" if code != "UTF-8" else "utf-8-sig", "replace").splitlines()), "")
    return profile(read_csv(spark, path), most_rows).withColumns({"encoding": F.lit(code), "delimiter": F.lit(delimiter_of(first))})
