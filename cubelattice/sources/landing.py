"""Readers of landed source files: JSON catalog responses, CSV seeds, pivot texts. Fetching is a separate,
rate-limited driver job (``fetcher``); executors only read what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubelattice.functions.labels import COUNTIES

CONTEXT_JSON = "level int, parentCode string, context struct<name:string,code:string,childrenUrl:string,comment:string,url:string>"
MATRIX_LIST_JSON = "name string, code string, childrenUrl string, comment string, url string"
MATRIX_JSON = (
    "ancestors array<struct<name:string,code:string>>, matrixName string, periodicitati array<string>, surseDeDate array<struct<nume:string,link:string>>, "
    "dimensionsMap array<struct<dimCode:int,label:string,options:array<struct<label:string,nomItemId:int,offset:int,parentId:int>>>>, "
    "ultimaActualizare string, details struct<nomJud:int,nomLoc:int,matMaxDim:int,matUMSpec:int,matSiruta:int,matCaen1:int,matCaen2:int,matRegJ:int,matCharge:int,matViews:int,matDownloads:int,matActive:int,matTime:int>"
)
SEED_CSV = "id int, code string, siruta_code string, level string, parent_code string, name_ro string, nuts string, type string, urban string, source string"


def json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed responses, one JSON document per file, with the file they came from."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def contexts(responses: DataFrame) -> DataFrame:
    """Landed context lists -> code, parent_code (null at the top), level, name, children_type (matrix or context)."""
    parent = F.nullif(F.nullif(F.col("parentCode"), F.lit("")), F.lit("0"))
    kind = F.when(F.lower(F.coalesce("context.childrenUrl", F.lit(""))).contains("matrix"), "matrix").otherwise("context")
    return responses.select(F.col("context.code").alias("code"), parent.alias("parent_code"), "level", F.trim("context.name").alias("name"), kind.alias("children_type"))


def context_paths(rows: DataFrame, depth: int = 8) -> DataFrame:
    """Contexts with the path of codes from the top, at most ``depth`` levels."""
    up = rows.select(F.col("code").alias("pc"), F.col("parent_code").alias("next"))
    out = rows.withColumns({"path": F.col("code"), "up": F.col("parent_code")})
    for _ in range(depth - 1):
        out = out.join(up, F.col("up") == F.col("pc"), "left")
        out = out.withColumn("path", F.when(F.col("pc").isNotNull(), F.concat_ws(".", "pc", "path")).otherwise(F.col("path"))).withColumn("up", F.col("next")).drop("pc", "next")
    return out.drop("up")


def matrix_list(responses: DataFrame) -> DataFrame:
    """Landed matrix lists -> code, name; entries without code go."""
    return responses.select(F.trim("code").alias("code"), F.trim("name").alias("name")).filter("code != ''")


def bilingual(ro: DataFrame, en: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Pair the two languages by key, never by position; missing English stays null."""
    english = en.select(key, *[F.col(n).alias(f"{n}_en") for n in names])
    return ro.withColumnsRenamed({n: f"{n}_ro" for n in names}).join(english, key, "left")


def matrix_options(matrices: DataFrame) -> DataFrame:
    """Matrix responses -> one row per dimension option, with the dimension's place and label."""
    dims = matrices.select("file", F.posexplode("dimensionsMap").alias("dim_index", "d"))
    rows = dims.select("file", "dim_index", F.col("d.label").alias("dim_label"), F.explode("d.options").alias("o"))
    return rows.select("file", "dim_index", "dim_label", F.trim("o.label").alias("label"), F.col("o.nomItemId").alias("nom_item_id"), F.col("o.offset").alias("offset"), F.col("o.parentId").alias("parent_id"))


def pivot_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed pivot texts as (file, line_no, line); whole files keep their line order."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return whole.filter(F.trim("line") != "")


def territory_seed(spark: SparkSession, path: str) -> DataFrame:
    """The seed CSV; empty cells are null. ``metadata`` has kind (tip) and urban mark (med), null where neither is given."""
    rows = spark.read.schema(SEED_CSV).option("header", True).csv(path)
    rows = rows.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])
    marks = F.struct(F.col("type").try_cast("int").alias("tip"), F.col("urban").try_cast("int").alias("med"))
    return rows.withColumn("metadata", F.when(F.coalesce("type", "urban", "nuts").isNotNull(), marks))


def seed_paths(seed: DataFrame) -> DataFrame:
    """Territories with path and parent id: at most five levels, so four look-ups of the parent suffice."""
    parents = seed.select(F.col("code").alias("pc"), F.col("id").alias("parent_id"), F.col("parent_code").alias("next"))
    out = seed.join(parents.drop("next"), F.col("parent_code") == F.col("pc"), "left").drop("pc").withColumns({"path": F.col("code"), "up": F.col("parent_code")})
    for _ in range(4):
        out = out.join(parents.select("pc", "next"), F.col("up") == F.col("pc"), "left")
        out = out.withColumn("path", F.when(F.col("pc").isNotNull(), F.concat_ws(".", "pc", "path")).otherwise(F.col("path"))).withColumn("up", F.col("next")).drop("pc", "next")
    return out.drop("up")


def localities(spark: SparkSession, path: str, counties: dict[int, str]) -> DataFrame:
    """The register of localities (semicolons; second level only) as seed rows under their counties.

    ``counties`` maps the register's county numbers to county codes."""
    unknown = set(counties.values()) - set(COUNTIES.values())
    if unknown:
        raise ValueError(f"unknown counties: {sorted(unknown)}")
    county = F.try_element_at(F.create_map(*[F.lit(x) for pair in counties.items() for x in pair]), F.col("JUD").cast("int"))
    rows = spark.read.option("header", True).option("sep", ";").csv(path).filter(F.col("NIV") == "2")
    return rows.select(F.col("SIRUTA").alias("code"), F.col("SIRUTA").alias("siruta_code"), F.lit("LAU").alias("level"), county.alias("parent_code"), F.col("DENLOC").alias("name_ro"), F.col("TIP").alias("type"), F.col("MED").alias("urban"))


def whole_seed(static: DataFrame, localities: DataFrame, extra: DataFrame, known: DataFrame) -> DataFrame:
    """Nation to counties (static rows), the register's localities, and rows that only the source has, as one seed:
    code, siruta_code, level, parent_code, name_ro, type, urban, source and id. Rows keep the id that is known for
    their register number, else for their code; others get the next numbers in order of code."""
    columns = ["code", "siruta_code", "level", "parent_code", "name_ro", "type", "urban"]

    def side(df: DataFrame, source: str) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns], F.lit(source).alias("source"))

    rows = side(static, "STATIC").unionByName(side(localities, "SIRUTA")).unionByName(side(extra, "SOURCE"))
    numbers = known.filter("siruta_code is not null").select("siruta_code", F.col("id").alias("by_number"))
    codes = known.select("code", F.col("id").alias("by_code"))
    rows = rows.join(numbers, "siruta_code", "left").join(codes, "code", "left").withColumn("id", F.coalesce("by_number", "by_code"))
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    nth = F.row_number().over(Window.partitionBy(F.col("id").isNull()).orderBy("code"))  # a country's territories
    rows = rows.withColumn("nth", nth).crossJoin(F.broadcast(top))  # one row
    return rows.select(F.coalesce("id", F.col("top") + F.col("nth")).cast("int").alias("id"), *columns, "source")


def seed_problems(seed: DataFrame) -> DataFrame:
    """Rows that a good seed does not have: (problem, code)."""
    twice = lambda c: seed.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1").select(F.lit(f"duplicate {c}").alias("problem"), F.col(c).alias("code"))
    parents = seed.select(F.col("code").alias("parent_code"))
    orphans = seed.filter("parent_code is not null").join(parents, "parent_code", "left_anti").select(F.lit("unknown parent").alias("problem"), "code")
    filled = seed.filter("level = 'LAU'").select(F.col("parent_code").alias("code"))
    empty = seed.filter("level = 'NUTS3'").join(filled, "code", "left_anti").select(F.lit("county without locality").alias("problem"), "code")
    return twice("code").unionByName(twice("siruta_code")).unionByName(orphans).unionByName(empty)
