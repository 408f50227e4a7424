"""CSV template round trip and input discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE_SCHEMA = "id BIGINT, binds FLOAT"
# Written instead of the characters that would break a record over lines; the first stands for itself.
LINE_CODES = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))


def read_template(spark: SparkSession, path: str, schema: str = TEMPLATE_SCHEMA) -> DataFrame:
    """S3: the output template, header CSV with declared types (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() == "string"]


def read_small_csv(spark: SparkSession, path: str, schema: str, first_n: int | None = None,
                   order_by: str | None = None, one_line: bool = False) -> DataFrame:
    """Header CSV with a declared schema; optional first rows as a mock set. A foreign
    file may hold line breaks in quotes, so each file is one task; files of
    ``write_csv(one_line=True)`` have a record a line and are read in splits."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", not one_line)
          .option("escape", '"').csv(path))
    if one_line:
        for char, code in reversed(LINE_CODES):
            df = df.withColumns({c: F.replace(F.col(c), F.lit(code), F.lit(char)) for c in _strings(df)})
    return df.orderBy(order_by or df.columns[0]).limit(first_n) if first_n else df


def write_csv(df: DataFrame, path: str, order_by: str | None = None, one_line: bool = False) -> str:
    """Header CSV; with ``one_line`` line breaks in strings are written as codes. Row order inside the files follows ``order_by`` (a range
    sort, parallel); consumers must not rely on file order beyond that."""
    out = df.orderBy(order_by) if order_by else df
    if one_line:
        for char, code in LINE_CODES:
            out = out.withColumns({c: F.replace(F.col(c), F.lit(char), F.lit(code)) for c in _strings(df)})
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """S7 listing: files under ``root`` (recursively) whose name matches ``glob``.
    Only path/length/modificationTime are selected, so no file content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(root)
            .select("path", F.col("length").cast("bigint").alias("length"), "modificationTime"))


def find_input(spark: SparkSession, root: str, name_part: str, default: str | None = None) -> str | None:
    """First file (in path order) whose lower-cased name contains ``name_part``, else
    ``default``. Only one path string reaches the driver."""
    files = list_files(spark, root, "*")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    hit = (files.where(name.contains(name_part.lower())).orderBy("path")
           .select("path").limit(1).collect())
    return hit[0][0] if hit else default
