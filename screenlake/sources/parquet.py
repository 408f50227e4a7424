"""Parquet scans with pruning, first-n reads and type narrowing.

Projection and filters are left to Catalyst: ``ReadSchema`` carries only the
selected columns and ``PushedFilters`` the predicates. Narrowing needs one
aggregate pass (min/max of every integer column together); only those scalars
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.operators.rank import random_rank

# Signed integer bounds of the narrow types, in order.
INT_BOUNDS = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647)]
_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def narrow_type(lo, hi) -> str:
    """Narrowest signed integer type holding [lo, hi]; 'bigint' otherwise."""
    if lo is None:
        return "bigint"
    for name, a, b in INT_BOUNDS:
        if lo >= a and hi <= b:
            return name
    return "bigint"


def int_ranges(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A4 + T1 decision as a table: ``(column_name, min, max, narrow_type)``.
    One aggregate over all columns; the type choice is a SQL CASE."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _INT_TYPES)]
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("bigint").alias(f"{c}__min"), F.max(c).cast("bigint").alias(f"{c}__max")]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`" for c in cols)
    long = row.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, min_value, max_value)")
    lo, hi = F.col("min_value"), F.col("max_value")
    t = F.lit("bigint")
    for name, a, b in reversed(INT_BOUNDS):
        t = F.when(lo.isNotNull() & (lo >= a) & (hi <= b), F.lit(name)).otherwise(t)
    return long.withColumn("narrow_type", t)


def narrow_types(df: DataFrame, convert_floats: bool = True, label: str | None = None,
                 mode: str = "narrowest") -> DataFrame:
    """Cast integer columns to the narrowest type that holds their
    range, doubles to float, the label to tinyint.

    ``mode='int32'`` is the unlabelled-side rule (T5): bigint -> int when the
    range fits, nothing narrower (the min check is added to the reference's
    max-only test).
    """
    kinds = (T.LongType,) if mode == "int32" else _INT_TYPES
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name != label]
    casts = {}
    if ints:
        for r in int_ranges(df, ints).collect():      # one small row per column
            t = r["narrow_type"]
            if mode == "int32":
                t = "int" if t != "bigint" else "bigint"
            casts[r["column_name"]] = t
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if label is not None and f.name == label:
            out.append(c.cast("tinyint").alias(f.name))
        elif f.name in casts:
            out.append(c.cast(casts[f.name]).alias(f.name))
        elif convert_floats and isinstance(f.dataType, T.DoubleType):
            out.append(c.cast("float").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def load_labelled(spark: SparkSession, path: str, columns: list[str] | None = None,
                  nrows: int | None = None, order_by: str | None = None,
                  narrow: bool = False, label: str | None = None) -> DataFrame:
    """Pruned scan; optional first ``nrows`` rows in ``order_by`` order (O2),
    optional narrowing (T1-T4)."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if nrows is not None:
        df = df.orderBy(order_by or df.columns[0]).limit(nrows)
    if narrow:
        df = narrow_types(df, label=label)
    elif label is not None:
        df = df.withColumn(label, F.col(label).cast("tinyint"))
    return df


def load_unlabelled(spark: SparkSession, path: str, columns: list[str] | None = None,
                    nrows: int | None = None, order_by: str | None = None) -> DataFrame:
    """As S1 for the unlabelled side; bigint -> int when it fits (T5)."""
    df = load_labelled(spark, path, columns, nrows, order_by)
    return narrow_types(df, convert_floats=False, mode="int32")


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a parquet dataset; the scan reads no column (row-group counts)."""
    return spark.read.parquet(path).groupBy().count().select(F.col("count").cast("bigint").alias("n_rows"))


def dictionary_encode(df: DataFrame, col: str, out: str | None = None, seed: int = 42) -> DataFrame:
    """T3 encoding: a dense integer code per distinct value.

    Codes follow the md5 order of the values (two-level rank over the distinct
    values), so no single task or the driver ever holds the dictionary. The
    dictionary is written once, counted, and broadcast when small (the usual
    case: the column was chosen for its low distinct ratio, and each frequent
    value would otherwise be a hot key of a sort-merge join); a large
    dictionary is joined with a shuffle instead.
    """
    from screenlake.session import checked_broadcast, materialize
    out = out or f"{col}_code"
    dist = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = random_rank(dist, [], col, seed, "__code")
    codes = materialize(codes.select(col, (F.col("__code") - 1).cast("int").alias(out)), "dictionary")
    return df.join(checked_broadcast(codes), col, "left")
