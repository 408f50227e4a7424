"""Order of a whole table without one large sort: ranges of bounded size.

Equal-width buckets of a key fill unevenly: one outlier puts every other key into one
bucket, and scores that cluster near zero share a bucket. Here the borders come from the
data. ``range_numbered`` deals a table into ranges by Spark's range partitioner, whose
borders are quantiles of a sample of the keys, whatever orderable type they have. Each
range is sorted and its rows are numbered as it is written; a row count per range (one
row each) shows that no range is larger than ``limit``, else the table is dealt again
into more ranges. What lies before a range is a prefix sum over that small table.

* ``positions``: row numbers over the table or inside groups; one shuffle, no window.
* ``cumulate``: running sums inside groups along a key; a window per bounded range.
* ``nth_key``: the n-th smallest key by repeated counting in ranges between sampled
  borders; no row is shuffled.

The numbered table is written to the shared folder, so the ranges stay what they are when
an executor is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.session import materialize

ROWS_PER_RANGE = 1 << 18    # rows that one task may sort; a smaller table is one range
BORDERS = 63            # borders of one counting pass of nth_key
SAMPLED = 2048          # keys the driver sees to choose them

RANGE, ROW = "__sl_range", "__sl_row"


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on same-named columns with ``<=>`` (null groups match null groups)."""
    if not cols:
        raise ValueError("join_null_safe needs at least one key column")
    r = right
    for c in cols:
        r = r.withColumnRenamed(c, f"__r_{c}")
    cond = reduce(lambda a, b: a & b,
                  [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols])
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{c}" for c in cols])


def range_numbered(df: DataFrame, order: list[str], limit: int = ROWS_PER_RANGE, descending: bool = False,
                   name: str = "ranges") -> tuple[DataFrame, DataFrame | None]:
    """``df`` written in ranges of the ``order`` columns, with the range's number and the row's
    number inside it (from 0); and ``(range, n)``. No range has more than ``limit`` rows unless
    equal keys do (they stay together). A table of ``limit / 2`` rows or fewer is one range,
    which is not written (second result: None)."""
    by = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    n = max(1, -(-2 * df.count() // limit))
    if n == 1:      # one range of bounded size: nothing to deal out, nothing to write
        return df.withColumn(RANGE, F.lit(0)).withColumn(ROW, F.row_number().over(Window.orderBy(*by)).cast("bigint") - 1), None
    while True:
        dealt = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(RANGE, F.monotonically_increasing_id())
        dealt = dealt.withColumn(ROW, F.col(RANGE).bitwiseAND((1 << 33) - 1)).withColumn(RANGE, F.shiftright(RANGE, 33))
        rows = materialize(dealt, name)
        sizes = rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= limit:
            return rows, sizes
        # a range of one key cannot be split; any other that is too large can
        over = rows.join(sizes.where(F.col("n") > limit), RANGE, "left_semi")
        if over.groupBy(RANGE).agg(F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi")).where("lo < hi").isEmpty():
            return rows, sizes
        n *= 4


def _before(sizes: DataFrame, value: str, by: list[str], out: str) -> DataFrame:
    """Sum of ``value`` over the ranges before each range; the window sees a row per range."""
    w = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sizes.withColumn(out, F.sum(value).over(w) - F.col(value))


def positions(df: DataFrame, key: str, out: str = "pos", partition_by: list[str] | tuple = (), limit: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` with the 1-based position of each row in ascending order of ``key`` (of any
    orderable type, nulls first), overall or inside each group. Rows of equal keys get
    different positions in an order that is fixed once written."""
    parts = list(partition_by)
    rows, sizes = range_numbered(df, parts + [key], limit, name="positions")
    if sizes is None:
        rows = rows.withColumn("__before", F.lit(0))
    else:
        rows = rows.join(_before(sizes, "n", [], "__before").select(RANGE, "__before"), RANGE)
    placed = rows.withColumn(out, (F.col("__before") + F.col(ROW) + 1).cast("bigint")).drop(RANGE, ROW, "__before")
    if not parts:
        return placed
    start = placed.groupBy(*parts).agg((F.min(out) - 1).alias("__start"))
    return join_null_safe(placed, start, parts).withColumn(out, F.col(out) - F.col("__start")).drop("__start")


def cumulate(df: DataFrame, group: list[str], key: str, cols: list[str], descending: bool = False, limit: int = ROWS_PER_RANGE,
             prefix: str = "cum_") -> DataFrame:
    """``df`` (one row per group and key) with ``cum_<c>``, the sum of ``c`` over the rows up
    to and including this one along ``key`` inside its group."""
    order = F.col(key).desc() if descending else F.col(key).asc()
    rows, sizes = range_numbered(df, [*group, key], limit, descending, name="cumulated")
    if sizes is None:
        inside = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({f"{prefix}{c}": F.sum(c).over(inside) for c in cols})
    rows = rows.drop(ROW)
    sums = rows.groupBy(*group, RANGE).agg(*[F.sum(c).alias(f"__b_{c}") for c in cols])
    for c in cols:
        sums = _before(sums, f"__b_{c}", group, f"__before_{c}")
    rows = join_null_safe(rows, sums.select(*group, RANGE, *[f"__before_{c}" for c in cols]), [*group, RANGE])
    inside = Window.partitionBy(*group, RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in cols:
        rows = rows.withColumn(f"{prefix}{c}", F.col(f"__before_{c}") + F.sum(c).over(inside))
    return rows.drop(RANGE, *[f"__before_{c}" for c in cols])


def bucket_of(key: Column, borders: list) -> Column:
    """How many of the ascending ``borders`` are at most ``key``: a tree of comparisons, which
    the JVM compiles, for any orderable type."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(borders[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(borders))


def nth_key(df: DataFrame, key: str, n: int, seed: int = 42):
    """The ``n``-th smallest non-null value of ``key`` (1-based, repeats counted); the
    largest if there are fewer, None if there is none. Each pass counts the rows between a
    few sampled borders with map-side sums and goes on inside the range that holds the
    n-th; borders are literals, so the scan can skip files and row groups outside."""
    values = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    total = values.count()
    if total == 0:
        return None
    n = min(max(1, n), total)
    while True:
        if total <= SAMPLED:                 # few rows are left: sort them
            return values.orderBy("k").limit(n).agg(F.max("k")).first()[0]
        sample = sorted(r.k for r in values.sample(SAMPLED / total, seed).limit(4 * SAMPLED).collect())
        if not sample:
            seed += 1
            continue
        borders = sorted({sample[len(sample) * i // (BORDERS + 1)] for i in range(1, BORDERS + 1)})
        counts = dict(values.groupBy(bucket_of(F.col("k"), borders).alias("b")).count().collect())
        b, seen = 0, 0
        while seen + counts.get(b, 0) < n:
            seen += counts.get(b, 0)
            b += 1
        n -= seen
        inside = values
        if b > 0:
            inside = inside.where(F.col("k") >= F.lit(borders[b - 1]))
        if b < len(borders):
            inside = inside.where(F.col("k") < F.lit(borders[b]))
        if counts[b] == total:               # all keys lie between two borders: split at the least
            least = values.agg(F.min("k")).first()[0]
            same = values.where(F.col("k") == F.lit(least)).count()
            if n <= same:
                return least
            n, inside, counts[b] = n - same, values.where(F.col("k") > F.lit(least)), total - same
        values, total, seed = inside, counts[b], seed + 1
