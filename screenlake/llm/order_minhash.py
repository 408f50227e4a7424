"""Order MinHash fingerprints, with DataFrame functions only.

A k-mer is a word with the ``k - 1`` words after it (fewer at the end). Equal k-mers
of a text are numbered by occurrence; (k-mer, number) is hashed. The hash
space is cut into ``bins``; from each bin the ``ell`` smallest elements are taken,
put back in text order and hashed as a tuple. So a bin agrees for two texts only
where both the elements and their order agree: insertions and moves both show,
which makes the share of agreeing bins follow the edit distance.

Everything happens inside the row with array functions: the k-mers are sorted
once by (hash, place) to number the repeats and once by (element hash, place) to
find the smallest of each bin; no row of a document is ever exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.session import materialize

K = 2
ELL = 2
BINS = 32               # a power of two, 64 at most
WORD = r"[^\x20\x09-\x0D]+"
LOW31, LOW32 = "2147483647L", "4294967295L"


def fingerprint_sql(text: str, k: int = K, ell: int = ELL, bins: int = BINS) -> str:
    """SQL of the fingerprint of a text expression: per bin that has elements its number
    and the hash of its tuple (2 and 4 hex digits). A null or empty text has none."""
    shift = 63 - (bins.bit_length() - 1)
    later = "".join(f", get(w, i + {j})" for j in range(1, k))
    kmers = f"transform(w, (x, i) -> shiftleft(xxhash64(x{later}) & {LOW31}, 32) | i)"
    # number of equal k-mers before: the longest step back within the run of equal hashes
    back = ("aggregate(transform(sequence(30, 0), e -> cast(shiftleft(1, e) as int)), 0, (n, d) -> "
            f"if((get(s, i - n - d) ^ v) <= {LOW32}, n + d, n))")
    again = f"shiftleft(xxhash64(shiftright(v, 32), {back}) & {LOW31}, 32) | (v & {LOW32})"
    elements = f"transform(s, (v, i) -> if((get(s, i - 1) ^ v) <= {LOW32}, {again}, v))"
    least = f"filter(e, (v, i) -> (get(e, i - {ell}) ^ v) >= {1 << shift}L or i < {ell})"
    # m holds the elements bin by bin: a bin's tuple starts where the bin changes
    starts = f"filter(sequence(0, size(m) - 1), i -> i = 0 or shiftright(get(m, i), {shift}) <> shiftright(get(m, i - 1), {shift}))"
    in_bin = f"filter(slice(m, i + 1, {ell}), v -> shiftright(v, {shift}) = shiftright(get(m, i), {shift}))"
    in_order = f"sort_array(transform({in_bin}, v -> shiftleft(v & {LOW32}, 31) | shiftright(v, 32)))"
    tuple_hash = f"xxhash64(array_join(transform({in_order}, v -> cast(v & {LOW31} as string)), ','))"
    digits = (f"if(size(m) = 0, cast(array() as array<string>), transform({starts}, i -> lower(concat(lpad(hex(shiftright(get(m, i), {shift})), 2, '0'), "
              f"lpad(hex({tuple_hash} & 65535L), 4, '0')))))")
    words = f"regexp_extract_all(coalesce({text}, ''), r'{WORD}', 0)"
    return (f"transform(array({words}), w -> transform(array(sort_array({kmers})), s -> "
            f"transform(array(sort_array({elements})), e -> transform(array({least}), m -> array_join({digits}, ','))[0])[0])[0])[0]")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among those that are not empty on both sides; 1 for two
    fingerprints without elements."""
    x, y = (F.filter(F.split(c, ","), lambda e: e != "") for c in (a, b))
    used = F.size(F.array_union(*(F.transform(z, lambda e: e.substr(1, 2)) for z in (x, y))))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / used)


def followers(ids: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` over distinct ids in ascending order, nulls first, the
    first again after the last. Ranges of ids are ordered apart; one row per range
    (its least id) tells each range what follows it."""
    ranged = ids.select("doc_id").distinct().repartitionByRange(F.col("doc_id").asc_nulls_first())
    part = materialize(ranged.withColumn("part", F.spark_partition_id()), "omh-ids")
    order = F.col("doc_id").asc_nulls_first()
    one = part.withColumn("next", F.lead(F.struct("doc_id")).over(Window.partitionBy("part").orderBy(order)))
    firsts = part.groupBy("part").agg(F.count(F.when(F.col("doc_id").isNull(), 1)).alias("none"), F.min("doc_id").alias("least"))
    firsts = firsts.withColumn("least", F.when(F.col("none") > 0, None).otherwise(F.col("least")))
    by_part = Window.orderBy("part")
    first = F.first(F.struct(F.col("least").alias("doc_id"))).over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ahead = firsts.withColumn("ahead", F.coalesce(F.lead(F.struct(F.col("least").alias("doc_id"))).over(by_part), first)).select("part", "ahead")
    return one.join(F.broadcast(ahead), "part").select("doc_id", F.coalesce("next", "ahead")["doc_id"].alias("next_id"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with a column ``fingerprint`` of its text."""
    return docs.withColumn("fingerprint", F.expr(fingerprint_sql(f"`{text_col}`", **options)))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Fingerprints of each text, of its edited text (the last quarter replaced by the
    start of the next document), and their likeness; one row per row of ``docs``.

    Null texts count as empty; of several rows with one id the one with the least
    text hash is the "next document" of the id before; an empty table gives an empty
    one; further columns are ignored."""
    key = F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit(""))      # never null: plain joins
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("__k", key)
    need = src.groupBy("__k").agg(F.max(F.floor(F.length("text") / 4)).alias("need"))
    pair = followers(src).withColumn("__k", key).join(need, "__k")
    pair = materialize(pair.select("__k", F.coalesce(F.concat(F.lit("v"), F.col("next_id").cast("string")), F.lit("")).alias("__next_k"), "need"), "omh-next")
    # one exchange of the texts serves both joins, as both read the same columns (doc_id
    # too). First each document hands its start to the one before it: as much as that one replaces
    dealt = src.repartition("__k")
    asked = pair.select(F.col("__next_k").alias("__k"), F.col("__k").alias("__for"), F.col("need").alias("__need"))
    given = dealt.join(asked, "__k")
    given = given.select("__for", F.col("text").substr(F.lit(1), F.col("__need").cast("int")).alias("__start"), F.struct(F.xxhash64("text").alias("h"), F.col("doc_id").alias("of")).alias("__h"))
    given = given.groupBy(F.col("__for").alias("__k")).agg(F.min_by("__start", F.struct("__h", "__start")).alias("__start"))
    edited = dealt.join(given, "__k").withColumn("n_chars", F.length("text").cast("bigint"))
    n, q = F.col("n_chars").cast("int"), F.floor(F.col("n_chars") / 4).cast("int")
    edited = edited.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - q), F.col("__start").substr(F.lit(1), q)))
    done = materialize(edited.select("__k", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("text").alias("__h"),
                                     F.expr(fingerprint_sql("text", **options)).alias("fingerprint"),
                                     F.expr(fingerprint_sql("edited", **options)).alias("edited_fingerprint")), "omh-done")
    after = done.groupBy(F.col("__k").alias("__next_k")).agg(F.min_by("fingerprint", F.struct("__h", "fingerprint")).alias("__next"))
    after = after.join(pair.select("__k", "__next_k"), "__next_k").select("__k", "__next")
    out = done.join(after, "__k")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"))
