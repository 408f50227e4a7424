"""Mixing sources to target weights, with DataFrame operations only.

Targets: sources in code-point order weigh 5, 2, 1 in turn and share all words;
a target stops at ``MAX_EPOCHS`` times its source, the rest is shared by weight
among the others. That is one water level L with target = min(cap, L * weight),
read off running sums over the sources sorted by cap / weight.

Blocks: each source is dealt by a hash of the document into ``blocks`` blocks. A
source takes whole epochs of all its blocks, then further blocks in a permuted
order up to its target; only inside the one block where the target falls are
documents ordered and counted. So ordering work covers 1 / blocks of the rows,
and a hot source is spread over all its blocks.

Splitting tree: how many of a source's block copies go to which output shard is
drawn from the multivariate hypergeometric distribution, halving the shards at
each level: a node with quota vector K and total n sends exactly half to the left,
the sources drawn one after another from their conditional hypergeometric
distributions (inverse CDF over a hash of node and source). Every shard then owns
disjoint runs of each source's permuted blocks, and its documents are put in the
order of a hash. All draws are hashes of names, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.names import column, free
from screenlake.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCKS = 256
BLOCK_DOCS = 64         # documents of a block that are worth a block of its own
LEVELS = 4              # 2**LEVELS output shards at least
SHARD_WORDS = 1 << 23   # words of a shard, beyond that there are more shards
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, source_size)``, one row
    per source. The windows below see one row per source, never documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    s = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1))
    s = s.withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # sources before the first one whose cap lies above the level are full
    s = s.withColumn("free", F.col("level") < F.col("cap") / F.col("w"))
    level = F.min(F.struct(F.when(F.col("free"), F.col("cap") / F.col("w")).otherwise(float("inf")), F.col("source").isNull(), "source", "level")).over(Window.partitionBy())
    s = s.withColumn("water", F.when(F.max("free").over(Window.partitionBy()), level["level"]).otherwise(float("inf")))
    return s.select("source", "source_size", F.when(F.col("cap") <= 0, 0.0).otherwise(F.least("cap", F.col("water") * F.col("w"))).alias("target"))


def hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL for the number of marked among ``drawn`` of ``total``, by inverse CDF. The
    weights come from the ratio of neighbouring terms, in logarithms against the largest."""
    lo, hi = f"greatest(0, {drawn} - ({total} - {marked}))", f"least({marked}, {drawn})"
    step = (f"ln(cast(greatest(1, ({marked} - k + 1) * ({drawn} - k + 1)) as double) / "
            f"greatest(1, k * ({total} - {marked} - {drawn} + k)))")
    logs = (f"aggregate(sequence({lo}, {hi}), cast(array() as array<double>), "
            f"(ls, k) -> concat(ls, array(if(k = {lo}, 0D, ls[size(ls) - 1] + {step}))))")
    pick = (f"aggregate(ws, named_struct('c', 0D, 'i', 0), (st, wt) -> named_struct('c', st.c + wt, "
            f"'i', st.i + if(st.c + wt < uz, 1, 0)), st -> st.i)")
    return (f"transform(array({logs}), lw -> transform(array(transform(lw, l1 -> exp(l1 - array_max(lw)))), ws -> "
            f"transform(array({u} * aggregate(ws, 0D, (t1, t2) -> t1 + t2)), uz -> {lo} + least({hi} - {lo}, {pick}))[0])[0])[0]")


def _uniform(*cols: str) -> str:
    return f"(cast(shiftrightunsigned(xxhash64({', '.join(cols)}), 11) as double) / 9007199254740992D)"


def split_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(source, shard, quota)`` from ``quotas (source, quota)``: the splitting tree.
    The table stays at sources x nodes rows; every level is one grouping by node."""
    node = quotas.select(F.lit(1).alias("node"), "source", F.col("quota").cast("int").alias("quota"))
    for _ in range(levels):
        packed = node.groupBy("node").agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "quota"))).alias("s"))
        packed = packed.withColumn("n", F.expr("aggregate(s, 0, (a, x) -> a + x.quota)"))
        # half of the node's copies go left; an odd one by a hash
        packed = packed.withColumn("left", F.expr("cast(n div 2 + if(n % 2 = 1, pmod(xxhash64('odd', node), 2), 0) as int)"))
        draw = hypergeometric("a.total", "x.quota", "a.left", _uniform("'draw'", "node", "x.source", "x.none"))
        packed = packed.withColumn("got", F.expr(
            "aggregate(s, named_struct('total', n, 'left', left, 'all', cast(array() as array<int>)), "
            f"(a, x) -> transform(array({draw}), d -> named_struct('total', a.total - x.quota, 'left', a.left - d, 'all', concat(a.all, array(d))))[0], a -> a.all)"))
        both = packed.select("node", F.explode(F.arrays_zip("s", "got")).alias("z"))
        node = (both.select("node", "z.s.source", "z.s.quota", F.col("z.got").alias("l"))
                .select("source", F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("l").alias("quota")),
                                                    F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("quota") - F.col("l")).alias("quota")))).alias("c"))
                .select("c.node", "source", "c.quota"))
    return node.select("source", (F.col("node") - (1 << levels)).alias("shard"), "quota")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def tree_levels(words: int) -> int:
    """Levels of the splitting tree for so many words."""
    return max(LEVELS, (max(words, 1) // SHARD_WORDS).bit_length())


def plan_mix(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, blocks: int = BLOCKS, levels: int | None = None) -> DataFrame:
    """``rows (doc_id, source, size, h, block)`` with ``source_size``, ``target`` and
    ``copies``, an array with (epoch, shard) of each time the mix takes the document."""
    fine = rows.groupBy("source", "block").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    # a small source joins neighbouring blocks until a block has about BLOCK_DOCS documents
    every = F.sum("docs").over(Window.partitionBy("source"))
    n = F.least(F.lit(blocks), F.greatest(F.lit(1), F.floor(every / BLOCK_DOCS)))
    fine = materialize(fine.withColumn("wide", F.floor(F.col("block") * n / blocks).cast("int")), "mix-fine")
    per_block = fine.groupBy("source", F.col("wide").alias("block")).agg(F.sum("words").alias("words"))
    target = materialize(source_targets(per_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs), "mix-targets")
    if levels is None:
        levels = tree_levels(target.agg(F.sum("source_size")).first()[0] or 0)
    t = target.select(F.col("source").alias("src"), "source_size", "target")
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    t = t.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    b = per_block.join(t, _same("source", "src")).drop("src")
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit("block"), "source", "block"), "block")
    b = b.withColumn("rank", F.row_number().over(permuted)).withColumn("end", F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0)))
    b = b.withColumn("room", F.col("rest") - (F.col("end") - F.col("words")))     # words of the target left when the block is reached
    b = b.withColumn("part", F.when(F.col("end") <= F.col("rest"), 1.0).when(F.col("room") > 0, 0.5).otherwise(0.0))
    b = b.withColumn("times", F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0))
    b = materialize(b, "mix-plan")
    # block copies of a source, numbered epoch by epoch in permuted order; shards own runs of them
    runs = split_quotas(b.groupBy("source").agg(F.sum("times").alias("quota")), levels)
    upto = Window.partitionBy("source").orderBy(F.xxhash64(F.lit("shard"), "source", "shard"), "shard").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("stop", F.sum("quota").over(upto)).filter("quota > 0")
    runs = runs.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("stop", "shard"))).alias("runs")).withColumnRenamed("source", "src")
    copies = b.groupBy("source").agg(F.count(F.lit(1)).alias("n_blocks")).withColumnRenamed("source", "src2")
    b = b.join(runs, _same("source", "src"), "left").join(copies, _same("source", "src2"))
    b = b.withColumn("copies", F.expr(
        "transform(if(times > 0, sequence(0, times - 1), cast(array() as array<int>)), e -> named_struct('epoch', e, 'shard', "
        "filter(runs, r -> r.stop >= e * n_blocks + rank)[0].shard))"))
    b = b.select(F.col("source").alias("src"), F.col("block").alias("blk"), "source_size", "target", "copies", "epochs", "part", "room")
    b = fine.join(b, _same("source", "src") & (F.col("wide") == F.col("blk"))).drop("source", "blk", "words", "docs").withColumnRenamed("block", "blk")
    b = materialize(b, "mix-placed")
    near = rows.join(b, _same("source", "src") & (F.col("block") == F.col("blk")))
    whole = near.filter("part <> 0.5")
    # the block in which a target falls: documents in permuted order while they fit, then
    # the smallest of the others while they bring it nearer; repeated rows go alike
    inside = Window.partitionBy("source", "wide")
    permuted = inside.orderBy("h", "doc_id", "size").rangeBetween(Window.unboundedPreceding, 0)
    cut = near.filter("part = 0.5").withColumn("fits", F.sum("size").over(permuted) <= F.col("room"))
    cut = cut.withColumn("room", F.col("room") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))).over(inside), F.lit(0)))
    smallest = inside.orderBy("fits", "size", "h", "doc_id").rangeBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("fits", F.col("fits") | (F.sum("size").over(smallest) - F.col("size") / 2 <= F.col("room")))
    cut = cut.withColumn("copies", F.expr("if(fits, copies, slice(copies, 1, epochs))")).drop("fits")
    return whole.union(cut).drop("src", "blk", "wide", "epochs", "part", "room")


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = BLOCKS) -> DataFrame:
    h = F.xxhash64(F.lit("mix"), F.col(id_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), h.alias("h"))
    return rows.withColumn("block", F.pmod("h", F.lit(blocks)).cast("int"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)``, one row per row of
    ``docs``. Null and empty texts have size 0; null sources are one source, sorted
    last; rows with one doc_id share a block; an empty table gives no rows; further
    columns are ignored."""
    rows = materialize(mix_rows(docs, id_col, text_col, source_col, options.get("blocks", BLOCKS)), "mix-rows")
    return plan_mix(rows, **options).select("doc_id", "source", "size", "source_size", "target", "copies")


def copy_order(shard, epoch, doc_id):
    """Place of a copy in its shard: the local shuffle."""
    return F.xxhash64(F.lit("order"), shard, epoch, doc_id.cast("string"))


def taken(plan: DataFrame) -> DataFrame:
    """Digest of a plan: ``taken`` counts the copies that the tree has put into shards;
    ``mix_shard`` and ``mix_order`` list the shard of each copy and its place there."""
    placed = F.filter("copies", lambda c: c.shard.isNotNull())
    plan = plan.withColumn("copies", placed)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("copies")).cast("bigint").alias("taken"),
                       F.array_join(F.transform("copies", lambda c: c.shard.cast("string")), ",").alias("mix_shard"),
                       F.array_join(F.transform("copies", lambda c: copy_order(c.shard, c.epoch, F.col("doc_id")).cast("string")), ",").alias("mix_order"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it, with
    ``mix_shard`` and ``mix_order`` (with underscores in front where ``docs`` has such
    columns; sort by it within a shard: the local shuffle)."""
    plan = mix_plan(docs, id_col, text_col, source_col, **options)
    key, size, src, at, n, shard, order = free(docs, "__id", "__size", "__src", "__c", "__n", "mix_shard", "mix_order")
    # rows of one id have one hash and block; they may differ in the cut block, so match on the size too
    place = plan.select(F.col("doc_id").alias(key), F.col("size").alias(size), F.col("source").alias(src), F.explode("copies").alias(at))
    place = place.groupBy(key, size, src, at).agg(F.count(F.lit(1)).alias(n))
    out = docs.join(place, column(id_col).eqNullSafe(F.col(key)) & (word_count(text_col) == F.col(size)) & column(source_col).eqNullSafe(F.col(src)))
    return (out.withColumn(shard, F.col(f"{at}.shard")).withColumn(order, copy_order(F.col(shard), F.col(f"{at}.epoch"), column(id_col)))
            .drop(key, size, src, at, n))


def mixed_in_order(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``, its rows shard by shard in their shuffled
    order: ranges of (shard, order), so that no task holds more than its part of a shard."""
    out = mix(docs, **options)
    shard, order = out.columns[-2:]
    return out.repartitionByRange(shard, order).sortWithinPartitions(shard, order).select(*[column(c) for c in docs.columns])
