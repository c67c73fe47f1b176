"""Mixing sources to target weights. DataFrame functions only.

*Targets.* Sources in code point order (null last) weigh 1, 2, 3, repeating,
and share all words by weight. No target passes ``MAX_REPEATS`` times its
source's size; the excess is shared again by weight among the others. That
fixed point is ``min(cap, level * weight)`` with one common level, found in one
pass over the sources in the order of cap / weight.

*Blocks.* A source's documents are dealt by hash into a power of two of blocks
of about ``BLOCK_DOCS`` documents. A source draws whole passes over all of its
blocks as long as they fit its target, then the first blocks of a permuted
order, and of one last block the documents that still fit, largest first. So a
source takes its target up to less than the smallest document left out there.

*Splitting tree.* The number of blocks that each source draws is its quota.
The root holds all quotas and all shards; a node gives its left half of the
shards its share of the node's blocks, drawn without replacement: the
sources' counts on the left are one draw of the multivariate hypergeometric
distribution, taken source by source by inversion of the conditional
distribution. Leaves are shards with exact quotas. A shard takes disjoint runs
of the permuted blocks of each source, and puts its documents in hash order.

Randomness is a hash of the seed and what is drawn, so reruns agree. Only the
count of shards reaches the driver; a source's blocks meet only as sums.

Defined cases: a null, empty or blank text has size 0 and is taken 0 words; a
source of size 0 has target 0. Rows that repeat a document id within a source
are drawn together, each as often as the others. Texts of any length are counted
whole. Other columns stay as they are. Empty table: empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from .common import column, cut, free

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
BLOCK_DOCS = 64
#: Prefix sums over blocks run over this many sums of neighbours first.
COARSE_BITS = 12
SHARD_WORDS = 1_000_000


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, rank, source_size, n_docs, target)`` of a table of
    ``(source, doc_id, size)``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
    # One row for each source; these windows are over sources, not documents.
    rank = F.row_number().over(Wd.orderBy(F.col("source").asc_nulls_last()))
    per = (per.withColumn("rank", rank.cast("long"))
           .withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double"))
           .withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast("double")))
    by = Wd.orderBy((F.col("cap") / F.col("weight")), "rank")
    so_far = by.rowsBetween(Wd.unboundedPreceding, -1)
    every = Wd.partitionBy(F.lit(0))
    # The level if exactly the sources before this one are at their caps.
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(so_far), F.lit(0.0))))
    return (per.withColumn("level", level)
            # The first source, in that order, that such a level leaves under its cap.
            .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
                F.col("cap") / F.col("weight"), "rank", "level"))).over(every)["level"])
            .select("source", "rank", "source_size", "n_docs",
                    F.least("cap", F.col("level") * F.col("weight")).alias("target")))


# -- blocks -----------------------------------------------------------------

def _permuted(block: str, bits: str, mask: str, *salt: str) -> str:
    """SQL of a permutation of 0..mask: odd multiples and shifted xors modulo
    a power of two are one to one."""
    p = block
    for turn in range(3):
        key = f"xxhash64({turn}, {', '.join(salt)})"
        # 31 bits of odd factor: the product of two such numbers fits a long.
        p = f"(({p}) * (({key} & 1073741823) * 2 + 1) + (shiftright({key}, 31) & 1073741823)) & {mask}"
        p = f"transform(array({p}), p -> p ^ shiftright(p, cast(({bits} + 1) / 2 AS int)))[0]"
    return f"({p}) & {mask}"


def _plan(per: DataFrame, units: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """The sources with their block counts and quotas, and the units (one for
    each document id of a source) with their block; both cut."""
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / BLOCK_DOCS))).cast("int")
    words = F.round("target").cast("long")
    per = (per.withColumn("bits", bits).withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))
           .withColumn("passes", F.expr("if(source_size = 0, 0L, cast(round(target) AS bigint) div source_size)"))
           .withColumn("rest", words - F.col("passes") * F.col("source_size")))
    units = units.join(per.select("source", "rank", "bits", "mask", "passes", "rest"),
                       units.source.eqNullSafe(per.source)).drop(per.source)
    units = cut(units.withColumn("block", F.expr(f"xxhash64({seed}, rank, doc_id) & mask"))
                .withColumn("at", F.expr(_permuted("block", "bits", "mask", str(seed), "rank", "passes")))
                .select("rank", "doc_id", "size", "bits", "mask", "passes", "rest", "block", "at"))

    # Where the last pass ends: coarse runs of blocks, then blocks, by prefix sums.
    coarse = F.expr(f"shiftright(at, greatest(0, bits - {COARSE_BITS}))")
    blocks = units.withColumn("run", coarse).groupBy("rank", "run", "at", "rest").agg(F.sum("size").alias("size"))
    blocks = cut(blocks)
    runs = blocks.groupBy("rank", "run", "rest").agg(F.sum("size").alias("size"))
    before = Wd.partitionBy("rank").orderBy("run").rowsBetween(Wd.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))
    # The first run that reaches past the rest holds the last block.
    last_run = (runs.filter("before + size > rest").groupBy("rank")
                .agg(F.min(F.struct("run", "before")).alias("m")).select("rank", "m.run", "m.before"))
    before = Wd.partitionBy("rank").orderBy("at").rowsBetween(Wd.unboundedPreceding, -1)
    inside = (blocks.join(last_run, ["rank", "run"])
              .withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long")))
    last = (inside.filter("before + size > rest").groupBy("rank")
            .agg(F.min(F.struct("at", F.expr("rest - before").alias("left"))).alias("m"))
            .select("rank", F.col("m.at").alias("last"), "m.left"))
    per = cut(per.join(last, "rank", "left")
              .withColumn("last", F.coalesce("last", F.lit(0)).cast("long"))
              .withColumn("left", F.coalesce("left", F.lit(0)).cast("long"))
              .withColumn("quota", F.expr("passes * (mask + 1) + last + if(left > 0, 1, 0)")))
    return per, units


def _last_block(per: DataFrame, units: DataFrame) -> DataFrame:
    """``(rank, doc_id)`` taken of each source's last block: largest first, as
    long as they fit."""
    held = (units.join(per.filter("left > 0").select("rank", F.col("last").alias("at"), "left"), ["rank", "at"])
            .filter("size > 0").groupBy("rank", "left")
            .agg(F.sort_array(F.collect_list(F.struct("size", "doc_id")), asc=False).alias("docs")))
    taken = F.expr(
        "aggregate(docs, named_struct('left', left, 'ids', filter(transform(docs, d -> d.doc_id), x -> false)), "
        "(a, d) -> if(d.size <= a.left, named_struct('left', a.left - d.size, 'ids', concat(a.ids, array(d.doc_id))), a), "
        "a -> a.ids)")
    return held.select("rank", F.explode(taken).alias("doc_id"))


# -- the splitting tree -----------------------------------------------------

def _hypergeometric(population: str, good: str, draws: str, uniform: str) -> str:
    """SQL of one draw: of ``draws`` from ``population`` without replacement,
    how many are among ``good``. The mass within 12 deviations of the mode is
    summed by its recurrence, then inverted at ``uniform``."""
    spread = (f"cast(12 * sqrt(cast({draws} AS double) * {good} / greatest({population}, 1L) "
              f"* (1 - cast({good} AS double) / greatest({population}, 1L)) "
              f"* (cast({population} AS double) - {draws}) / greatest({population} - 1, 1L)) AS bigint) + 12")
    mode = f"cast((cast({draws} AS double) + 1) * ({good} + 1) / ({population} + 2) AS bigint)"
    low = f"greatest(0L, {draws} - ({population} - {good}), {mode} - ({spread}))"
    high = f"least({draws}, {good}, {mode} + ({spread}))"
    step = (f"h.w * cast({good} - x AS double) * ({draws} - x) / "
            f"(cast(x + 1 AS double) * ({population} - {good} - {draws} + x + 1))")
    return (f"transform(array(named_struct('low', {low}, 'high', greatest({low}, {high}))), r -> "
            f"transform(array(aggregate(sequence(r.low, r.high), named_struct('w', 1D, 'sum', 0D), "
            f"(h, x) -> named_struct('w', {step}, 'sum', h.sum + h.w), h -> h.sum)), total -> "
            f"aggregate(sequence(r.low, r.high), named_struct('w', 1D, 'sum', 0D, 'pick', r.high, 'done', false), "
            f"(h, x) -> if(h.done, h, named_struct('w', {step}, 'sum', h.sum + h.w, "
            f"'pick', x, 'done', h.sum + h.w >= {uniform} * total)), h -> h.pick))[0])[0]")


def split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(shard, rank, quota)``: the quotas of ``(rank, quota)`` dealt out to
    ``shards``, every shard with the same number of blocks (or one more)."""
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(
        F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("n"), "q")
    uniform = f"((xxhash64({seed}, first, n, s.rank) & 9007199254740991) + 0.5D) / 9007199254740992D"
    drawn = _hypergeometric("a.population", "s.quota", "a.draws", uniform)
    left = (f"aggregate(q, named_struct('population', total, 'draws', draws, 'out', filter(q, s -> false)), "
            f"(a, s) -> transform(array({drawn}), k -> named_struct('population', a.population - s.quota, "
            f"'draws', a.draws - k, 'out', concat(a.out, array(named_struct('rank', s.rank, 'quota', k)))))[0], "
            f"a -> a.out)")
    width = 1
    while width < shards:
        node = (node.withColumn("total", F.expr("aggregate(q, 0L, (a, s) -> a + s.quota)"))
                .withColumn("half", F.expr("n div 2"))
                .withColumn("draws", F.expr("cast(floor(cast(total AS decimal(38,0)) * half / n) AS bigint)"))
                .withColumn("lq", F.expr(f"if(n > 1, {left}, q)")))
        children = F.expr(
            "if(n > 1, array(named_struct('first', first, 'n', half, 'q', lq), "
            "named_struct('first', first + half, 'n', n - half, 'q', "
            "transform(q, (s, i) -> named_struct('rank', s.rank, 'quota', s.quota - lq[i].quota)))), "
            "array(named_struct('first', first, 'n', n, 'q', q)))")
        node = node.select(F.explode(children).alias("c")).select("c.*")
        width *= 2
        if width == 64:  # enough nodes to go on with in many tasks
            node = node.repartition(F.col("first"))
    return node.select(F.col("first").alias("shard"), F.explode("q").alias("s")).select(
        "shard", "s.rank", "s.quota").filter("quota > 0")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        shard_words: int = SHARD_WORDS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix and the table it was drawn from.

    The first frame has a row for each draw: ``shard``, ``position`` in it,
    ``doc_id``, ``rank`` of its source, ``copy`` (0 for the first pass) and
    ``size``. The second has a row for each row of ``docs``: ``doc_id``,
    ``source``, ``size``, ``rank``, ``source_size``, ``target``.
    """
    sizes = cut(docs.select(column(doc_id).alias("doc_id"), column(source).alias("source"),
                            size_of(column(text)).alias("size")))
    per = cut(targets(sizes))
    units = sizes.groupBy("source", "doc_id").agg(F.sum("size").alias("size"))
    counted, units = _plan(per, units, seed)
    total = counted.agg(F.sum("target")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))

    leaves = cut(split(counted.select("rank", "quota"), shards, seed))
    run = Wd.partitionBy("rank").orderBy("shard").rowsBetween(Wd.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("quota").over(run), F.lit(0)).cast("long")
    slots = (leaves.withColumn("begin", begin)
             .select("shard", "rank", F.explode(F.expr("sequence(begin, begin + quota - 1)")).alias("slot")))

    chosen = _last_block(counted, units).withColumn("chosen", F.lit(True))
    placed = units.join(counted.select("rank", "last"), "rank").join(chosen, ["rank", "doc_id"], "left")
    # Whole passes, and the part of the last one that this document is in.
    copies = F.expr("if(at < last or coalesce(chosen, false), passes, passes - 1)")
    draws = (placed.withColumn("copies", copies).filter("copies >= 0 and size > 0")
             .select("*", F.explode(F.expr("sequence(0L, copies)")).alias("copy"))
             .withColumn("slot", F.expr(
                 f"copy * (mask + 1) + if(copy = passes, at, "
                 f"{_permuted('block', 'bits', 'mask', str(seed), 'rank', 'copy')})")))
    order = Wd.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "rank", "doc_id", "copy"),
                                            "rank", "doc_id", "copy")
    mixed = (draws.join(slots, ["rank", "slot"])
             .select("shard", F.row_number().over(order).alias("position"), "doc_id", "rank",
                     F.col("copy").cast("int").alias("copy"), "size"))
    rows = sizes.join(per.select(F.col("source").alias("_source"), "rank", "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return mixed, rows


def taken(docs: DataFrame, **how) -> DataFrame:
    """The digest columns: how many words the mix takes of every document."""
    mixed, rows = mix(docs, **how)
    drawn = mixed.groupBy("rank", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    drawn = drawn.withColumnRenamed("doc_id", "_id")
    return (rows.join(drawn, (rows["rank"] == drawn["rank"]) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken"), "source"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """The documents of the mix, once for each draw of their source, with
    ``shard``, ``position`` and ``copy``. A null id or source is one like any
    other; rows that repeat an id within a source share their draws. Columns of
    ``docs`` keep their names: where it has one of these three, the new one
    begins with ``mix_``."""
    mixed, rows = mix(docs, doc_id=doc_id, source=source, **how)
    drawn = (mixed.join(rows.select("rank", F.col("source").alias("_source")).distinct(), "rank")
             .select(F.struct(F.col("doc_id").alias("id"), F.col("_source").alias("source")).alias("of"),
                     "shard", "position", "copy"))
    key, other = free(docs, "drawn_row"), free(docs, "drawn_of")
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("shard", "position", "copy"):
        while name in taken:
            name = f"mix_{name}"
        names.append(name)
    keyed = docs.withColumn(key, F.struct(column(doc_id).alias("id"), column(source).alias("source")))
    return (keyed.join(drawn.toDF(other, *names), F.col(key).eqNullSafe(F.col(other)))
            .select(*map(column, [*docs.columns, *names])))
