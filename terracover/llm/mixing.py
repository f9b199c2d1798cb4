"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a share of a total budget by weight, held below a multiple of its size;
what a capped source cannot take is shared again. A source takes whole epochs first:
every document once per full epoch. The rest is a weighted sample without replacement:
with ``u`` from a hash of the document, documents are taken in ascending order of the
exponential key ``-ln(u) / quality`` and prefix-summed up to the remaining budget.

Shape of the job: sizes and quality come from one pass over the texts (a staged table of
numbers). No source is ever sorted as a whole: keys are cut into ``2 ** 12`` slots per
source by their uniform rank, slots are summed map-side, and only the slot in which the
budget ends is ordered. A source with a third of all rows so leaves about one row in
4,096 of its documents to one task.

Defined results: a null text has size 0. The null source is a source of its own, last in
order. Rows with equal values share a key and are interchangeable. Empty sources get the
target 0. The document at which the budget ends is taken if that brings the source nearer
to its target. Reruns give the same mix. An empty table gives an empty table. Result
columns replace input columns of the same name. Very long texts are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.llm.text import packed, row_key, unpacked, word_array
from terracover.sources.staging import stage

SLOTS = 4096
_UNIT = float(1 << 52)


def word_quality(words: Column) -> Column:
    """Quality weight in [0.5, 1] by the share of distinct words: repetitive documents are drawn less.

    Weights within a factor of two keep the key slots evenly filled.
    """
    share = F.size(F.array_distinct(words)) / F.size(words)
    return F.when(F.size(words) > 0, (share + 1) / 2).otherwise(F.lit(0.5))


def targets(sizes: DataFrame, weights: list[float], total: float, most: float) -> DataFrame:
    """Per source: ``source_size``, ``weight`` and ``target``; ``sizes`` has (source, size).

    ``total`` is the budget as a share of all sizes, ``most`` the largest target as a
    multiple of a source's size. The level at which shares are cut follows from the sorted
    ratios size / weight: sources with small ratios are full, the others share what is left
    by weight. Sources are few; the windows here see one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    every = Window.partitionBy(F.lit(1))
    upto = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Before row i in this order all sources are full: would row i be, too?
    before = F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * most
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    share = (F.sum("source_size").over(every) * total - before) / left_weight
    cut = weighted.withColumn("level", share).withColumn("cap", F.col("source_size") * most)
    cut = cut.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), F.col("level"))))
    return (
        cut.withColumn("first", level.over(every))
        .withColumn("target", F.when(F.col("first").isNull(), F.col("cap").cast("double")).otherwise(
            F.least(F.col("cap").cast("double"), F.col("first.level") * F.col("weight"))
        ))
        .select("source", "source_size", "weight", "target")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0), total: float = 1.5, most: float = 2.0, seed: int = 1,
    quality: Column | None = None,
) -> DataFrame:
    """One row per document: ``key``, id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``quality`` overrides the weight of the exponential keys; null and non-positive weights count
    as the least weight. Apply the mix to the documents with :func:`apply_mix`.
    """
    words = docs.select(
        row_key(docs[id_col], docs[source_col], docs[text_col]).alias("key"),
        docs[id_col].alias("id"), docs[source_col].alias("source"),
        word_array(docs[text_col]).alias("words"),
        *([quality.alias("given")] if quality is not None else []),
    )
    weight = F.col("given").cast("double") if quality is not None else word_quality(F.col("words"))
    sized = stage(
        words.select("key", "id", "source", F.size("words").cast("long").alias("size"), weight.alias("quality")),
        "mix-sizes",
    )
    # 52 bits of the seeded digest, never 0: ln is finite.
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.lower(F.hex("key"))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(_UNIT)
    rate = F.greatest(F.coalesce(F.nanvl("quality", F.lit(0.0)), F.lit(0.0)), F.lit(1e-6))
    plan = stage(
        targets(sized, list(weights), total, most).withColumn(
            "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
        ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets",
    )
    keyed = sized.select(
        "key", "id", "source", "size", (-F.log(uniform) / rate).alias("order"),
        F.least(F.lit(SLOTS - 1), F.floor(-F.expm1(F.log(uniform) / rate) * SLOTS)).cast("int").alias("slot"),
    )
    # Where in each source the remaining budget ends: sums per slot, then a window over slots.
    slots = keyed.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        slots.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .join(plan.select(F.col("source").alias("of"), "rest"), F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select(F.col("of").alias("cut_source"), F.col("slot").alias("cut_slot"), F.col("before").alias("cut_before"))
    )
    per_source = stage(
        plan.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .withColumnRenamed("source", "of").drop("cut_source"), "mix-cuts",
    )
    # One row per source; broadcast only while Spark's own size check allows it.
    met = keyed.join(per_source, F.col("source").eqNullSafe(F.col("of")), "left")
    at_cut = F.col("slot") == F.col("cut_slot")
    ordered = Window.partitionBy("of").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    border = met.where(at_cut).withColumn("upto", F.col("cut_before") + F.sum("size").over(ordered))
    miss_with, miss_without = F.col("upto") - F.col("rest"), F.col("rest") - (F.col("upto") - F.col("size"))
    border = border.withColumn("extra", ((F.col("upto") <= F.col("rest")) | (
        (miss_without > 0) & (miss_with < miss_without)
    )).cast("long"))
    others = met.where(~F.coalesce(at_cut, F.lit(False))).withColumn(
        "extra", F.coalesce((F.col("slot") < F.col("cut_slot")) & (F.col("rest") > 0), F.lit(False)).cast("long")
    )
    both = others.unionByName(border.drop("upto"))
    copies = F.col("epochs") + F.col("extra")
    return both.select(
        "key", F.col("id").alias(id_col), "source", "size", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents repeated as often as the mix takes them; those not taken are left out.

    Rows that share a key can have different numbers of copies at the border of the budget;
    the mix is therefore met by key and by a running number within the key.
    """
    key = row_key(docs[id_col], docs[source_col], docs[text_col])
    source = docs.select(packed(docs).alias("row"), key.alias("key"))
    wanted = mixed.groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    met = source.join(wanted.hint("shuffle_hash"), "key")
    # Equal rows are interchangeable: each gets the same whole part, and a row-free remainder is split by number.
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1)))
    single = met.where("rows = 1").withColumn("n", F.col("copies"))
    several = met.where("rows > 1").withColumn("nth", nth).withColumn(
        "n", F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    ).drop("nth")
    times = single.unionByName(several).where("n > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("copy"))
    return unpacked(times, docs.columns, {})
