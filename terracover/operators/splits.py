"""Reproducible splits and resampling by hash rank.

A row's place depends on its key and the seed only, never on file layout. Ranks within a
class are cut without sorting the class: digests are counted in 2**20 buckets, the
bucket holding each cut is found on the running counts, and only the rows of those few
buckets are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.functions.hashing import digest_bucket, key_digest, unit_interval
from terracover.operators.joins import lookup_join, null_safe_join
from terracover.operators.ranking import running_totals
from terracover.sources.staging import stage

SEED = 42
BUCKET_DIGITS = 5


def hash_split(
    df: DataFrame, keys, test: float = 0.15, val: float = 0.15, seed: int = SEED, name: str = "split"
) -> DataFrame:
    """Independent train/val/test assignment per row from the hash of its key."""
    u = unit_interval(key_digest(seed, *keys))
    train_end, val_end = 1.0 - test - val, 1.0 - test
    return df.withColumn(
        name, F.when(u < train_end, "train").when(u < val_end, "val").otherwise("test")
    )


def rank_slots(df: DataFrame, group: str, keys, ends: DataFrame, end_columns, seed: int = SEED) -> DataFrame:
    """Add ``slot``: how many of the group's rank limits the row's hash rank has reached.

    ``ends`` has one row per group with ascending zero-based limits in ``end_columns``. NULL
    is a group of its own. Running counts see at most 2**20 buckets per group.
    """
    marked = df.withColumn("digest", key_digest(seed, *keys)).withColumn(
        "bucket", digest_bucket(F.col("digest"), BUCKET_DIGITS)
    )
    counts = marked.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("rows"))
    totals = running_totals(counts, [group], "bucket", ["rows"], bounded=True)
    before = F.col("cum_rows") - F.col("rows")
    picks = []
    for i, end in enumerate(end_columns):
        holds = (before <= F.col(end)) & (F.col(end) < F.col("cum_rows"))
        picks.append(F.max(F.when(holds, F.col("bucket"))).alias(f"cut_{i}"))
        picks.append(F.max(F.when(holds, F.col(end) - before)).alias(f"rest_{i}"))
    cuts = stage(null_safe_join(totals, ends.select(group, *end_columns), group).groupBy(group).agg(*picks), "cuts")

    joined = lookup_join(marked, cuts, group, null_safe=True)
    on_cut = F.lit(False)
    for i in range(len(end_columns)):
        on_cut = on_cut | F.coalesce(F.col("bucket") == F.col(f"cut_{i}"), F.lit(False))

    def slot(rank: Column) -> Column:
        reached = F.lit(0)
        for i in range(len(end_columns)):
            past = (F.col("bucket") > F.col(f"cut_{i}")) | (
                (F.col("bucket") == F.col(f"cut_{i}")) & (rank >= F.col(f"rest_{i}"))
            )
            reached = reached + F.when(past, 1).otherwise(0)
        return reached.cast("int")

    in_bucket = Window.partitionBy(group, "bucket").orderBy("digest", *keys)
    sure = joined.where(~on_cut).withColumn("slot", slot(F.lit(0)))
    ranked = (
        joined.where(on_cut)
        .withColumn("rank", F.row_number().over(in_bucket) - 1)
        .withColumn("slot", slot(F.col("rank")))
    )
    columns = [*df.columns, "slot"]
    return sure.select(*columns).unionByName(ranked.select(*columns))


def _apportion(sizes: DataFrame, label: str, pool: str, fraction: float, name: str) -> DataFrame:
    """Largest-remainder share of ``ceil(total * fraction)`` per class (exact integers)."""
    classes = Window.partitionBy()  # one row per class
    table = sizes.withColumn("all", F.sum(pool).over(classes)).withColumn(
        "goal", F.ceil(F.col("all") * F.lit(fraction) - F.lit(1e-9)).cast("bigint")
    )
    exact = F.col(pool) * F.col("goal")
    table = table.withColumns(
        {"base": F.floor(exact / F.col("all")).cast("bigint"), "rest": (exact % F.col("all")).cast("bigint")}
    )
    order = Window.partitionBy().orderBy(F.col("rest").desc(), F.col(label))
    table = table.withColumn("left", F.col("goal") - F.sum("base").over(classes)).withColumn(
        "place", F.row_number().over(order)
    )
    return table.withColumn(
        name, F.col("base") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)
    ).drop("all", "goal", "base", "rest", "left", "place")


def stratified_sizes(df: DataFrame, label: str, test: float, val_of_rest: float) -> DataFrame:
    """Rows per class and the test and validation rows each class gives."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    sizes = _apportion(sizes, label, "n", test, "n_test")
    sizes = _apportion(sizes.withColumn("n_rest", F.col("n") - F.col("n_test")), label, "n_rest", val_of_rest, "n_val")
    return sizes.drop("n_rest")


def stratified_split(
    df: DataFrame, label: str, keys, test: float = 0.15, val_of_rest: float = 0.176,
    seed: int = SEED, name: str = "split",
) -> DataFrame:
    """Exact class-wise test, validation and train rows by hash rank."""
    sizes = stratified_sizes(df, label, test, val_of_rest).withColumn(
        "n_held", F.col("n_test") + F.col("n_val")
    )
    slots = rank_slots(df, label, keys, sizes, ["n_test", "n_held"], seed)
    part = F.when(F.col("slot") == 0, "test").when(F.col("slot") == 1, "val").otherwise("train")
    return slots.withColumn(name, part).drop("slot")


def zone_split(df: DataFrame, test_zones, name: str = "split") -> DataFrame:
    """Geographic split: whole zones are held out."""
    return df.withColumn(name, F.when(F.col("zone").isin(list(test_zones)), "test").otherwise("train"))


def grouped_folds(
    df: DataFrame, label: str, keys=("zone",), block: int = 64, folds: int = 5, seed: int = SEED, name: str = "fold",
) -> DataFrame:
    """Add a fold per spatial block, so that neighbours share it and folds are even in rows and classes.

    Square blocks of ``block`` cells are told apart by their share of class 1, in quarters, and
    each kind is dealt largest first, back and forth over the folds. Two folds then differ in
    rows of a kind by at most its largest block. Ranks come from sliced running totals, a
    block is one row there. NULL labels count as rows without a class.
    """
    keys = list(keys)
    place = [F.expr(f"CAST({axis} DIV {block} AS INT)").alias(f"block_{axis}") for axis in ("r", "c")]
    marked = df.select("*", *place)
    at = [*keys, "block_r", "block_c"]
    sizes = marked.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("ones"))
    kinds = sizes.withColumns({
        "kind": F.floor(4 * F.col("ones") / F.col("n")).cast("int"), "one": F.lit(1),
        "order": F.struct((-F.col("n")).alias("n"), key_digest(seed, *at).alias("digest"), *at),
    })
    rank = F.col("cum_one") - 1
    turn, seat = F.floor(rank / folds), rank % folds
    back = (turn + F.col("kind")) % 2 == 1
    dealt = running_totals(kinds, ["kind"], "order", ["one"]).select(
        *at, F.when(back, folds - 1 - seat).otherwise(seat).cast("int").alias(name)
    )
    return lookup_join(marked, stage(dealt, "block_folds"), at, null_safe=True).select(*df.columns, name)


def undersample(df: DataFrame, label: str, keys, ratio: float = 0.5, seed: int = SEED) -> DataFrame:
    """Keep at most ``minority / ratio`` rows of each class, chosen by hash rank."""
    one_row_each = Window.partitionBy()
    caps = (
        df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cap", F.floor(F.min("n").over(one_row_each) / F.lit(ratio)).cast("bigint"))
    )
    return rank_slots(df, label, keys, caps, ["cap"], seed).where("slot = 0").drop("slot")


def oversample(df: DataFrame, label: str, keys, ratio: float = 0.5, seed: int = SEED) -> DataFrame:
    """Replicate small classes to ``ratio`` times the largest; ``copy`` numbers the copies."""
    one_row_each = Window.partitionBy()
    sizes = stage(
        df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("goal", F.ceil(F.max("n").over(one_row_each) * F.lit(ratio)).cast("bigint"))
        .withColumn("goal", F.greatest("goal", "n"))
        .withColumns({"copies": F.expr("goal DIV n"), "extra": F.col("goal") % F.col("n")}),
        "class_sizes",
    )
    slots = lookup_join(
        rank_slots(df, label, keys, sizes, ["extra"], seed), sizes.select(label, "copies"), label, null_safe=True
    )
    n_copies = (F.col("copies") + F.when(F.col("slot") == 0, 1).otherwise(0)).cast("int")
    return slots.select(*df.columns, F.explode(F.sequence(F.lit(1), n_copies)).alias("copy"))
