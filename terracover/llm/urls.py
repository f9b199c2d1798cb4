"""URL filters: host and path rules, and a character language-model ratio for the rest.

Urls on which a rule decides teach two character models, one of accepted and one of
rejected urls (host and path). A model predicts each character from up to ``order``
characters before it: the estimate of a context is smoothed towards that of the next
shorter one, contexts seen fewer than ``least`` times are passed over, the shortest
estimate is add-one over the characters seen. A url's score is the difference of its two
log-likelihoods per character. The cut between the verdicts is calibrated on labelled urls
left out of training: the score, in steps of a hundredth, with the best balanced accuracy,
the one nearest to 0 among equals.

Shape of the job: only native functions. N-grams are counted per distinct (class, n-gram)
with map-side aggregation; shorter n-grams and contexts are summed from the longest ones,
so urls are cut up once for training. Every distinct n-gram gets its log ratio once, in
integer millionths, so sums do not depend on their order; urls then join these. Distinct
host-and-path strings are judged once. The driver sees totals and the cut.

Defined results: a null url or one without ``://`` has an empty host and path, which the
model judges as any other string. If one of the two classes has no training url, the model
accepts. Repeated rows get equal results. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.llm.text import packed, unpacked
from terracover.operators.joins import large_join
from terracover.sources.staging import stage

MARK, STOP = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MICRO = 1_000_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as a struct (size, rule, verdict); null if none does.

    The list is a parameter of at most a few hundred rules.
    """
    fits = [
        F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
               F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def _grams(text: Column, order: int) -> Column:
    """The n-gram that ends at each character of the string and at its end."""
    full = F.concat(F.lit(MARK * order), text, F.lit(STOP))
    return F.transform(F.sequence(F.lit(1), F.char_length(text) + 1), lambda i: F.substr(full, i, F.lit(order + 1)))


def log_ratios(counts: DataFrame, wanted: DataFrame, order: int, least: int, strength: float) -> DataFrame:
    """(gram, ratio): log of accepted over rejected likelihood of the last character, in millionths.

    ``counts``: (gram, yes, no) of training n-grams of full length; ``wanted``: (gram).
    """
    full = order + 1
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("yes", "no")]
    ends = counts.groupBy(F.substr("gram", F.lit(full), F.lit(1)).alias("c")).agg(*sums)
    total = ends.agg(*sums, F.count("*").alias("kinds")).first()
    table = wanted
    for m in range(1, full + 1):
        suffix = F.substr("gram", F.lit(full - m + 1), F.lit(m))
        own = counts.groupBy(suffix.alias(f"s{m}")).agg(F.sum("yes").alias(f"yes{m}"), F.sum("no").alias(f"no{m}"))
        table = table.join(own, suffix == F.col(f"s{m}"), "left").drop(f"s{m}")
        if m > 1:
            before = F.substr("gram", F.lit(full - m + 1), F.lit(m - 1))
            context = counts.groupBy(before.alias(f"x{m}")).agg(F.sum("yes").alias(f"from_yes{m}"), F.sum("no").alias(f"from_no{m}"))
            table = table.join(context, before == F.col(f"x{m}"), "left").drop(f"x{m}")

    def likelihood(kind: str) -> Column:
        p = (F.coalesce(f"{kind}1", F.lit(0)) + 1) / F.lit(float(total[kind] + total["kinds"] + 1))
        for m in range(2, full + 1):
            seen = F.coalesce(f"from_{kind}{m}", F.lit(0))
            p = F.when(seen >= least, (F.coalesce(f"{kind}{m}", F.lit(0)) + strength * p) / (seen + strength)).otherwise(p)
        return p

    return table.select("gram", F.round((F.log(likelihood("yes")) - F.log(likelihood("no"))) * MICRO).cast("long").alias("ratio"))


def scores(texts: DataFrame, ratios: DataFrame, order: int) -> DataFrame:
    """(text, score): mean log ratio per character, end included."""
    cut = texts.select("text", F.explode(_grams(F.col("text"), order)).alias("gram"))
    # Sizes estimated before explode would let the n-grams of all urls be broadcast.
    total = large_join(cut, ratios, "gram").groupBy("text").agg(F.sum("ratio").alias("sum"))
    return total.select("text", (F.col("sum") / MICRO / (F.char_length("text") + 1)).alias("score"))


def calibrated_cut(scored: DataFrame) -> float:
    """Least score to accept, from (score, verdict, n) of labelled urls; 0 if a class is missing."""
    step = F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.col("score") * 100))).cast("int")
    bins = scored.groupBy(step.alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("no"),
    )
    # At most 2,001 bins: accept from this bin on.
    up = Window.orderBy("bin").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    down = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    # All cuts above the next lower bin do the same; the one nearest to 0 stands for them.
    nearest = F.greatest(F.coalesce(F.lag("bin").over(Window.orderBy("bin")), F.lit(-1001)) + 1, F.least(F.col("bin"), F.lit(0)))
    rated = bins.select(
        nearest.alias("cut"), (
            F.try_divide(F.sum("yes").over(up), F.sum("yes").over(every))
            + F.try_divide(F.coalesce(F.sum("no").over(down), F.lit(0)), F.sum("no").over(every))
        ).alias("rate")  # null if a class is missing
    ).where("rate IS NOT NULL")
    best = rated.orderBy(F.round("rate", 9).desc(), F.abs("cut"), "cut").first()
    return best["cut"] / 100 if best else 0.0


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", order: int = 4, least: int = 4,
    strength: float = 2.0, left_out: int = 5,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, which replace columns of these names.

    ``rules``: (allow or block, host, path). One in ``left_out`` labelled strings calibrates.
    """
    rows = pages.select(packed(pages).alias("row"), pages[url_col].alias("url"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("text", F.concat("host", "path"))
    texts = stage(
        rows.groupBy("text").agg(F.count("*").alias("n"), F.min("fit.verdict").alias("verdict")), "url-texts"
    )
    fold = F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("bigint") % left_out
    labelled = texts.where("verdict IS NOT NULL")
    counts = stage(
        labelled.where(fold != 0).select("verdict", "n", F.explode(_grams(F.col("text"), order)).alias("gram"))
        .groupBy("gram").agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("yes"),
            F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("no"),
        ), "url-grams",
    )
    judged = texts.where(F.col("verdict").isNull() | (fold == 0))
    wanted = judged.select(F.explode(_grams(F.col("text"), order)).alias("gram")).distinct()
    both = counts.agg(F.coalesce(F.sum("yes"), F.lit(0)), F.coalesce(F.sum("no"), F.lit(0))).first()
    if min(both) > 0:
        ratios = stage(log_ratios(counts, wanted, order, least, strength), "url-ratios")
        scored = stage(judged.join(scores(judged, ratios, order), "text"), "url-scores")
        cut = calibrated_cut(scored.where("verdict IS NOT NULL"))
        decided = scored.where("verdict IS NULL").select(
            F.col("text").alias("of"), F.when(F.floor(F.col("score") * 100) / 100 >= cut, "allow").otherwise("block").alias("model")
        )
        rows = rows.join(decided, F.col("text") == F.col("of"), "left")
    else:
        rows = rows.withColumn("model", F.lit("allow"))
    return unpacked(rows, pages.columns, {
        "host": F.col("host"), "path": F.col("path"), "rule": F.col("fit.rule"),
        "verdict": F.coalesce("fit.verdict", "model"),
    })
