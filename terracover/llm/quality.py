"""Quality rules: per-document counts, and line frequency across the documents of a host.

A document fails the base rules if it has too few words or too large a share of words in
repeated word windows. Beyond that, normalised lines (trimmed, blank runs collapsed,
lower-cased) are hashed to 128 bits and distinct documents are counted per (host, hash).
A line found in more documents of its host than the limit is boilerplate: it is taken out of
every document of the host, its words are counted as ``n_removed``, and a document that loses
more than ``depleted`` of its words is rejected. :func:`judge` gives the verdicts,
:func:`clean_good` the accepted documents without their boilerplate lines.

Copies of a document must not make its own text boilerplate, they are the business of
deduplication: documents whose normalised lines are all equal, in order, count once. Near
copies count one by one, as documents do. The limit ``min_docs`` is a number of documents
so counted and does not depend on the size of the host.

Shape of the job: only native functions. The counts of a text are one narrow pass; the
sole expensive part, locating repeated windows, runs for texts that have any. Lines are
shuffled as hashes, pre-aggregated twice, so a hot host or line is split by hash and
combined map-side. Texts are never shuffled for the verdict; they move once, to meet the
places of the lines they lose.

Defined results: a null text has no words and fails. The null host is a host of its own.
Rows with equal values get equal results. Very long texts are counted whole. Only the three
named columns are read; :func:`keep_good` and :func:`clean_good` keep all columns whatever
their names. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.llm.text import BLANK_RUN, BLANKS, packed, row_key, unpacked, word_array
from terracover.sources.staging import stage

WINDOW = 8
SYMBOLS = "#*$%&|<>"


def _repeat_words(df: DataFrame, window: int) -> DataFrame:
    """Adds ``n_repeat_words`` from ``words``: words in windows that occur at least twice."""
    starts = F.sequence(F.lit(1), F.size("words") - window + 1)
    hashes = F.when(F.size("words") >= window, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, window))))
    df = df.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    # Sorted (hash, position): a window repeats if a neighbour has its hash.
    pairs = F.when(repeats, F.array_sort(F.transform("_hashes", lambda h, i: F.named_struct(F.lit("h"), h, F.lit("i"), i))))
    df = df.withColumn("_pairs", pairs)
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    trio = F.arrays_zip(
        F.col("_pairs").alias("at"), F.concat(none, F.col("_pairs")).alias("before"),
        F.slice("_pairs", F.lit(2), F.size("_pairs")).alias("after"),
    )
    df = df.withColumn("_trio", trio)
    marked = F.filter("_trio", lambda x: F.coalesce(x["at"]["h"] == x["before"]["h"], F.lit(False))
                      | F.coalesce(x["at"]["h"] == x["after"]["h"], F.lit(False)))
    df = df.withColumn("_places", F.sort_array(F.transform(marked, lambda x: x["at"]["i"])))
    # Each repeated window adds the words up to the next one, the last adds all of its words.
    gaps = F.zip_with(F.slice("_places", F.lit(2), F.size("_places")), F.col("_places"),
                      lambda b, a: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)
    return df.withColumn(
        "n_repeat_words", F.when(F.col("_places").isNull(), F.lit(0)).otherwise(covered).cast("long")
    ).drop("_hashes", "_pairs", "_trio", "_places")


def text_counts(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds the per-document counts to a frame that has ``text`` (kept) and working names of its own."""
    symbols = "[^" + SYMBOLS.replace("|", "\\|").replace("$", "\\$").replace("&", "\\&") + "]+"
    df = df.withColumn("words", word_array(F.col("text")))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("long"))
    df = df.withColumn("n_symbols", F.char_length(F.regexp_replace(F.coalesce("text", F.lit("")), symbols, "")).cast("long"))
    df = df.withColumn("_lines", F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""
    ))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return _repeat_words(df.drop("_lines"), window).drop("words")


def _lines(texts: DataFrame) -> DataFrame:
    """One row per line with a word: key, host, fingerprint of the document, line hash, its words, its place."""
    bare = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    normal = F.transform("bare", lambda x: F.lower(F.regexp_replace(x, BLANK_RUN, " ")))
    held = texts.select("key", "host", bare.alias("bare")).select("key", "host", normal.alias("lines"))
    # All normalised lines in their order stand for the document and its copies.
    whole = F.unhex(F.md5(F.array_join(F.filter("lines", lambda x: x != ""), "\n")))
    # The fingerprint first: a row per line must not carry all lines of its text.
    held = held.select("key", "host", whole.alias("print"), "lines")
    held = held.select("key", "host", "print", F.posexplode("lines").alias("place", "line")).where("line <> ''")
    blanks = F.char_length("line") - F.char_length(F.replace("line", F.lit(" "), F.lit("")))
    return held.select("key", "host", "print", F.unhex(F.md5("line")).alias("hash"), (blanks + 1).alias("words"), "place")


def boilerplate(lines: DataFrame, min_docs: int) -> DataFrame:
    """(host, hash, n_docs) of the lines that more than ``min_docs`` documents of the host hold."""
    return (
        lines.select("host", "hash", "print").distinct()
        .groupBy("host", "hash").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    )


def _source(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return docs.select(
        row_key(docs[id_col], docs[host_col], docs[text_col]).alias("key"),
        docs[id_col].alias("id"), docs[host_col].alias("host"), docs[text_col].alias("text"),
    )


def _judged(source: DataFrame, min_words: int, max_repeat_pct: int, min_docs: int, depleted: float) -> DataFrame:
    """Verdicts per row of ``source`` with ``gone``, the places of its boilerplate lines in ascending order."""
    lines = stage(_lines(source), "quality-lines")
    bad = stage(boilerplate(lines, min_docs).select(F.col("host").alias("at"), F.col("hash").alias("line")), "quality-boilerplate")
    # Repeated rows share a key, so every place of a line can come several times.
    lost = (
        lines.join(bad, (F.col("hash") == F.col("line")) & F.col("host").eqNullSafe(F.col("at")))
        .select("key", "place", "words").distinct()
        .groupBy("key").agg(F.sum("words").cast("long").alias("n_removed"), F.sort_array(F.collect_list("place")).alias("gone"))
    )
    # Staged, or a filter on the verdict would be pushed into the counts and repeat their work.
    counts = stage(text_counts(source).drop("text", "host"), "quality-counts")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    met = counts.join(lost, "key", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    return met.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_removed") <= depleted * F.col("n_words"))
    )


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_words: int = 20, max_repeat_pct: int = 30, min_docs: int = 20, depleted: float = 0.6,
) -> DataFrame:
    """One row per document: ``key``, id, the counts, ``n_removed`` words, ``base_failed`` and ``kept``."""
    judged = _judged(_source(docs, id_col, text_col, host_col), min_words, max_repeat_pct, min_docs, depleted)
    return judged.drop("gone").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The documents that :func:`judge` keeps, unchanged."""
    verdicts = judge(docs, id_col, text_col, host_col, **limits)
    good = verdicts.where("kept").select("key").distinct()
    source = docs.select(packed(docs).alias("row"), row_key(docs[id_col], docs[host_col], docs[text_col]).alias("key"))
    return unpacked(source.join(good.hint("shuffle_hash"), "key", "left_semi"), docs.columns, {})


def without_places(text: Column, gone: Column) -> Column:
    """The text without its lines at the ascending places ``gone``: the stretches between them, in time linear in the lines."""
    lines = F.split(text, "\n", -1)
    stops = F.concat(gone, F.array(F.size(lines)))

    def stretch(stop: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
        return F.slice(lines, start + 1, stop - start)

    return F.array_join(F.flatten(F.transform(stops, stretch)), "\n")


def clean_good(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_words: int = 20, max_repeat_pct: int = 30, min_docs: int = 20, depleted: float = 0.6,
) -> DataFrame:
    """The documents that :func:`judge` keeps, without their boilerplate lines."""
    judged = _judged(_source(docs, id_col, text_col, host_col), min_words, max_repeat_pct, min_docs, depleted)
    good = judged.where("kept").groupBy("key").agg(F.first("gone").alias("gone"))
    source = docs.select(packed(docs).alias("row"), row_key(docs[id_col], docs[host_col], docs[text_col]).alias("key"))
    met = source.join(good.hint("shuffle_hash"), "key")
    text = F.col("row").getField(text_col)
    return unpacked(met, docs.columns, {text_col: F.when(F.col("gone").isNull(), text).otherwise(without_places(text, F.col("gone")))})
