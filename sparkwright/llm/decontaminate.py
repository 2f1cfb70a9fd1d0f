"""Benchmark decontamination by a prefix-filtered set join, DataFrame only.

A benchmark item is cut into windows of ``size`` consecutive words (an item of
fewer words is one window).  A document holds a window only if it holds the
window's words, the rarest included; so the words of each window are ordered
by how often documents use them (counted over all documents, ties by the
word), and the rarest one, with its place in the window, is the prefix that
must be met.  Document words are joined with these prefixes; the place gives
where the window would start, which must not be before the document's first
word nor end after its last; then the words from there on are compared with
the whole window.  Overlapping hits of a document are merged.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.

Scale: texts are read in place (one pass counts the benchmark's words, one
joins, one counts words) and never shuffled while the benchmark's windows
stay under ``BROADCAST_BYTES``, which is measured.  A larger benchmark is
joined by shuffling the words one by one, and the texts once for the
comparison.  A prefix is the rarest word of its window, so a frequent word is
joined only for windows that have nothing rarer.  Hits are collected per
document and are at most its words.

Defined results: a null text has no words; a null id is an id of its own
(``null`` among the items); equal document ids with different texts are
judged apart, repeated rows keep a row each; items of one id are one item;
empty tables give no hits or an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest size of the windows' table (words and ids) that is broadcast.
BROADCAST_BYTES = 64 << 20

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    text = F.coalesce(text, F.lit(""))
    # lower() is fast but also changes other letters: it is for ASCII texts
    low = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(low, _BETWEEN), "")


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows with the sorted ids of their items: ``window, items``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))))
    cut = items.withColumn("start", start).select("item", F.slice("words", F.col("start"), size).alias("window"))
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _spread(documents: DataFrame) -> DataFrame:
    """One row per document word: ``key, words, at`` (from 0) and ``word``."""
    keyed = documents.select(_key().alias("key"), words_of(F.col("text")).alias("words"))
    return keyed.select("key", "words", F.posexplode("words").alias("at", "word"))


def _key() -> Column:
    return F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")))
    )


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def prefixes(documents: DataFrame, found: DataFrame, small: bool) -> DataFrame:
    """``found`` with each window's rarest word and its place in the window."""
    vocabulary = found.select(F.explode("window").alias("word")).distinct()
    used = documents.select(F.explode(words_of(F.col("text"))).alias("word"))
    counts = used.join(_small(vocabulary, small), "word").groupBy("word").agg(F.count("*").alias("uses"))
    places = found.select("window", F.posexplode("window").alias("place", "word")).join(_small(counts, small), "word", "left")
    rank = F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "place")
    rarest = places.groupBy("window").agg(F.min(rank).alias("first"))
    return found.join(rarest, "window").select(
        "window", "items", F.col("first.word").alias("prefix"), F.col("first.place").alias("place")
    )


def occurrences(documents: DataFrame, index: DataFrame, small: bool) -> DataFrame:
    """Every occurrence of a window: ``key, start, length, items``."""
    spread = _spread(documents).withColumn("total", F.size("words"))
    start = F.col("at") - F.col("place")
    fits = (F.col("word") == F.col("prefix")) & (start >= 0) & (start + F.size("window") <= F.col("total"))
    if small:
        meets = fits & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))
        found = spread.join(F.broadcast(index), meets)
        return found.select("key", start.alias("start"), F.size("window").alias("length"), "items")
    # shuffle single words, then the texts once to compare the whole windows
    fitting = spread.drop("words").join(index, fits).select("key", start.alias("start"), "window", "items")
    texts = documents.select(_key().alias("key"), words_of(F.col("text")).alias("words")).dropDuplicates(["key"])
    same = F.slice("words", F.col("start") + 1, F.size("window")) == F.col("window")
    return fitting.join(texts, "key").where(same).select("key", "start", F.size("window").alias("length"), "items")


def _covered(spans: Column) -> Column:
    """Words under sorted, possibly overlapping (start, length) spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["start"] + s["length"])
        return F.struct((acc["n"] + end - F.greatest(acc["end"], s["start"])).alias("n"), end.alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = 13, part: int = 20) -> DataFrame:
    """Per document ``n_words, n_hit, items`` (sorted ids) and ``contaminated``:
    hit at all, and at least one of ``part`` words hit."""
    found = windows(benchmark, size)
    window_bytes = F.aggregate("window", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 16)
    item_bytes = F.aggregate("items", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 16)
    bytes_all = found.agg(F.sum(window_bytes + item_bytes)).first()[0] or 0
    small = bytes_all <= BROADCAST_BYTES
    index = prefixes(documents, found, small)
    hits = occurrences(documents, index, small)
    per_key = hits.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    per_key = per_key.select("key", _covered(F.col("spans")).cast("long").alias("n_hit"), "items")
    base = documents.select("doc_id", _key().alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    judged = base.join(per_key, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * part >= F.col("n_words")))
