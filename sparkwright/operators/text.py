"""Text preparation (X1-X8): cleaning, tokens, stop words, hashed counts, IDF.

Cleaning is three ``regexp_replace`` calls that Catalyst fuses into one
projection; tokenizing and stop-word removal are Spark ML transformers (JVM,
per row, no shuffle).  ``HashingTF`` is stateless; ``IDF`` needs one
distributed pass for document frequencies.  ``term_tfidf`` computes the same
weights per term, without hashing, as DataFrame aggregates.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, IDFModel, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import skew_safe_join
from ..functions.vectors import sparse_slots
from ..session import shared_root

# The cleaning patterns of the exercises.
PUNCTUATION = r"[_():;,.!?\-]"
DIGITS = r"[0-9]"
SPACES = r" +"


def clean_text(df: DataFrame, col: str = "text", output_col: str | None = None) -> DataFrame:
    """X1-X3. Punctuation and digits to a space, then runs of spaces to one."""
    text = F.regexp_replace(F.col(col), PUNCTUATION, " ")
    text = F.regexp_replace(text, DIGITS, " ")
    text = F.regexp_replace(text, SPACES, " ")
    return df.withColumn(output_col or col, text)


def tokenize(df: DataFrame, col: str = "text", output_col: str = "words") -> DataFrame:
    """X4. Lower-case, split on single whitespace characters; a trailing empty
    token is dropped, a leading one kept.  A null text counts as empty: one
    empty token, as Spark has it for an empty text."""
    filled = df.withColumn("__filled", F.coalesce(F.col(col), F.lit("")))
    return Tokenizer(inputCol="__filled", outputCol=output_col).transform(filled).drop("__filled")


def remove_stop_words(df: DataFrame, col: str = "words", output_col: str = "terms",
                      stop_words: list[str] | None = None) -> DataFrame:
    """X5. Case-insensitive removal of Spark's English list (181 words) by default."""
    remover = StopWordsRemover(inputCol=col, outputCol=output_col)
    if stop_words is not None:
        remover.setStopWords(stop_words)
    return remover.transform(df)


def hash_terms(df: DataFrame, col: str = "terms", output_col: str = "hash",
               num_features: int = 1 << 18, binary: bool = False) -> DataFrame:
    """X6-X7. Hashed term counts (or presence when ``binary``) in a sparse vector."""
    return HashingTF(inputCol=col, outputCol=output_col, numFeatures=num_features,
                     binary=binary).transform(df)


def fit_idf(df: DataFrame, col: str = "hash", output_col: str = "features",
            min_doc_freq: int = 0) -> tuple[IDFModel, DataFrame]:
    """X8. Weight ``ln((N + 1) / (df + 1))`` per hashed slot, fit in one tree-aggregate."""
    model = IDF(inputCol=col, outputCol=output_col, minDocFreq=min_doc_freq).fit(df)
    return model, model.transform(df)


def slot_dictionary(df: DataFrame, terms_col: str, id_col: str, num_features: int, model=None) -> DataFrame:
    """X6 back to terms: ``(slot, n_terms, top_term, top_docs, sum_docs)``: the
    distinct terms hashed to a slot (more than one: a collision), the one in
    most documents (of equals the last by name), and the terms' documents added
    up.  With a fitted linear ``model`` its ``coefficient`` of the slot.  Terms
    are counted before they are hashed, each once, by ``HashingTF`` itself."""
    pairs = df.select(id_col, F.explode_outer(terms_col).alias("term")).where(F.col("term").isNotNull()).distinct()
    docs = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    hashed = hash_terms(docs.withColumn("one", F.array("term")), "one", "hash", num_features)
    slots = hashed.select("term", "docs", F.get(sparse_slots("hash"), F.lit(0))["slot"].alias("slot"))
    top = F.max(F.struct("docs", "term"))
    out = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n_terms"), top.alias("top"), F.sum("docs").alias("sum_docs"))
    out = out.select("slot", "n_terms", F.col("top.term").alias("top_term"), F.col("top.docs").alias("top_docs"), "sum_docs")
    if model is None:
        return out
    weights = [(k, float(b)) for k, b in enumerate(model.coefficients.toArray())]
    return out.join(F.broadcast(df.sparkSession.createDataFrame(weights, "slot int, coefficient double")), "slot")


#: Dictionaries of more bytes than this are joined by shuffles.
BROADCAST_BYTES = 64 << 20


def _counted_runs(df: DataFrame, id_col: str, terms_col: str) -> DataFrame:
    """``(id, runs)`` of every row by itself, ``runs`` its terms in sorted order
    with their counts as ``array<struct<term, tf>>``."""
    # sort_array: array_sort would compare through a lambda
    ordered = df.select(id_col, F.sort_array(F.array_compact(terms_col)).alias("s"))
    places = F.slice(F.sequence(F.lit(0), F.size("s")), F.lit(1), F.size("s"))  # none of an empty row
    starts = F.filter(places, lambda k: (k == 0) | (F.get("s", k) != F.get("s", k - 1)))
    starting = ordered.select(id_col, "s", starts.alias("starts"))
    end = lambda i: F.coalesce(F.get("starts", i + 1), F.size("s"))
    return starting.select(id_col, F.transform("starts", lambda k, i: F.struct(
        F.get("s", k).alias("term"), (end(i) - k).cast("long").alias("tf"))).alias("runs"))


def term_counts(df: DataFrame, id_col: str = "id", terms_col: str = "terms") -> DataFrame:
    """Rows ``(id, term, tf)``, counted within each row of ``df``; only the rows
    of ids that come more than once (null counts as an id) are added up by a
    shuffle.  Written once to the shared checkpoint folder, a row per row of
    ``df``: readers do not tokenize again, nor read a record per term."""
    shared_root(df.sparkSession)
    runs = _counted_runs(df, id_col, terms_col).checkpoint(eager=True)
    repeated = runs.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    if repeated.isEmpty():
        return runs.select(id_col, F.inline("runs"))
    marked = runs.join(repeated, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    again = marked.where("__n IS NOT NULL").select(id_col, F.inline("runs")).groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
    return marked.where("__n IS NULL").select(id_col, F.inline("runs")).unionByName(again)


def term_tfidf(df: DataFrame, id_col: str = "id", terms_col: str = "terms",
               n_docs: int | None = None) -> DataFrame:
    """X8 per term, no hashing: rows ``(id, term, tf, doc_freq, idf, tfidf)``.

    Plan: terms counted within each document (checkpointed once) ->
    document frequency per term (each pair counts once; partial aggregation
    absorbs hot terms) -> join back on term.  The dictionary is written out and
    measured: up to ``BROADCAST_BYTES`` it is broadcast, so that the pairs stay
    where they are; past that the sort-merge join's skewed partitions are split
    (AQE), so a term held by most documents does not land on one task (without
    AQE: a salted join).
    """
    # Both join sides read the counts, which are written once.
    pairs = term_counts(df, id_col, terms_col)
    if n_docs is None:
        n_docs = df.count()  # N counts every document row, as IDF does
    idf = F.ln((F.lit(n_docs) + 1.0) / (F.col("doc_freq") + 1.0))
    dictionary = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")).withColumn("idf", idf).checkpoint(eager=True)
    held = dictionary.agg(F.coalesce(F.sum(F.octet_length("term") + F.lit(40)), F.lit(0))).first()[0]
    if held <= BROADCAST_BYTES:
        joined = pairs.join(F.broadcast(dictionary), on="term")
    else:
        joined = skew_safe_join(pairs, dictionary, on="term", salts=32)
    return joined.select(id_col, "term", "tf", "doc_freq", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))
