"""Queries for the SMS text path.

Texts are processed whole: every character of every document goes through
cleaning and tokenizing; the models use the labelled ones.  Stateless steps (cleaning, tokens, stop
words) run once; fitted steps (IDF, the classifier) see training rows only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import persisted
from ..functions.vectors import sparse_slots
from ..operators import certify, models, prep, text, tune
from ..sources import views
from ..functions.hashing import split_point
from . import oracle as o
from .common import SMS_SPLIT_SEED, TRAIN_FRACTION, r, with_folds

SMS_KEY = "id"


def _cleaned(spark, sf_dir) -> DataFrame:
    """Every document's text, cleaned."""
    return text.clean_text(views.texts(spark, sf_dir), "text")


def _labelled(spark, sf_dir) -> DataFrame:
    """Cleaned texts of the labelled documents, for the models."""
    return text.clean_text(views.sms(spark, sf_dir), "text")


def _positions(df: DataFrame, col: str, name: str) -> DataFrame:
    """(id, pos, token) rows."""
    return df.select(SMS_KEY, F.posexplode(col).alias("pos", name))


def _terms(spark, sf_dir, source=_cleaned) -> DataFrame:
    words = text.tokenize(source(spark, sf_dir), "text", "words")
    return text.remove_stop_words(words, "words", "terms")


def x1_clean_text(spark, sf_dir):
    """Punctuation and digits to spaces, runs of spaces collapsed."""
    return _cleaned(spark, sf_dir).select(SMS_KEY, "text")


def x4_tokens(spark, sf_dir):
    words = text.tokenize(_cleaned(spark, sf_dir), "text", "words")
    return _positions(words, "words", "token")


def x5_terms(spark, sf_dir):
    return _positions(_terms(spark, sf_dir), "terms", "term")


def _slots(df: DataFrame, col: str, name: str) -> DataFrame:
    """Non-zero slots of a vector column as ``(id, slot, name)`` rows."""
    return df.select(SMS_KEY, F.inline(sparse_slots(col, "slot", name))).filter(F.col(name) != 0)


def x6_hashed_counts(spark, sf_dir):
    """Hashed term counts (1024 slots): ``(id, slot, count)``; colliding terms add up."""
    hashed = text.hash_terms(_terms(spark, sf_dir), "terms", "hash", num_features=1024)
    return _slots(hashed, "hash", "count")


def x6_slot_collisions(spark, sf_dir):
    """The dictionary of 1024 slots over all documents: terms per slot, and the
    most frequent term with its documents."""
    return text.slot_dictionary(_terms(spark, sf_dir), "terms", SMS_KEY, 1024)


def x7_hashed_presence(spark, sf_dir):
    """Binary hashing: every set slot is exactly 1."""
    hashed = text.hash_terms(_terms(spark, sf_dir), "terms", "hash", num_features=1024, binary=True)
    return _slots(hashed, "hash", "value")


def x8_tfidf_terms(spark, sf_dir):
    """Term-level TF-IDF with Spark's weight ln((N + 1) / (df + 1))."""
    n_docs = views.texts(spark, sf_dir).count()
    out = text.term_tfidf(_terms(spark, sf_dir), SMS_KEY, "terms", n_docs)
    return out.select(SMS_KEY, "term", "tf", "doc_freq", r("idf").alias("idf"), r("tfidf").alias("tfidf"))


def x8_idf_hashed(spark, sf_dir):
    """The IDF stage on hashed counts (1024 slots): ``(id, slot, weight)``."""
    hashed = text.hash_terms(_terms(spark, sf_dir), "terms", "hash", num_features=1024)
    _, weighted = text.fit_idf(hashed, "hash", "features")
    return _slots(weighted, "features", "weight").withColumn("weight", r("weight"))


def m3_slot_terms(spark, sf_dir):
    """Slots of the spam model back to terms: per slot its coefficient, how many
    terms share it, and the most frequent one with its documents."""
    terms = _terms(spark, sf_dir, _labelled)
    train, _ = _sms_split(text.hash_terms(terms, "terms", "hash", num_features=1024))
    with persisted(train) as rows:
        weighted = IDF(inputCol="hash", outputCol="features").fit(rows).transform(rows)
        model = models.logistic(regParam=SPAM_REG_PARAM, tol=1e-8, maxIter=1000).fit(weighted)
    return text.slot_dictionary(terms, "terms", SMS_KEY, 1024, model).withColumn("coefficient", r("coefficient", 3))


def _sms_split(df: DataFrame):
    return prep.train_test_split(df, SMS_KEY, TRAIN_FRACTION, SMS_SPLIT_SEED)


def m3_logistic_tfidf(spark, sf_dir):
    """Spam model: 1024 hashed terms, IDF fitted on training rows, L2 logistic (regParam 0.2)."""
    hashed = text.hash_terms(_terms(spark, sf_dir, _labelled), "terms", "hash", num_features=1024)
    train, test = _sms_split(hashed)
    with persisted(train) as rows:
        idf = IDF(inputCol="hash", outputCol="features").fit(rows)
        _, pred = models.fit_and_score(models.logistic(regParam=0.2), idf.transform(rows), idf.transform(test))
    return pred.select(SMS_KEY, "label", "prediction")


SPAM_REG_PARAM = 0.2  # fixed value: the exercises' penalty of the spam model


def m3_gradient(spark, sf_dir):
    """Optimality of the spam model, run to its optimum: per hashed slot (and
    the intercept, -1) the training rows that store it, and the gradient of the
    log-loss plus that of the penalty on the scaled coefficient, which is 0."""
    hashed = text.hash_terms(_terms(spark, sf_dir, _labelled), "terms", "hash", num_features=1024)
    train, _ = _sms_split(hashed)
    with persisted(train) as rows:
        weighted = IDF(inputCol="hash", outputCol="features").fit(rows).transform(rows)
        model = models.logistic(regParam=SPAM_REG_PARAM, tol=1e-8, maxIter=1000).fit(weighted)
        error = vector_to_array("probability")[1] - F.col("label")
        sums = certify.slot_gradients(model.transform(weighted), error)
        coefficients = spark.createDataFrame([(k, float(b)) for k, b in enumerate(model.coefficients.toArray())], "slot int, b double")
        penalty = F.coalesce(SPAM_REG_PARAM * F.col("std") * F.col("std") * F.col("b"), F.lit(0.0))
        table = sums.join(F.broadcast(coefficients), "slot", "left")
        return table.select("slot", "n_rows", r(F.abs(F.col("gradient") + penalty)).alias("gradient"))


def t2_text_stages(spark, sf_dir):
    train, test = _sms_split(_labelled(spark, sf_dir))
    with persisted(train) as rows:
        fitted = tune.text_stages("text").fit(rows)
    return fitted.transform(test).select(SMS_KEY, "label", "prediction")


def t9_grid_text(spark, sf_dir, num_folds: int = 5):
    """72-point search over hashing and logistic settings, 5 folds (360 fits + 1).

    Tokens and stop words are computed once; hashing (its size and binary flag
    are searched) and IDF are fitted once per fold and setting, the classifier
    for each of its 12 points on the kept result."""
    terms = _terms(spark, sf_dir, _labelled)
    train, _ = _sms_split(terms)
    train = with_folds(train.select(SMS_KEY, "terms", "label"), num_folds, SMS_KEY)
    hasher = HashingTF(inputCol="terms", outputCol="hash")
    logistic = models.logistic()
    stages = Pipeline(stages=[hasher, IDF(inputCol="hash", outputCol="features")])
    found = tune.staged_search(stages, tune.hashing_grid(hasher), logistic, tune.logistic_grid(logistic),
                               BinaryClassificationEvaluator(numBins=0), train, num_folds, ["features", "label"])
    return tune.search_table(spark, found).withColumn("metric", r("metric"))


QUERIES = {
    "x1_clean_text": x1_clean_text,
    "x4_tokens": x4_tokens,
    "x5_terms": x5_terms,
    "x6_hashed_counts": x6_hashed_counts,
    "x7_hashed_presence": x7_hashed_presence,
    "x8_tfidf_terms": x8_tfidf_terms,
    "x8_idf_hashed": x8_idf_hashed,
    "m3_logistic_tfidf": m3_logistic_tfidf,
    "m3_gradient": m3_gradient,
    "m3_slot_terms": m3_slot_terms,
    "x6_slot_collisions": x6_slot_collisions,
    "t2_text_stages": t2_text_stages,
    "t9_grid_text": t9_grid_text,
}

_HASHED = o.TERMS + """,
vocab AS (SELECT DISTINCT unnest(terms) AS term FROM termed),""" + o.term_slots("vocab", 1024) + """,
doc_terms AS (SELECT t.id, m.slot FROM (SELECT id, unnest(terms) AS term FROM termed) t
              JOIN mm_slot m ON t.term = m.term)"""

_SPAM_TRAIN = _HASHED + f""",
lab AS (SELECT doc_id AS id FROM labels WHERE {o.md5_hash('doc_id', str(SMS_SPLIT_SEED))} < {split_point(TRAIN_FRACTION)}),
spam_rows AS (SELECT t.id FROM termed t JOIN lab USING (id))"""

_DICTIONARY = _HASHED + """,
term_docs AS (SELECT term, count(DISTINCT id) AS docs FROM (SELECT id, unnest(terms) AS term FROM termed) GROUP BY term)"""

ORACLE = {
    "m3_gradient": o.with_sql(_SPAM_TRAIN, """
        SELECT slot, count(*) AS n_rows, CAST(0 AS DOUBLE) AS gradient
        FROM (SELECT DISTINCT id, slot FROM doc_terms) JOIN spam_rows USING (id) GROUP BY slot
        UNION ALL SELECT -1, count(*), 0 FROM spam_rows"""),
    "x6_slot_collisions": o.with_sql(_DICTIONARY, """
        SELECT slot, count(*) AS n_terms, max_by(term, (docs, term)) AS top_term, max(docs) AS top_docs, CAST(sum(docs) AS BIGINT) AS sum_docs
        FROM term_docs JOIN mm_slot USING (term) GROUP BY slot"""),
    "x1_clean_text": o.with_sql(o.CLEANED, "SELECT id, text FROM cleaned"),
    "x4_tokens": o.with_sql(o.TOKENS, """
        SELECT id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS token
        FROM tokenized"""),
    "x5_terms": o.with_sql(o.TERMS, """
        SELECT id, CAST(generate_subscripts(terms, 1) - 1 AS INTEGER) AS pos, unnest(terms) AS term
        FROM termed"""),
    "x6_hashed_counts": o.with_sql(_HASHED, """
        SELECT id, slot, CAST(count(*) AS DOUBLE) AS count FROM doc_terms GROUP BY id, slot"""),
    "x7_hashed_presence": o.with_sql(_HASHED, """
        SELECT DISTINCT id, slot, CAST(1 AS DOUBLE) AS value FROM doc_terms"""),
    "x8_idf_hashed": o.with_sql(_HASHED + """,
        tf AS (SELECT id, slot, count(*) AS tf FROM doc_terms GROUP BY id, slot),
        dfs AS (SELECT slot, count(*) AS df FROM tf GROUP BY slot),
        nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM termed)""", """
        SELECT tf.id, tf.slot, round(tf.tf * ln(((SELECT n FROM nd) + 1) / (dfs.df + 1)), 6) AS weight
        FROM tf JOIN dfs ON tf.slot = dfs.slot"""),
    "x8_tfidf_terms": o.with_sql(o.TERMS + """,
        pairs AS (SELECT id, term, count(*) AS tf
                  FROM (SELECT id, unnest(terms) AS term FROM termed) GROUP BY id, term),
        dict AS (SELECT term, count(*) AS doc_freq FROM pairs GROUP BY term),
        nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM termed)""", """
        SELECT p.id, p.term, p.tf, d.doc_freq,
               round(ln(((SELECT n FROM nd) + 1) / (d.doc_freq + 1)), 6) AS idf,
               round(p.tf * ln(((SELECT n FROM nd) + 1) / (d.doc_freq + 1)), 6) AS tfidf
        FROM pairs p JOIN dict d ON p.term = d.term"""),
}
