import math

from pyspark.ml.feature import HashingTF, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.functions.stopwords import ENGLISH_STOP_WORDS
from sparkwright.operators import text

WORDS = {1: ["sorry", "i'll", "call", "later", "in", "meeting"],
         2: ["dont", "worry", "i", "guess", "he's", "busy"],
         3: ["call", "freephone", "now"],
         4: ["win", "a", "cash", "prize", "or", "a", "prize", "worth"]}
TERMS = {1: ["sorry", "call", "later", "meeting"], 2: ["dont", "worry", "guess", "busy"],
         3: ["call", "freephone"], 4: ["win", "cash", "prize", "prize", "worth"]}


def _terms(sms):
    return text.remove_stop_words(text.tokenize(text.clean_text(sms)))


def test_clean_and_tokens_goldens(sms_fixture):
    df = text.tokenize(text.clean_text(sms_fixture))
    rows = {r.id: r for r in df.collect()}
    assert {i: r.words for i, r in rows.items()} == WORDS
    assert rows[1].text == "Sorry I'll call later in meeting"
    assert rows[3].text == "Call FREEPHONE now "          # trailing space, dropped by the tokenizer


def test_stop_words_goldens(sms_fixture):
    assert {r.id: r.terms for r in _terms(sms_fixture).collect()} == TERMS


def test_stop_list_is_sparks_default():
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert len(ENGLISH_STOP_WORDS) == 181


def test_tokenizer_keeps_leading_empty_token(spark):
    df = spark.createDataFrame([(1, " a b  ")], "id int, text string")
    assert text.tokenize(df).first().words == ["", "a", "b"]


def test_hashing_invariants(sms_fixture):
    counts = text.hash_terms(_terms(sms_fixture), num_features=1024)
    presence = text.hash_terms(_terms(sms_fixture), num_features=1024, binary=True)
    for r in counts.select("id", "terms", vector_to_array("hash").alias("v")).collect():
        assert sum(r.v) == len(r.terms)
    for r in presence.select(vector_to_array("hash").alias("v")).collect():
        assert set(r.v) <= {0.0, 1.0}


def test_idf_stage_matches_term_formula(sms_fixture):
    terms = _terms(sms_fixture)
    hashed = text.hash_terms(terms, num_features=1 << 18)
    _, weighted = text.fit_idf(hashed)
    per_term = {(r.id, r.term): r for r in text.term_tfidf(terms).collect()}
    hasher = HashingTF(numFeatures=1 << 18)
    n = 4
    for r in weighted.select("id", "terms", vector_to_array("features").alias("v")).collect():
        for t in set(r.terms):
            row = per_term[(r.id, t)]
            assert math.isclose(row.idf, math.log((n + 1) / (row.doc_freq + 1)), rel_tol=1e-12)
            assert math.isclose(r.v[hasher.indexOf(t)], row.tfidf, rel_tol=1e-12)
    prize = per_term[(4, "prize")]
    assert prize.tf == 2 and prize.doc_freq == 1


def test_salted_join_equals_plain_join(sms_fixture):
    from sparkwright.functions.joins import salted_join
    pairs = (_terms(sms_fixture).select("id", F.explode("terms").alias("term"))
             .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")))
    d = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    plain = sorted(tuple(r) for r in pairs.join(d, "term").select("id", "term", "tf", "doc_freq").collect())
    salted = salted_join(pairs, d, on="term", salts=8)
    assert sorted(tuple(r) for r in salted.select("id", "term", "tf", "doc_freq").collect()) == plain


def test_sql_murmur3_slot_matches_hashing_tf(spark):
    import duckdb

    from sparkwright.plans import oracle as o
    words = ["", "a", "ab", "abc", "abcd", "abcde", "prize", "straße", "été", "naïve", "日本語", "😀x", "don't"]
    values = ", ".join("('" + w.replace("'", "''") + "')" for w in words)
    for n in (1024, 1 << 18):
        sql = o.with_sql(f"vocab AS (SELECT * FROM (VALUES {values}) AS v(term))," + o.term_slots("vocab", n),
                         "SELECT term, slot FROM mm_slot")
        got = dict(duckdb.sql(sql).fetchall())
        hasher = HashingTF(numFeatures=n)
        assert got == {w: hasher.indexOf(w) for w in words}


def test_null_text_counts_as_empty(spark):
    from sparkwright.operators import tune
    df = spark.createDataFrame([(1, None, 0), (2, "Hi there", 1), (3, "", 0)], "id int, text string, label int")
    words = {r.id: r.words for r in text.tokenize(df).collect()}
    assert words == {1: [""], 2: ["hi", "there"], 3: [""]}
    assert text.tokenize(df).columns == [*df.columns, "words"]
    scored = tune.text_stages(num_features=16).fit(df).transform(df)
    assert scored.count() == 3 and scored.where("id = 1").first().prediction == 0.0


def test_slot_dictionary_finds_collisions(spark):
    from pyspark.ml.feature import HashingTF
    docs = [(i, [f"w{k}" for k in range(40) if (i * k) % 3 != 1] + ["w1"]) for i in range(9)] + [(99, None), (100, [])]
    df = spark.createDataFrame(docs, "id int, terms array<string>")
    slots = {}
    for w in {w for _, t in docs for w in t or []}:
        slots.setdefault(HashingTF(numFeatures=16).indexOf(w), []).append((sum(w in (t or []) for _, t in docs), w))
    got = {r.slot: (r.n_terms, r.top_docs, r.top_term, r.sum_docs) for r in text.slot_dictionary(df, "terms", "id", 16).collect()}
    assert got == {s: (len(t), *max(t), sum(n for n, _ in t)) for s, t in slots.items()}
    assert text.slot_dictionary(df.limit(0), "terms", "id", 16).count() == 0


def test_term_weights_count_within_documents(spark, monkeypatch):
    data = [(1, ["a", "b", "a", None]), (1, ["a", "c"]), (2, []), (3, ["b"]), (None, ["a", "z"]), (None, ["z"]), (4, None)]
    df = spark.createDataFrame(data, "id long, terms array<string>")
    tf = {}
    for key, terms in data:
        for term in filter(None, terms or []):
            tf[key, term] = tf.get((key, term), 0) + 1
    freq = {t: sum(term == t for _, term in tf) for _, t in tf}
    want = sorted((str(k), t, n, freq[t], round(n * math.log((7 + 1) / (freq[t] + 1)), 9)) for (k, t), n in tf.items())

    def got(found):
        return sorted((str(r.id), r.term, r.tf, r.doc_freq, round(r.tfidf, 9)) for r in found.collect())

    found = text.term_tfidf(df)
    assert got(found) == want
    # a small dictionary comes to the counts, which are not shuffled by term
    once = text.term_tfidf(df.where("id > 1"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(text, "BROADCAST_BYTES", 0)
    assert got(text.term_tfidf(df)) == want
    assert text.term_tfidf(df.limit(0)).count() == 0
