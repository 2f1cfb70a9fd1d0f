"""Licenses, language and toxicity against brute force and held-out rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import language, licenses, queries, toxicity

NOTICE = "Licensed under the Apache License, Version 2.0."


# -- licenses ---------------------------------------------------------------


def brute_alignment(template, document):
    """Local alignment over the whole matrix, without a band."""
    score = np.zeros((len(template) + 1, len(document) + 1), int)
    path = {}
    best = (0, None)
    for i, a in enumerate(template, 1):
        for j, b in enumerate(document, 1):
            options = [(score[i - 1, j - 1] + (2 if a == b else -1), (i - 1, j - 1)), (score[i - 1, j] - 1, (i - 1, j)), (score[i, j - 1] - 1, (i, j - 1))]
            value, path[i, j] = max(options, key=lambda o: o[0])
            score[i, j] = max(0, value)
            if value > best[0]:
                best = value, (i, j)
    if best[1] is None:
        return 0, 0, 0
    (i, j), end, matched = best[1], best[1][1], 0
    while score[i, j] > 0:
        at = path[i, j]
        matched += at == (i - 1, j - 1) and template[i - 1] == document[j - 1]
        i, j = at
    return matched, j, end


def longest_run(a, b):
    last, most = [0] * (len(b) + 1), 0
    for x in a:
        here = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            here[j] = last[j - 1] + 1 if x == y else 0
        most, last = max(most, *here), here
    return most


def spoil(rng, words):
    out = []
    for w in words:
        r = rng.random()
        if r < 0.04:
            continue
        out += [w, "extra"] if r > 0.97 else ["other"] if r > 0.94 else [w]
    return out


def test_scan_equals_full_alignment():
    rng = random.Random(2)
    index = licenses.Index(licenses.default_templates())
    for _ in range(60):
        t = rng.randrange(len(index.words))
        noise = lambda: [f"n{rng.randrange(50)}" for _ in range(rng.randrange(30))]
        words = noise() + spoil(rng, index.words[t]) + noise()
        got = {m[0]: m[1:] for m in licenses.scan_words(index, words, 0.8)}
        matched, start, end = brute_alignment(index.words[t], words)
        if matched < 0.8 * len(index.words[t]):
            assert t not in got
        elif t in got or longest_run(index.words[t], words) >= licenses.GRAM + licenses.WINDOW - 1:
            assert got[t] == (matched, start, end)


def test_every_shared_run_is_a_candidate():
    rng = random.Random(3)
    index = licenses.Index(licenses.default_templates())
    run = licenses.GRAM + licenses.WINDOW - 1
    for _ in range(300):
        t = rng.randrange(len(index.words))
        at = rng.randrange(max(1, len(index.words[t]) - run + 1))
        words = ["x"] * rng.randrange(4) + index.words[t][at : at + run] + ["x"] * rng.randrange(4)
        ids = np.array([index.number.get(w, 0) for w in words], "u8")
        assert t in {c[0] for c in index.candidates(ids)}


def test_license_rows(spark):
    long = "word " * 30000 + NOTICE + " word" * 30000
    rows = [
        (1, f"A.\n{NOTICE}\nB"), (2, None), (3, ""), (4, "the License"), (5, long), (None, NOTICE.upper()), (1, f"A.\n{NOTICE}\nB"),
        (6, f"{NOTICE} and again: {NOTICE}"), (7, "Licensed under the Apache ©License; Version, 2.0"), (8, "Licensed under CC BY 4.0"),
        (9, licenses.TEMPLATES["Apache-2.0"][1]), (10, "Released under the MIT License. " * 500),
    ]
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, license string")
    got = licenses.scan(df).collect()
    found = sorted((r.doc_id or 0, r.license, r.start, r.end) for r in got)
    assert [f[2] for f in found if f[0] == 10] == [32 * k for k in range(500)]
    found = [f for f in found if f[0] != 10]
    assert [f[:2] for f in found] == [
        (0, "Apache-2.0"), (1, "Apache-2.0"), (1, "Apache-2.0"), (5, "Apache-2.0"), (6, "Apache-2.0"), (6, "Apache-2.0"),
        (7, "Apache-2.0"), (8, "CC-BY-4.0"), (9, "Apache-2.0"),
    ]
    assert found[1][2:] == (3, 3 + len(NOTICE) - 1) and found[3][2] == 150000
    assert all(r.span == dict_text(rows, r.doc_id)[r.start : r.end] for r in got)
    assert licenses.scan(df.limit(0)).count() == 0
    held = {r.doc_id: r.licenses for r in licenses.by_document(df, licenses.scan(df)).collect()}
    assert held[2] == [] and held[6] == ["Apache-2.0"] and held[None] == ["Apache-2.0"]


def dict_text(rows, doc_id):
    return next(t for d, t in rows if d == doc_id)


def test_largest_equals_all_pairs():
    rng = random.Random(8)
    sizes = [3, 5, 9]
    for _ in range(300):
        matches = [(rng.randrange(3), rng.randrange(1, 6), b, b + rng.randrange(1, 9)) for b in (rng.randrange(20) for _ in range(rng.randrange(12)))]
        kept = []
        for m in sorted(matches, key=lambda m: (-m[1], sizes[m[0]], m[2], m[0])):
            if not any(o[2] <= m[2] and m[3] <= o[3] for o in kept):
                kept.append(m)
        assert licenses.largest(matches, sizes) == sorted(kept, key=lambda m: (m[2], m[3], m[0]))


def test_each_template_is_found_as_its_own(spark):
    """Similar notices (GPL, LGPL, AGPL; BSD with two and three clauses) are told apart."""
    templates = licenses.default_templates()
    df = spark.createDataFrame([(k, f"some code\n{t}\nmore code") for k, (_, t) in enumerate(templates)], "doc_id long, text string")
    rows = licenses.scan(df).collect()
    for k, (name, _) in enumerate(templates):
        best = [r for r in rows if r.doc_id == k and r.template == k]
        assert len(best) == 1 and best[0].license == name and best[0].coverage == 1.0
        assert {r.license for r in rows if r.doc_id == k} == {name}
    assert licenses.scan(df, []).count() == 0 and licenses.scan(df, []).columns == licenses.scan(df).columns


def test_templates_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(1, NOTICE), (2, "Released under the MIT License.")], "doc_id long, text string")
    whole = sorted(map(tuple, licenses.scan(df).collect()))
    monkeypatch.setattr(licenses, "BLOCK_WORDS", 1)
    apart = sorted(map(tuple, licenses.scan(df).collect()))
    assert whole == apart and len(whole) == 2
    with pytest.raises(ValueError):
        licenses.Index([("short", "two words")])


def test_op1_finds_each_notice(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {(r.doc_id, r.license) for r in queries.op1_license_scan(spark, sf_dir).collect()}
    for name, texts in licenses.TEMPLATES.items():
        want = {(r.doc_id, name) for r in docs.where(F.contains("text", F.lit(texts[0].rstrip(".")))).collect()}
        assert want <= got


# -- language ---------------------------------------------------------------


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.col("n_chars"))
    rows = queries.op7_language(spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def brute_likelihood(words, share):
    return float(np.log((np.exp(words) * share).sum(axis=1)).sum())


def test_mixture_equals_grid_search():
    rng = np.random.default_rng(1)
    for truth in (0.0, 0.3, 0.5):
        words = np.where(rng.random((200, 1)) < truth, [-6.0, -2.0], [-2.0, -6.0]) + rng.normal(0, 0.5, (200, 2))
        chosen, share = language.infer(words, 3.0)
        grid = max(np.linspace(0.001, 0.999, 999), key=lambda p: brute_likelihood(words, [1 - p, p]))
        if truth:
            assert sorted(chosen) == [0, 1] and abs(dict(zip(chosen, share))[1] - grid) < 0.01
        else:
            assert chosen == [0]


def test_language_rows(spark):
    teach = [(i, "the cat and the dog of the house", "en") for i in range(20)] + [(i, "der hund und die katze im haus", "de") for i in range(20, 40)]
    odd = [(50, None, "en"), (51, "", None), (52, "12 !?", "en"), (None, "the dog and the cat", "de"), (53, "der hund und die katze", None), (53, "the cat of the house", None)]
    mixed = [(60, "the cat and the dog of the house " * 20 + "der hund und die katze im haus " * 20, None), (61, "the cat " * 20000, None)]
    df = spark.createDataFrame([(*r, 0.0) for r in teach + odd + mixed], "doc_id long, text string, lang string, score double")
    names, model = language.learn(language.teaching(df))
    assert names == ["de", "en"]
    got = {(r.doc_id, r.lang_pred): r for r in language.identify(df, names, model).collect()}
    assert {(50, "und"), (51, "und"), (52, "und"), (None, "en"), (53, "de"), (53, "en"), (61, "en")} <= set(got)
    both = next(r for k, r in got.items() if k[0] == 60)
    assert sorted(x.lang for x in both.languages) == ["de", "en"] and 0.4 < both.score < 0.6
    names, model = language.learn(language.teaching(df.limit(0)))
    assert {r.lang_pred for r in language.identify(df, names, model).collect()} == {"und"}
    assert language.identify(df.limit(0), names, model).count() == 0


def test_trigrams_stay_in_their_text():
    texts = ["ab c", "", "ÉÀ ", "x", " 1y2"]
    grams, starts, counts = language.trigrams(texts)
    assert counts.tolist() == [3, 0, 2, 1, 1] and starts.tolist() == [True, False, True, True, False, True, True]
    apart = np.concatenate([language.trigrams([t])[0] for t in texts])
    assert (grams == apart).all()


# -- toxicity ---------------------------------------------------------------


def test_features_stay_in_their_text():
    texts = ["Idiot, idiots a", "", "É1x " * 3, "abcdefghijklmnop abcdefghijklmnoq"]
    found, doc = toxicity.features(texts)
    for k, t in enumerate(texts):
        assert sorted(found[doc == k]) == sorted(toxicity.features([t])[0])
    words = {w: set(toxicity.features([w])[0]) for w in ("idiot", "idiots", "id", "xid")}
    assert len(words["idiot"]) == 3 and len(words["id"]) == 1 and len(words["idiots"] & words["idiot"]) == 2
    vocabulary = np.sort(toxicity.features(["idiot"])[0])
    assert [x.tolist() for x in toxicity.known_features(texts, vocabulary)][1:] == [[], [], []]


def test_risk_gradient_and_training():
    rng = np.random.default_rng(0)
    toxic = rng.random(3000) < 0.15
    rows = [[0] * int(y and rng.random() < 0.9) + [1] * int(rng.random() < 0.5) for y in toxic]
    positive, other = toxicity.Rows([r for r, y in zip(rows, toxic) if y][:200], 2), toxicity.Rows(rows, 2)
    weights = toxicity.train(positive, other, 0.15)
    assert weights[0] > 2 and abs(weights[1]) < 0.5 and weights[-1] < -2
    for sign in (1.0, -1.0):
        at = np.array([0.3, -0.2, 0.1])
        _, slope = other.risk(other.margins(at), sign)
        for k in range(3):
            step = np.eye(3)[k] * 1e-5
            change = other.risk(other.margins(at + step), sign)[0] - other.risk(other.margins(at - step), sign)[0]
            assert abs(change / 2e-5 - slope[k]) < 1e-6


def toxic_tables(spark, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        y = rng.random() < 0.15
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('ijkl')}" for _ in range(rng.randrange(3, 40))]
        if y:
            words[1] = rng.choice(["idiotaa", "idiotbb", "idiotcc"])
        docs.append((i, " ".join(words), 1))
        if rng.random() < 0.6:
            labels.append((i, int(y)))
    odd = [(9001, None, 1), (9002, "", 1), (None, "idiotaa", 1), (9003, "w " * 20000 + "idiotbb", 1), (9004, "same", 1), (9004, "idiotaa", 1)]
    labels += [(9001, None), (None, 1), (9002, None), (3, 0), (3, 0), (99999, 1)]
    kinds = "doc_id long, text string, score int", "doc_id long, toxic int"
    return spark.createDataFrame(docs + odd, kinds[0]), spark.createDataFrame(labels, kinds[1]), docs


def test_toxicity_rows(spark):
    documents, labels, docs = toxic_tables(spark)
    got = toxicity.toxicity(documents, labels)
    assert got.columns == ["doc_id", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 606 and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.predicted)
    assert all(by[d] == [int("idiot" in t)] for d, t, _ in docs)
    assert by[9001] == by[9002] == [0] and by[None] == by[9003] == [1] and sorted(by[9004]) == [0, 1]
    none = toxicity.toxicity(documents, labels.where("toxic = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.toxicity(documents.limit(0), labels).count() == 0
    assert toxicity.toxicity(documents, labels.limit(0)).count() == 606


def test_held_out_labels_are_not_used(spark):
    documents, labels, _ = toxic_tables(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    read = lambda y: sorted((r.doc_id or -1, r.score) for r in toxicity.toxicity(documents, y).collect())
    assert read(labels) == read(turned)


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, sf).join(truth, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(r.predicted for r in rows if r.toxic) >= 0.6 * (len(rows) - len(clean)) and sum(clean) <= 0.15 * len(clean)
