"""Each stage of the corpus pipeline against brute force on its own input."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkwright.llm import language

from .test_native import brute_hits
from .test_near import brute_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input of each stage and the result, as lists of rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
        out[name + " columns"] = docs.columns
    return out


def test_columns_and_registration(spark, sf_dir, stages):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    names = [n for n, _ in corpus_pipeline.STAGES]
    for n in names[:-1]:
        assert stages[n + " columns"] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, stages[names[-1]]))


def brute_quality(rows):
    """``doc_id, text`` of the rows that stay, from lists of lines."""
    by_host = {}
    for r in rows:
        table = [(line, tuple(line.lower().split())) for line in (r.text or "").split("\n")]
        by_host.setdefault(r.source or "", []).append((r, table, frozenset(w for _, w in table if w)))
    out = []
    for docs in by_host.values():
        sets = {lines for _, _, lines in docs}
        seen = Counter(line for lines in sets for line in lines)
        limit = min(50, max(2, len(sets) * 0.5))
        for r, table, _ in docs:
            words = (r.text or "").split()
            windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
            inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
            left = [line for line, w in table if not (w and seen[w] > limit)]
            n_left = sum(len(line.split()) for line in left)
            if len(words) >= 10 and 100 * len(inside) <= 20 * len(words) and n_left >= len(words) * 0.3:
                out.append((r.doc_id, "\n".join(left)))
    return out


def test_quality_stage(stages):
    assert sorted((r.doc_id, r.text) for r in stages["quality"]) == sorted(brute_quality(stages["documents"]))
    assert len(stages["quality"]) > 0.7 * len(stages["documents"])


def test_language_stage(stages):
    assert sorted(stages["language"]) == sorted(r for r in stages["quality"] if any(c.isalpha() for c in r.text))


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages["language"]]
    kept = {d for d, _, _, keep in brute_groups(rows) if keep}
    assert sorted(stages["near_duplicates"]) == sorted(r for r in stages["language"] if r.doc_id in kept)
    assert len(kept) < len(rows)


def test_decontamination_stage(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {h[0] for h in brute_hits([(r.doc_id, r.text) for r in stages["near_duplicates"]], items) if not h[-1]}
    assert sorted(stages["decontamination"]) == sorted(r for r in stages["near_duplicates"] if r.doc_id in clean)


def test_token_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in stages["tokens"]}
    assert len(got) == len(stages["decontamination"])
    for r in stages["decontamination"]:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_with_odd_rows(spark, sf_dir, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"wort{rng.randrange(10**6)}" for _ in range(n))
    same, long = text(40), text(30000)
    rows = [
        (1, None), (2, ""), (3, " ".join(map(str, range(40)))), (4, same), (4, same), (4, text(40)), (None, text(40)), (None, same), (None, None),
        (5, same + " more"), (6, long), (7, text(12)), (8, long),
    ]
    df = spark.createDataFrame([(d, t, "de", None, 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = df
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = spark.read.parquet(str(tmp_path / "decontamination")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(4, same), (4, rows[5][1]), (0, rows[6][1]), (6, long), (7, rows[11][1])])
    docs = df.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
    assert language.UNDETERMINED == "und"


def test_quality_stage_passes_clean_texts(spark, sf_dir):
    menu = "Home About us and all the other pages of this site"
    own = [" ".join(f"o{k}w{i}" for i in range(20)) for k in range(60)]
    rows = [(k, f"{menu}\n{x}", "de", "h", len(menu) + 1 + len(x)) for k, x in enumerate(own)] + [(99, f"{menu}\nok", "de", "h", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, corpus_pipeline.quality_stage(spark, docs, sf_dir).collect()))
    assert got == [(k, x, "de", "h", len(x)) for k, x in enumerate(own)]


EXTRA = "host key row kept clean_text removed_lines _key _kept frequent cls node component family id none md5 words window n".split()


@pytest.mark.parametrize("stage", range(5))
def test_clashing_columns_and_empty_tables(spark, sf_dir, stage):
    """Each stage alone: further columns come through, or do no harm."""
    name, run = corpus_pipeline.STAGES[stage]
    text = lambda k: " ".join(f"wort{k}x{i}" for i in range(40))
    rows = [(k, text(k), "de", "h", len(text(k))) for k in range(5)] + [(9, text(1), "de", "h", 1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = plain.withColumns({c: F.lit(f"my {c}") for c in EXTRA})
    want, got = run(spark, plain, sf_dir), run(spark, clash, sf_dir)
    if name != "tokens":
        assert got.columns == clash.columns
        assert all(r[c] == f"my {c}" for r in got.collect() for c in EXTRA)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert want.count() == (5 if name == "near_duplicates" else 6)
    assert run(spark, clash.limit(0), sf_dir).count() == 0


def test_language_stage_without_labels(spark, sf_dir):
    rows = [(1, "ein Text", None), (2, "12 34", None), (3, "слово", None), (4, None, None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, corpus_pipeline.language_stage(spark, docs, sf_dir).collect())) == [rows[0], rows[2]]
