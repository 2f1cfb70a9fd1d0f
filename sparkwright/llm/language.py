"""Language identification by multilingual mixture inference.

Learning counts letter trigrams per language over all labelled texts (each
letter with its neighbours, a blank at a word's ends; hashed to ``BUCKETS``).
A word's likelihood in a language is the product over its trigrams.

A document is a mixture: each word comes from one of a set of languages in
unknown proportions.  Expectation-maximisation estimates the proportions; the
set grows by one language at a time, the one that raises the likelihood most,
as long as the rise exceeds the penalty (``penalty`` * ln(words) for each
further language).  The likelihood is concave in a new language's proportion,
so a language whose slope at zero is not positive needs no trial.

Scale: two passes over the texts, no shuffle of texts.  Each task adds up its
counts before the shuffle; the model has languages x ``BUCKETS`` numbers,
whatever the corpus, and is sent along with the tasks.  The number of distinct
labels is the only thing that makes it grow.

Defined results: a null text, a text without a letter, or no labelled text at
all gives ``und`` with score 0; rows with a null label or id teach nothing;
repeated rows stay (and teach each time); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import make_importable

BUCKETS = 1 << 15
UNDETERMINED = "und"
_LETTER: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all letters of all texts: trigram bucket, whether a word starts
    there, and the letters' number per text."""
    texts = [t.lower() for t in texts]
    joined = " ".join(texts)
    codes = np.frombuffer(f" {joined} ".encode("utf-32-le"), "u4").astype("u8")
    letter = _is_letter()[codes]
    codes = np.where(letter, codes, 32)
    at = np.flatnonzero(letter)
    mixed = codes[at - 1] * np.uint64(0x9E3779B97F4A7C15) + codes[at] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[at + 1] * np.uint64(0x165667B19E3779F9)
    lengths = [len(t) + 1 for t in texts]
    ends = np.cumsum(lengths)
    counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends]) + 1))
    return (mixed >> np.uint64(64 - 15)).astype("i4"), ~letter[at - 1], counts


def learn(labelled: DataFrame, label: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log-likelihoods (languages x ``BUCKETS``) from ``text``
    and ``label``."""
    make_importable(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts: dict[str, list[str]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    texts.setdefault(lang, []).append(text)
                for lang, group in texts.items():
                    found = np.bincount(trigrams(group)[0], minlength=BUCKETS)
                    sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(found[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    rows = labelled.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).alias("lang"), "text")
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    found = np.zeros((len(names), BUCKETS))
    place = {x: i for i, x in enumerate(names)}
    found[[place[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    smooth = found + 0.05
    return names, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype("f4")


def fit_mixture(likelihood: np.ndarray, start: np.ndarray, rounds: int = 50, enough: float = 1e-4) -> np.ndarray:
    """Proportions by expectation-maximisation; words x languages."""
    share = start
    for _ in range(rounds):
        weighted = likelihood * share
        new = (weighted / weighted.sum(axis=1, keepdims=True)).mean(axis=0)
        moved = np.abs(new - share).max()
        share = new
        if moved < enough:
            break
    return share


def infer(words: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """Language set and proportions from words x languages log-likelihoods."""
    scaled = np.exp(np.maximum(words - words.max(axis=1, keepdims=True), -60.0).astype("f8"))
    chosen = [int(words.sum(axis=0, dtype="f8").argmax())]
    share = np.ones(1)
    mixed = scaled[:, chosen[0]]
    cost = penalty * np.log(len(words) + 1)
    while len(chosen) < words.shape[1]:
        slope = (scaled / mixed[:, None] - 1).sum(axis=0)
        best = None
        for k in np.flatnonzero(slope > cost).tolist():  # the rise is at most the slope
            if k in chosen:
                continue
            some = [*chosen, k]
            tried = fit_mixture(scaled[:, some], np.append(share * 0.9, 0.1))
            blend = scaled[:, some] @ tried
            rise = float(np.log(blend / mixed).sum())
            if rise > cost and (best is None or rise > best[0]):
                best = rise, some, tried, blend
        if best is None:
            break
        _, chosen, share, mixed = best
    return chosen, share


def identify(documents: DataFrame, names: list[str], model: np.ndarray, penalty: float = 3.0) -> DataFrame:
    """``doc_id, lang_pred, score, languages``: the largest language, its
    share, and the chosen set as ``array<struct<lang, share>>``."""
    make_importable(documents.sparkSession)
    table = np.ascontiguousarray(model.T)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def one(words: np.ndarray) -> tuple[str, float, list[dict]]:
        chosen, share = infer(words, penalty)
        order = np.argsort(-share, kind="stable")
        found = [{"lang": names[chosen[i]], "share": float(share[i])} for i in order]
        return found[0]["lang"], min(1.0, found[0]["share"]), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                grams, starts, counts = trigrams([t or "" for t in part.column(1).to_pylist()])
                out, begin = [], 0
                for n in counts.tolist():
                    if n and names:
                        letters = table[grams[begin : begin + n]]
                        out.append(one(np.add.reduceat(letters, np.flatnonzero(starts[begin : begin + n]), axis=0)))
                    else:
                        out.append((UNDETERMINED, 0.0, []))
                    begin += n
                lang, score, found = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(found, kind)],
                    ["doc_id", "lang_pred", "score", "languages"],
                )

    key = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    )


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def teaching(documents: DataFrame) -> DataFrame:
    return documents.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
