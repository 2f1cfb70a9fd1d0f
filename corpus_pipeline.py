"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

1. quality: documents that fail the base rules or are depleted go; of the
   others the lines above the limit go (``n_chars`` follows).
2. language: documents whose language stays undetermined go, which are those
   without a letter, also where no row has a label.  All learnt languages pass.
3. near_duplicates: of each group one document stays.
4. decontamination: contaminated documents go.
5. tokens: what is left, encoded and decoded.

Rows are judged by id and text: different texts under one id apart, repeated
rows alike until stage 3 leaves one of them.  That stage keeps the smallest id
of a group; a row without an id stays only where the group has no id at all.
Null and empty texts go in stage 1.  An empty table stays empty in each stage;
further columns of any name come through as they are.

ORACLE_SQL is None: language identification (a trained mixture) and the
tokenizer cannot be written in SQL.  ``tests/llm/test_pipeline.py`` holds each
stage against brute force instead.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm import bpe, decontaminate, language, near_duplicates, quality
from sparkwright.llm.queries import TOKENIZER
from sparkwright.llm.storage import shared_folder


def _key(doc_id: Column, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the id and the text's md5 in place of the id, so that
    different texts under one id are judged apart; ids before no id."""
    digest = F.md5(F.coalesce("text", F.lit("")))
    none = F.col("doc_id").isNull()
    return docs.withColumn("doc_id", F.struct(none.alias("none"), F.col("doc_id").alias("id"), digest.alias("md5")))


def _keep(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are in ``judged``."""
    kept = judged.select(_key(F.col("doc_id.id"), F.col("doc_id.md5")).alias("key")).distinct()
    own = _key(docs["doc_id"], F.md5(F.coalesce(docs["text"], F.lit(""))))
    return docs.join(kept, own == kept["key"], "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = quality.clean(docs).where("kept")
    changed = F.size("removed_lines") > 0
    new = {
        "text": F.col("clean_text"),
        "n_chars": F.when(changed, F.char_length("clean_text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names, model = language.learn(language.teaching(docs))
    if not names:  # no row teaches: judged by the text alone
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(_keyed(docs), names, model)
    return _keep(docs, found.where(F.col("lang_pred") != language.UNDETERMINED))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = _keep(docs, near_duplicates.near_duplicates(_keyed(docs)).where("kept"))
    return kept.dropDuplicates(["doc_id", "text"])  # copies under one id


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _keep(docs, decontaminate.decontaminate(_keyed(docs), benchmark).where("NOT contaminated"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; tables between them go to the shared
    folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
