"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chat, decontaminate, language, licenses, middle, near_duplicates, packing, quality, sharding, token_files, toxicity
from .storage import shared_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of a license notice in every document."""
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes a control string, formatted and
    read back."""
    own = r"\### Assistant: </turn> ok"
    extra = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role UNION ALL SELECT -7L, 1L, 'assistant'")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_conversations(turns.unionByName(extra.withColumn("text", F.lit(own))))
    read = done.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        chat.count_blocks(F.col("formatted")).alias("n_blocks"),
    )


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS last_role,
    length(regexp_replace(text, '(\\*<(?:/?turn|next)>)', '\\\1', 'g')) AS escaped,
    length(replace(replace(role, '\', '\\'), chr(10), '\n')) AS role_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(escaped + CASE WHEN last_role = role THEN length('?<next>?') ELSE role_chars + length('<turn>??</turn>?') END) AS BIGINT) AS formatted_chars,
  count(*) FILTER (last_role IS DISTINCT FROM role) AS n_blocks
FROM placed GROUP BY conv_id
"""


QUALITY_COLUMNS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept removed_words".split()


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the line-frequency verdict of every document."""
    return quality.quality(_read(spark, sf_dir, "documents")).select(*QUALITY_COLUMNS)


OP3_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT row, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM docs)),
twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, 5) t(k) GROUP BY row),
raw_lines AS (
  SELECT row, host, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS line_words
  FROM (SELECT row, host, unnest(string_split(text, chr(10))) AS line FROM docs)),
dup AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw_lines WHERE len(line_words) > 0 GROUP BY row),
lines AS (
  SELECT row, host, line, sum(words) AS words FROM (
    SELECT row, host, len(line_words) AS words, substr(md5(translate(array_to_string(line_words, ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), 1, 16) AS line
    FROM raw_lines WHERE len(line_words) > 0) GROUP BY ALL),
sets AS (
  SELECT row, docs.host, coalesce(string_agg(line, '' ORDER BY line), '') AS line_set
  FROM docs LEFT JOIN lines USING (row) GROUP BY row, docs.host),
firsts AS (SELECT host, min(row) AS row FROM sets GROUP BY host, line_set),  -- copies count once
frequent AS (
  SELECT host, line FROM (
    SELECT lines.host, line, count(*) AS n FROM lines JOIN firsts USING (row) GROUP BY lines.host, line)
  JOIN (SELECT host, count(*) AS docs FROM firsts GROUP BY host) USING (host)
  WHERE n > least(50, greatest(2, docs * 0.5))),
removed AS (SELECT row, sum(words) AS n FROM lines JOIN frequent USING (host, line) GROUP BY row),
judged AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(words) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(words) AS base_failed,
    CAST(coalesce(n, 0) AS BIGINT) AS removed_words
  FROM docs LEFT JOIN repeated USING (row) LEFT JOIN dup USING (row) LEFT JOIN removed USING (row))
SELECT *, NOT base_failed AND n_words - removed_words >= n_words * 0.3 AS kept FROM judged
"""

SHARDS = [f"shard-{k:02d}" for k in range(32)]
TABLE_SIZE = 5003


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    placed = sharding.assign_shards(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS, TABLE_SIZE)
    return placed.select("doc_id", "slot", "shard")


OP4_SQL = f"""
WITH RECURSIVE names AS (
  SELECT i, printf('shard-%02d', i) AS name FROM range({len(SHARDS)}) t(i)),
walks AS (
  SELECT list(('0x' || substr(md5(name || '|offset'), 1, 15))::UBIGINT % {TABLE_SIZE} ORDER BY i) AS offsets,
    list(('0x' || substr(md5(name || '|step'), 1, 15))::UBIGINT % {TABLE_SIZE - 1} + 1 ORDER BY i) AS steps FROM names),
claims AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, list_transform(range({TABLE_SIZE}), lambda x: false) AS taken,
    list_transform(range({len(SHARDS)}), lambda x: 0::BIGINT) AS seen
  UNION ALL
  SELECT turn + 1, slot, list_transform(range({TABLE_SIZE}), lambda x: taken[x + 1] OR x = slot),
    list_transform(range({len(SHARDS)}), lambda x: CASE WHEN x = shard THEN walked ELSE seen[x + 1] END)
  FROM (
    SELECT *, (offsets[shard + 1] + walked * steps[shard + 1])::BIGINT % {TABLE_SIZE} AS slot FROM (
      SELECT turn, taken, seen, offsets, steps, turn % {len(SHARDS)} AS shard,
        list_filter(range(seen[turn % {len(SHARDS)} + 1], {TABLE_SIZE}),
          lambda x: NOT taken[((offsets[turn % {len(SHARDS)} + 1] + x * steps[turn % {len(SHARDS)} + 1])::BIGINT % {TABLE_SIZE}) + 1])[1] AS walked
      FROM (SELECT turn, taken, seen FROM claims WHERE turn < {TABLE_SIZE}), walks)))
SELECT doc_id, hashed AS slot, printf('shard-%02d', (turn - 1) % {len(SHARDS)}) AS shard
FROM (SELECT doc_id, CAST(('0x' || substr(md5(coalesce('=' || doc_id::VARCHAR, 'null')), 1, 8))::UBIGINT % {TABLE_SIZE} AS BIGINT) AS hashed
  FROM documents) JOIN claims ON slot = hashed
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learnt from rows not held out."""
    scored = toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


TOKENIZER = "word_bpe_49k.json"


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the automaton."""
    done = bpe.encode_decode(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from rows that are not held out."""
    documents = _read(spark, sf_dir, "documents")
    names, model = language.learn(language.teaching(documents))
    found = language.identify(documents, names, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    done = decontaminate.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP8_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
cut AS (
  SELECT DISTINCT item, least(len(words), 13) AS size, array_to_string(words[i:i + 12], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM cut),
spread AS (
  SELECT row, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT row, i, size, item FROM spread JOIN cut USING (size, win)),
hit AS (
  SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS place FROM hits) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to files, and read from them."""
    documents = _read(spark, sf_dir, "documents")
    path = token_files.write_documents(documents, public_tokenizers.path(TOKENIZER), 1, shared_folder(spark))
    return token_files.read_documents(spark, path)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, by piece."""
    pieces = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters, step by step, per language."""
    return audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT d.row, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {
    'A': len(words) < 100,
    'B': 100 * len(list_distinct(words)) < 80 * len(words),
    'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS fails
  FROM docs d LEFT JOIN marks m ON d.doc_id = m.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
kinds AS (
  SELECT part, array_to_string(list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: fails[f]), '') AS failed, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY ALL),
ends AS (  -- the step that removes a kind of document, 6 if none does
  SELECT part, filter_order, failed, n, good, toxic,
    coalesce(list_min([instr(filter_order, f) for f in string_split(failed, '') if f <> '']), 6) AS gone
  FROM kinds, orders),
stepwise AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f,
    sum(n) FILTER (gone > step) AS kept,
    sum(n) FILTER (gone = step) AS removed,
    sum(n) FILTER (gone < step AND contains(failed, substr(filter_order, step, 1))) AS redundant,
    sum(n) FILTER (failed = substr(filter_order, step, 1)) AS unique_fails,
    sum(good) FILTER (gone = step) AS good_lost,
    sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM ends, range(1, 6) t(step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM stepwise
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-middle form, and the text read back."""
    done = middle.fill_in_middle(_read(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::UBIGINT % (len(units) + 1) AS c1, ('0x' || substr(h, 9, 8))::UBIGINT % (len(units) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR ('0x' || substr(h, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM docs),
cut AS (
  SELECT *, array_to_string(units[1:least(c1, c2)::BIGINT], '') AS p, array_to_string(units[greatest(c1, c2)::BIGINT + 1:], '') AS s,
    array_to_string(units[least(c1, c2)::BIGINT + 1:greatest(c1, c2)::BIGINT], '') AS m FROM drawn)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_chat_format": op2_chat_format,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_language": op7_language,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_token_files": op10_token_files,
    "op11_packing": op11_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE = {
    "op2_chat_format": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op4_sharding": OP4_SQL,
    "op8_decontaminate": OP8_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
