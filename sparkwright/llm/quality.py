"""Quality rules: cross-document line frequency.

A document's lines are normalised (its words joined by one space, A-Z in lower
case) and hashed.  Per host, each line's distinct documents are counted; lines
above the limit are boilerplate.  They are removed, and a document that keeps
too small a part of its words is depleted and rejected.  ``quality`` returns the
counts and verdicts, ``clean`` the texts without those lines.

Copies of one document would make all of its lines look like boilerplate and
be rejected together, original included.  So documents of one host with the
same set of lines count once; any other document counts as itself.

A line is above the limit if more than ``min(min_docs, max(few, small_share *
docs))`` of the ``docs`` documents of its host have it, copies counted once on
both sides: an absolute limit however large the host is, and a share of a small
one.

Words are runs of ``[^\\x20\\x09-\\x0D]``; a few counts per document and rules
on them (``base_failed``) come along from the same pass.

Scale: one pass over the texts writes a row per document with its line hashes
to the shared folder; only hashes are shuffled.  ``clean`` reads the texts a
second time and joins them with their verdicts by id, host and md5 of the text.  Counts are combined before
each shuffle, and the join with the frequent lines is on (host, line), whose
skew Spark splits.

Defined results: a null text has no words and fails the base rules; a null
host is a host of its own; repeated rows and equal ids keep a row each; an
empty table gives an empty result; other columns are ignored, whatever their names
(``clean`` carries them in a struct).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from .storage import make_importable, settle

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW = 5
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], "u8")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashed = np.fromiter(map(hash, words), "i8", len(words)).view("u8")
    windows = sum(hashed[k : k + n] * _MIX[k] for k in range(WINDOW))
    ordered = np.sort(windows)
    if not (twice := ordered[1:][ordered[1:] == ordered[:-1]]).size:
        return 0
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(windows, twice)).tolist():
        places.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    inside = np.zeros(len(words), bool)
    for at in places.values():
        if len(at) > 1:
            for i in at:
                inside[i : i + WINDOW] = True
    return int(inside.sum())


def line_hash(line: bytes) -> int:
    """First 64 bits of the md5, shifted so that signed order is hex order."""
    return int.from_bytes(md5(line).digest()[:8], "big") - (1 << 63)


def normal_hash(words: list[bytes]) -> int:
    """Hash of the normalised line of these words."""
    return line_hash(b" ".join(words).lower())


def line_table(lines: list[bytes]) -> list[tuple[int, int]]:
    """Per distinct normalised line: hash, and words in all its occurrences."""
    counts: dict[int, int] = {}
    for line in lines:
        words = line.split()
        if words:
            h = normal_hash(words)
            counts[h] = counts.get(h, 0) + len(words)
    return list(counts.items())


def split_text(text: str, frequent: set[int]) -> tuple[str, list[str]]:
    """The text without its frequent lines, and those lines as they stood."""
    left, gone = [], []
    for line in text.split("\n"):
        words = line.encode().split()
        (gone if words and normal_hash(words) in frequent else left).append(line)
    return "\n".join(left), gone


def set_hash(table: list[tuple[int, int]]) -> bytes:
    """128 bits of the set of a document's lines."""
    return md5(np.sort(np.array([h for h, _ in table], "i8")).tobytes()).digest()


def measure(text: str | None) -> tuple:
    """Counts of one text, and its line table."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = data.split(b"\n")
    seen: set[bytes] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, dup, repeated_words(words), line_table(lines)


_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def measure_documents(documents: DataFrame, host: str = "source") -> DataFrame:
    """One pass: counts, ``lines`` (line, words) and ``line_set`` per document."""
    make_importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = list(zip(*map(measure, part.column(2).to_pylist())))
                values = [pa.array(c, pa.int64()) for c in columns[:5]]
                lines = pa.array([[dict(zip(("line", "words"), x)) for x in c] for c in columns[5]], _LINES)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *values, lines, pa.array(map(set_hash, columns[5]), pa.binary())],
                    ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_set"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col(host).cast("string").alias("host"), "text").mapInArrow(
        run,
        f"doc_id {kind}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, lines array<struct<line:long,words:long>>, line_set binary",
    )


def frequent_lines(lines: DataFrame, hosts: DataFrame, min_docs: int, small_share: float, few: int) -> DataFrame:
    """``host, line`` above their host's limit. ``lines`` has a row per line
    and distinct document, ``hosts`` has ``host, docs`` (distinct ones)."""
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("docs_with")).where(F.col("docs_with") > min(few, min_docs))
    limit = F.least(F.lit(float(min_docs)), F.greatest(F.lit(float(few)), F.col("docs") * small_share))
    return counts.join(hosts, "host").where(F.col("docs_with") > limit).select("host", "line")


def _judge(
    documents: DataFrame, host: str, min_docs: int, small_share: float, few: int, least_left: float, min_words: int, max_repeated: float
) -> DataFrame:
    """``quality`` with ``frequent``, the hashes of a document's frequent lines."""
    measured = measure_documents(documents, host)
    measured = settle(
        measured.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("row", F.monotonically_increasing_id())
    )
    lines = measured.select("row", "host", F.inline("lines"))
    distinct = measured.groupBy("host", "line_set").agg(F.min("row").alias("row"))
    hosts = distinct.groupBy("host").agg(F.count("*").alias("docs"))
    counted = measured.join(distinct.select("row"), "row", "left_semi").select("host", F.inline("lines"))
    frequent = frequent_lines(counted, hosts, min_docs, small_share, few)
    removed = lines.join(frequent, ["host", "line"]).groupBy("row").agg(
        F.sum("words").alias("removed_words"), F.collect_list("line").alias("frequent")
    )
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > F.col("n_words") * max_repeated)
    left = F.col("n_words") - F.col("removed_words")
    judged = measured.drop("lines", "line_set", "host").join(removed, "row", "left").drop("row")
    judged = judged.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (left >= F.col("n_words") * least_left)
    )


def quality(
    documents: DataFrame,
    host: str = "source",
    min_docs: int = 50,
    small_share: float = 0.5,
    few: int = 2,
    least_left: float = 0.3,
    min_words: int = 10,
    max_repeated: float = 0.2,
) -> DataFrame:
    """Per document its counts, ``base_failed``, ``removed_words`` and ``kept``."""
    return _judge(documents, host, min_docs, small_share, few, least_left, min_words, max_repeated).drop("frequent")


def clean(
    documents: DataFrame,
    host: str = "source",
    min_docs: int = 50,
    small_share: float = 0.5,
    few: int = 2,
    least_left: float = 0.3,
    min_words: int = 10,
    max_repeated: float = 0.2,
) -> DataFrame:
    """``row`` (all columns of a document, as a struct), ``clean_text,
    removed_lines, kept`` per document: its text without the lines above the
    limit, and those lines in order.  ``clean_text`` of a null text is null."""
    make_importable(documents.sparkSession)
    own = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("row"),
        F.col("text"),
        F.to_json(F.struct("doc_id", F.col(host).cast("string").alias("host"), F.md5("text").alias("md5"))).alias("key"),
    )
    keyed = own.select(F.col("key").alias("doc_id"), F.col(f"row.{host}").alias("host"), "text")
    judged = _judge(keyed, "host", min_docs, small_share, few, least_left, min_words, max_repeated)
    # rows of one key have one text and host, so one verdict
    verdicts = judged.select(F.col("doc_id").alias("key"), "kept", "frequent").dropDuplicates(["key"])
    fields = [own.schema["row"], *DataType.fromDDL("clean_text string, removed_lines array<string>, kept boolean").fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text").to_pylist(), batch.column("frequent").to_pylist()
            done = [split_text(t, set(f)) if f else (t, []) for t, f in zip(texts, found)]
            columns = [batch.column("row"), pa.array([t for t, _ in done], pa.string()), pa.array([g for _, g in done], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("kept")], [f.name for f in fields])

    joined = own.join(verdicts, "key").select("row", "text", "kept", "frequent")
    return joined.mapInArrow(run, StructType(fields))
