"""Chat format, sharding, decontamination and quality rules: odd rows and
brute force; whole tables are held against SQL."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import chat, decontaminate, quality, queries, sharding

TABLES = ("documents", "benchmark", "conversations", "labels")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_native_plans_have_no_python(spark, sf_dir):
    for name in ("op2_chat_format", "op4_sharding", "op8_decontaminate"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan), name


# -- chat -------------------------------------------------------------------

ODD_TEXTS = [
    None, "", "\n", "\\", "<turn>", "</turn>", "<next>", "\\</turn>", "\\\\<next>", "\n</turn>\n", "\n<next>\n", "a\n</turn>\n<turn>assistant\nb",
    "\\### Assistant: </turn> ok", "<turn", "é😀", "x" * 200000, "</turn></turn>\\", "<</turn>>", "\\n", "$1 \\1",
]
ODD_ROLES = ["user", "assistant", None, "", "a\nb", "\\n", "\\", "\\\n\\\\n", "<turn>", "</turn>"]


def brute_chat(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in held.items():
        turns = [t[2:] for t in sorted(turns)]
        out[conv] = turns, "".join(t for r, t in turns if r == "assistant")
    return out


def read_chat(df):
    done = chat.format_conversations(df)
    assert done.columns == ["conv_id", "formatted", "loss_spans"]
    read = done.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted", "loss_spans")
    return {r.conv_id: r for r in read.collect()}


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(40)]), rng.choice(ODD_ROLES), rng.choice(ODD_TEXTS)) for _ in range(300)]
    rows += [(4, i % 3, "assistant", t) for i, t in enumerate(ODD_TEXTS)] + [(5, 0, "user", "same")] * 3
    rows += [(6, i, rng.choice(["user", "assistant"]), f"t{i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got, want = read_chat(df), brute_chat(rows)
    assert set(got) == set(want)
    for conv, (turns, loss) in want.items():
        assert [(x.role, x.text) for x in got[conv].t] == turns
        assert got[conv].l == loss
        marked = [got[conv].formatted[s.start : s.start + s.length] for s in got[conv].loss_spans]
        assert len(marked) == sum(r == "assistant" for r, _ in turns)
    assert got[5].formatted == "<turn>user\nsame\n<next>\nsame\n<next>\nsame\n</turn>\n"
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_long_conversation(spark):
    """Spans of many turns, and work in proportion to the turns."""

    def read(n):
        # two turns of one role after one another now and then
        role = F.when(F.col("id") % 5 < 2, "user").otherwise("assistant")
        text = F.concat(F.lit("é <turn> 😀 "), F.col("id").cast("string"))
        turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
        done = chat.format_conversations(turns)
        back = chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
        at = time.perf_counter()
        (row,) = done.select("formatted", "loss_spans", *back).collect()
        return row, time.perf_counter() - at

    read(10)
    row, seconds = read(2000)
    want = [("user" if i % 5 < 2 else "assistant", f"é <turn> 😀 {i}") for i in range(2000)]
    assert [(t.role, t.text) for t in row.turns] == want
    assert row.loss == "".join(t for r, t in want if r == "assistant")
    cut = [row.formatted[s.start : s.start + s.length] for s in row.loss_spans]
    data = row.formatted.encode()
    assert [data[s.first_byte : s.first_byte + s.bytes].decode() for s in row.loss_spans] == cut
    assert "".join(cut).replace("\\<turn>", "<turn>") == row.loss
    assert read(20_000)[1] < 20 * max(seconds, 0.5)


# -- sharding ---------------------------------------------------------------


def brute_table(names, size):
    """Turns with each shard's whole order of preference written out."""
    orders = []
    for n in names:
        offset, step = sharding.preference(n, size)
        orders.append([(offset + k * step) % size for k in range(size)])
    owner = {}
    while len(owner) < size:
        for i, order in enumerate(orders):
            if len(owner) < size:
                owner[next(s for s in order if s not in owner)] = i
    return [owner[s] for s in range(size)]


def test_lookup_table():
    names = [f"n{k}" for k in range(7)]
    table = sharding.lookup_table(names, 101)
    assert table == brute_table(names, 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 30
    for bad in ((names, 100), (names, 5), ([], 101), (["a", "a"], 101)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_shards_of_odd_rows(spark, tmp_path):
    rows = [(None, "a"), (None, "b"), ("", "c"), ("null", "d"), ("x", "e"), ("x", "e"), ("y" * 100000, "f")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "key string, v string, shard int, slot int")
    got = sharding.assign_shards(df, "key", ["p", "q", "r"], 101)
    assert sorted(got.columns) == ["key", "shard", "slot", "v"]
    table = sharding.lookup_table(["p", "q", "r"], 101)
    for r in got.collect():
        text = "null" if r.key is None else f"={r.key}"
        slot = int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 101
        assert (r.slot, r.shard) == (slot, "pqr"[table[slot]])
    assert got.count() == len(rows)
    assert sharding.assign_shards(df.limit(0), "key", ["p"], 101).count() == 0
    sharding.write_shards(got, str(tmp_path / "out"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


# -- decontamination --------------------------------------------------------


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute_hits(docs, items, size=13):
    windows = defaultdict(set)
    for i, t in items:
        w = brute_words(t)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[k : k + size])].add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        words, hit, names = brute_words(t), set(), set()
        for win, ids in windows.items():
            for k in range(len(words) - len(win) + 1):
                if tuple(words[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    names |= ids
        out.append((d, len(words), len(hit), sorted(names), 0 < len(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def hits(docs, items, spark):
    documents = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int")
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    rows = decontaminate.decontaminate(documents, benchmark).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=str)


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_decontaminate_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    item = " ".join(f"i{k}" for k in range(30))
    items = [(1, item), (2, "Short ÉA one"), (3, ""), (None, "no id here"), (4, None), (5, "same " * 15), (6, item), (10, "short Éa one"), (2, "second text")]
    docs = [
        (1, None), (2, ""), (3, f"x {item.upper()} y"), (4, "a short-éa;one"), (5, "a short-ÉA;one b"), (6, "same " * 14 + "x " * 400), (7, "same " * 3000),
        (None, "no id here"), (8, " ".join(f"i{k}" for k in range(12))), (8, " ".join(f"i{k}" for k in range(13))), (9, "second text"), (9, "second text"),
        (10, "w " * 60000 + item), (11, " ".join(f"i{k}" for k in range(5, 25))), (12, "İ K second\0text Σ"),
    ]
    assert hits(docs, items, spark) == brute_hits(docs, items)
    assert hits(docs[:3], [], spark) == brute_hits(docs[:3], [])
    assert hits([], items, spark) == []


# -- quality ----------------------------------------------------------------


def test_counts_of_one_text():
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x\nx\n\n\nx y\nx", "A  b\na B\n", "#*$%&|<> é", "a\x1cb\x85c\xa0d", "k " * 100000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(200)]
    for t in texts:
        n_words, chars, symbols, dup, repeated, _ = quality.measure(t)
        words = [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]
        assert (n_words, chars, symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")))
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert dup == len(lines) - len(set(lines))
        seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(5)}
        assert repeated == len(inside)


def test_quality_verdicts(spark):
    rng = random.Random(5)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    menu = "Home  About us and all the other pages of this site here"
    own = [(k, f"{line()}\n{menu}\n{line()}", "h1") for k in range(100)]  # boilerplate, but mostly own text
    empty = [(100 + k, f"{menu.upper()}\n  {menu}\nok{k}", "h1") for k in range(3)]  # depleted
    other = [(200, f"{menu}\n{menu[:9]} x", "h2")]  # rare on its host
    text = "\n".join(line() for _ in range(5))
    copies = [(300 + k, text, "h3") for k in range(80)] + [(400 + k, line(), "h3") for k in range(80)]
    near = [(500 + k, text.replace(" ", f" n{k} ", 1), "h3") for k in range(40)]
    odd = [(None, None, None), (600, "", "h1"), (601, "a b c d e f g h i j", None), (602, "a b c d e f g h i", "h1"), (603, "z " * 50000, "h1")]
    rows = own + empty + other + copies + near + odd + [odd[2]]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, source string, kept boolean")
    got = quality.quality(df)
    kept = [(r.doc_id, r.kept, r.base_failed, r.removed_words) for r in got.collect()]
    verdict = {d: k for d, k, _, _ in kept}
    assert all(verdict[k] for k in range(100)) and not any(verdict[100 + k] for k in range(3)) and verdict[200]
    assert all(verdict[d] for d, _, _ in copies + near)
    assert not verdict[None] and not verdict[600] and verdict[601] and not verdict[602] and not verdict[603]
    assert len(kept) == len(rows) and {r for _, _, _, r in kept if r} == {12, 24}
    assert quality.quality(df.limit(0)).count() == 0


def test_block_shared_by_all_documents(spark):
    block = "\n".join(" ".join(f"b{k}w{i}" for i in range(12)) for k in range(20))
    rows = [(k, f"{block}\nown{k}", "h1") for k in range(1000)] + [(2000 + k, f"{block}\nown7", "h2") for k in range(1000)]
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == set(range(1000))
    assert {r.removed_words for r in got} == {0, 20 * 12}


def test_limits_of_hot_and_small_hosts(spark):
    said = lambda name: " ".join(f"{name}{i}" for i in range(12))
    rows = [(k, f"{said('p') if k < 51 else said('q') if k < 101 else ''}\nown{k}", "hot") for k in range(3000)]
    rows += [(4000 + k, f"{said('r')}\n{said('s') if k < 5 else ''}\nown{k}", "small") for k in range(10)]
    rows += [(5000 + k, f"{said('t')}\nown{k}", "two") for k in range(2)]
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id for r in got if r.removed_words} == {*range(51), *range(4000, 4010)}
    assert {r.removed_words for r in got} == {0, 12}


def test_clean_texts(spark):
    menu = "Home  About us and all the other pages of this site here"
    own = lambda k: " ".join(f"o{k}w{i}" for i in range(15))
    rows = [(k, f"{own(k)}\n{menu}\n\n  {menu.upper()}\r\nend{k}", "h", k % 2 == 0) for k in range(60)]
    rows += [(100, f"{menu}\nok", "h", True), (101, own(101), "h", True), (102, f"{own(102)}\n{menu}", "h2", True)]
    rows += [(None, None, None, None), (103, "", "h", True), (0, own(200), "h", True), (0, rows[0][1], "h2", True), rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, kept boolean")
    got = quality.clean(df).collect()
    assert sorted((r.row.doc_id or -1, r.row.text or "", r.row.source or "") for r in got) == sorted((d or -1, t or "", s or "") for d, t, s, _ in rows)
    assert {(r.row.doc_id, r.row.kept) for r in got} == {(d, x) for d, _, _, x in rows}
    for r in got:
        row = r.row
        if row.source == "h" and row.doc_id < 60 and row.text != own(200):
            assert r.clean_text == f"{own(row.doc_id)}\n\nend{row.doc_id}" and r.removed_lines == [menu, f"  {menu.upper()}\r"] and r.kept
        elif row.doc_id == 100:
            assert (r.clean_text, r.removed_lines, r.kept) == ("ok", [menu], False)
        else:
            assert (r.clean_text, r.removed_lines) == (row.text, []) and r.kept == bool(row.text)
    assert quality.clean(df.limit(0)).count() == 0


def line_limit_rows():
    """Hosts of many sizes with lines below, at and above their limits, and copies."""
    said = lambda name: " ".join(f"{name}{i}" for i in range(12))
    rows = [(k, f"{said('p') if k < 51 else said('q') if k < 101 else ''}\nown{k} {said('x')}{k}", "hot") for k in range(1500)]
    rows += [(2000 + k, f"{said('r')}\n{said('s') if k < 5 else ''}\nown{k}", "small") for k in range(10)]
    rows += [(2100 + k, said("t"), "copies") for k in range(10)] + [(2110 + k, f"{said('t')}\nown{k}", "copies") for k in range(5)]
    rows += [(2200 + k, f"{said('u')}\nown{k}", "two") for k in range(2)]
    rows += [(2300 + k, f"{said('v')}\n{said('V').upper()}\n\n own{k}", "half") for k in range(3)] + [(2310 + k, f"own{k}", "half") for k in range(3)]
    rows += [(2400 + k, f"{said('w')}\n" * (1 + k % 2) + f"{said(f'z{k}')}", None) for k in range(60)] + [(None, None, None), (2500, "", "hot"), (2500, "", "hot")]
    return rows


def test_line_limits_equal_sql(spark, tmp_path):
    """The registered SQL on lines that are above their limits."""
    df = spark.createDataFrame([(*r, "x", 1) for r in line_limit_rows()], "doc_id long, text string, source string, line string, docs int")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(queries.OP3_SQL)
    got = queries.op3_quality_rules(spark, str(tmp_path))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows = sorted(map(tuple, got.select(*want.columns).collect()), key=key)
    assert rows == sorted(want.fetchall(), key=key)
    removed = {r.doc_id for r in got.where("removed_words > 0").collect()}
    assert removed == {*range(51), *range(2000, 2010), *range(2100, 2115), *range(2400, 2460)}


CLASHING = "host key row kept clean_text removed_lines frequent line words line_set _key _kept _slot _shard _row _at slot doc md5 n node".split()


@pytest.mark.parametrize("operator", ["quality", "clean", "shards", "decontaminate"])
def test_columns_with_clashing_names(spark, operator):
    plain = spark.createDataFrame([(1, "a b c d e f g h i j k l", "h"), (2, None, None)], "doc_id long, text string, source string")
    clash = plain.withColumns({c: F.lit(c) for c in CLASHING})
    benchmark = spark.createDataFrame([("i", "a b c", "x")], "item_id string, text string, window string")
    run = {
        "quality": quality.quality,
        "clean": lambda d: quality.clean(d).select("row.doc_id", "row.text", "clean_text", "kept"),
        "shards": lambda d: sharding.assign_shards(d, "doc_id", ["a", "b"], 11).select("doc_id", "text", "slot", "shard"),
        "decontaminate": lambda d: decontaminate.decontaminate(d, benchmark),
    }[operator]
    assert sorted(map(str, run(clash).collect())) == sorted(map(str, run(plain).collect()))
    if operator == "shards":
        kept = sharding.assign_shards(clash, "doc_id", ["a", "b"], 11)
        assert {c: kept.first()[c] for c in CLASHING if c != "slot"} == {c: c for c in CLASHING if c != "slot"}
