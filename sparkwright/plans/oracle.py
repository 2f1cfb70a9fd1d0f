"""SQL building blocks for the DuckDB oracle (the views ``events``,
``documents``, ``labels`` ... are registered by the checker).

These CTEs restate, in plain SQL, the adapter views and preparation that the
Spark side builds with the operators.  DuckDB spells a few things differently:
``isodow(ts) - 1`` for Spark's ``weekday``, ``'g'`` for global regex replace.
"""

from __future__ import annotations

from ..functions.hashing import split_point
from ..functions.stopwords import ENGLISH_STOP_WORDS


def md5_hash(key_sql: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{salt}'), 1, 8) AS BIGINT)"


def md5_bucket(key_sql: str, salt: str, modulus: int) -> str:
    return f"({md5_hash(key_sql, salt)} % {modulus})"


FLIGHTS = """
ev AS (SELECT *, try_cast(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
flights AS (
  SELECT event_id,
    CAST(user_id % 12 AS INTEGER) AS mon,
    CAST(day(ts) AS INTEGER) AS dom,
    CAST(isodow(ts) - 1 AS INTEGER) AS dow,
    'C' || CAST(user_id % 9 AS VARCHAR) AS carrier,
    user_id AS flight,
    event_type AS org,
    100 + 25 * k AS mile,
    round(hour(ts) + minute(ts) / CAST(60 AS DOUBLE), 2) AS depart,
    CAST(round(44 + 0.0757 * (100 + 25 * k) * 1.60934
      + CASE event_type WHEN 'click' THEN 30 WHEN 'view' THEN 20 WHEN 'error' THEN -5 ELSE 0 END
      + (value - 50) / 10) AS INTEGER) AS duration,
    CASE WHEN event_id % 16 = 0 THEN NULL
      ELSE CAST(floor(value / 4) AS INTEGER) + CASE WHEN hour(ts) >= 15 THEN 25 ELSE 0 END - 10 END AS delay
  FROM ev)"""

PREPARED = FLIGHTS + """,
prepared AS (
  SELECT event_id, mon, dom, dow, carrier, org, depart, duration, delay,
    round(CAST(mile AS DOUBLE) * 1.60934, 0) AS km,
    CAST(delay >= 15 AS INTEGER) AS label
  FROM flights
  WHERE delay IS NOT NULL AND event_id IS NOT NULL AND mon IS NOT NULL AND dom IS NOT NULL
    AND dow IS NOT NULL AND carrier IS NOT NULL AND org IS NOT NULL AND mile IS NOT NULL
    AND depart IS NOT NULL AND duration IS NOT NULL)"""

SPLIT = PREPARED + f""",
split AS (SELECT *, {md5_hash('event_id', '17')} < {split_point(0.8)} AS is_train FROM prepared),
train AS (SELECT * FROM split WHERE is_train),
test AS (SELECT * FROM split WHERE NOT is_train)"""


def with_sql(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.strip()}\n{body.strip()}"


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP_LIST = _sql_list(ENGLISH_STOP_WORDS)

SMS = """
sms AS (SELECT d.doc_id AS id, d.text AS text, CAST(l.quality AS INTEGER) AS label
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

# X1-X3 cleaning; X4 Tokenizer: lower-case, split on single whitespace, trailing
# empties dropped (Java split), leading empty kept.
CLEANED = r"""
cleaned AS (
  SELECT doc_id AS id,
    regexp_replace(regexp_replace(regexp_replace(text, '[_():;,.!?\-]', ' ', 'g'), '[0-9]', ' ', 'g'), ' +', ' ', 'g') AS text
  FROM documents WHERE text IS NOT NULL)"""

TOKENS = CLEANED + r""",
tokenized AS (
  SELECT id, text,
    regexp_split_to_array(lower(regexp_replace(text, '\s+$', '')), '\s') AS words
  FROM cleaned)"""

TERMS = TOKENS + f""",
termed AS (
  SELECT id, words,
    list_filter(words, lambda w: NOT list_contains({STOP_LIST}, w)) AS terms
  FROM tokenized)"""


# Spark's HashingTF slot of a term, in SQL: MurmurHash3 x86 32-bit over the
# term's UTF-8 bytes with seed 42 (4-byte little-endian blocks, then the tail,
# then the finaliser), taken mod the (power-of-two) feature count.  Unsigned
# 64-bit arithmetic holds every 32-bit product; each step masks to 32 bits.
_M32 = "4294967295"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & {_M32}"


def _mix_k1(k: str) -> str:
    step = f"((({k}) * 3432918353) & {_M32})"
    return f"((({_rotl(step, 15)}) * 461845907) & {_M32})"


def _mix_h1(h: str, k: str) -> str:
    return f"((({_rotl(f'xor({h}, {k})', 13)}) * 5 + 3864292196) & {_M32})"


def term_slots(vocab_cte: str, num_features: int) -> str:
    """CTEs ``mm_*`` ending in ``mm_slot(term, slot)`` for every term of ``vocab_cte(term)``."""
    return f"""
mm_bytes AS (
  SELECT term, octet_length(encode(term)) AS n,
         list_transform(range(0, octet_length(encode(term))),
                        lambda i: CAST(('0x' || substr(hex(encode(term)), 2 * i + 1, 2)) AS UBIGINT)) AS b
  FROM {vocab_cte}),
mm_blocks AS (
  SELECT term, n, b,
         list_transform(range(0, n // 4),
                        lambda j: b[4 * j + 1] | (b[4 * j + 2] << 8) | (b[4 * j + 3] << 16) | (b[4 * j + 4] << 24)) AS blocks
  FROM mm_bytes),
mm_body AS (
  SELECT term, n, b,
         list_reduce(blocks, lambda h, k: {_mix_h1('h', _mix_k1('k'))}, CAST(42 AS UBIGINT)) AS h
  FROM mm_blocks),
mm_tail AS (
  SELECT term, n,
         xor(h, {_mix_k1("list_reduce(list_transform(range(0, n % 4), lambda i: b[(n // 4) * 4 + i + 1] << (8 * i)), lambda a, c: a | c, CAST(0 AS UBIGINT))")}) AS h
  FROM mm_body),
mm_f1 AS (SELECT term, xor(h, CAST(n AS UBIGINT)) AS h FROM mm_tail),
mm_f2 AS (SELECT term, (xor(h, h >> 16) * 2246822507) & {_M32} AS h FROM mm_f1),
mm_f3 AS (SELECT term, (xor(h, h >> 13) * 3266489909) & {_M32} AS h FROM mm_f2),
mm_slot AS (SELECT term, CAST(xor(h, h >> 16) % {num_features} AS INTEGER) AS slot FROM mm_f3)"""


def two_factor_fit(source: str, f_col: str, g_index: str, g_levels: int, sweeps: int = 30) -> str:
    """CTEs ending in ``fit(a, b, f, g)``: least squares of ``duration`` on ``km``
    plus two one-hot factors, by cyclic block updates (slope and intercept,
    then each factor's level means of the partial residual).  Each update is
    an exact least-squares step, so the fitted values converge to the OLS fit
    (which, unlike the coefficients, is unique); with nearly independent
    factors ten sweeps reach about 1e-13.  ``f_col`` is a category column
    (levels numbered alphabetically in ``flv``); ``g_index`` a 1-based integer
    expression with ``g_levels`` levels.  Needs ``with_sql(..., recursive=True)``."""
    return f"""
flv AS (SELECT {f_col} AS lvl, CAST(row_number() OVER (ORDER BY {f_col}) AS INTEGER) AS fi
        FROM (SELECT DISTINCT {f_col} FROM {source})),
bf AS (SELECT s.km, CAST(s.duration AS DOUBLE) AS y, l.fi, CAST({g_index} AS INTEGER) AS gi
       FROM {source} s JOIN flv l ON s.{f_col} = l.lvl),
it(i, f, g, a, b) AS (
  SELECT 0, list_transform(range((SELECT count(*) FROM flv)), lambda x: CAST(0 AS DOUBLE)),
         list_transform(range({g_levels}), lambda x: CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT i + 1,
    CASE WHEN i % 3 = 1 THEN (SELECT list(v ORDER BY fi) FROM (
         SELECT fi, avg(y - it.a - it.b * km - it.g[gi]) AS v FROM bf GROUP BY fi)) ELSE f END,
    CASE WHEN i % 3 = 2 THEN (SELECT list(v ORDER BY gi) FROM (
         SELECT gi, avg(y - it.a - it.b * km - it.f[fi]) AS v FROM bf GROUP BY gi)) ELSE g END,
    CASE WHEN i % 3 = 0 THEN (SELECT regr_intercept(y - it.f[fi] - it.g[gi], km) FROM bf) ELSE a END,
    CASE WHEN i % 3 = 0 THEN (SELECT regr_slope(y - it.f[fi] - it.g[gi], km) FROM bf) ELSE b END
  FROM it WHERE i < {3 * sweeps}),
fit AS (SELECT a, b, f, g FROM it WHERE i = {3 * sweeps})"""
