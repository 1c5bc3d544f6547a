"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query here is written independently from the Spark code, from the
definitions in the docstrings of the operators: plain SQL with CTEs over the
pre-registered input views. Helper functions only build repetitive SQL text.
"""

from __future__ import annotations

from ..config import CLASS_UPPER_BOUNDS, EQUITY_BIN_EDGES, equity_bin_labels

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
FLUSH_OFFSET = 5 ** 13


def _plus(parts) -> str:
    return "(" + " + ".join(parts) + ")"


# ---------------------------------------------------------------------------
# derived tables
# ---------------------------------------------------------------------------

def hands_cte() -> str:
    """hands: five distinct cards per lineitem row (FIXTURES.md)."""
    steps = [
        f"""h0 AS (
  SELECT {KEYS}, CAST(l_shipdate AS TIMESTAMP) AS ship_ts,
         CAST((l_orderkey * 7919 + CAST(l_linenumber AS BIGINT) * 104729 + l_partkey * 1299709
               + l_suppkey * 15485863) % 311875200 AS BIGINT) AS code
  FROM lineitem)""",
        """h1 AS (
  SELECT *, code % 52 AS d1, (code // 52) % 51 AS d2, (code // 2652) % 50 AS d3,
         (code // 132600) % 49 AS d4, (code // 6497400) % 48 AS d5, range(0, 52) AS dk1
  FROM h0)""",
    ]
    prev = "h1"
    for i in range(1, 6):
        cur = f"h{i + 1}_k"
        nxt = f"dk{i + 1}"
        extra = f", list_filter(dk{i}, lambda x: x <> dk{i}[d{i} + 1]) AS {nxt}" if i < 5 else ""
        steps.append(f"{cur} AS (SELECT *, dk{i}[d{i} + 1] AS k{i}{extra} FROM {prev})")
        prev = cur
    cards = ", ".join(f"CAST(k{i} // 13 + 1 AS INTEGER) AS S{i}, CAST(k{i} % 13 + 1 AS INTEGER) AS C{i}"
                      for i in range(1, 6))
    steps.append(f"hands AS (SELECT {KEYS}, ship_ts, code, {cards} FROM {prev})")
    return ",\n".join(steps)


def prediction_log_cte() -> str:
    return """prediction_log AS (
  SELECT event_id AS request_id, CAST(ts AS TIMESTAMP) AS ts,
         CAST(CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 422
                   WHEN event_id % 3 = 1 THEN 404 ELSE 500 END AS INTEGER) AS status,
         value / 50.0 AS inference_seconds, value / 1000.0 AS load_seconds,
         CAST(length(props) AS BIGINT) AS payload_bytes,
         CAST((event_id * 37) % 101 AS DOUBLE) / 100.0 AS equity,
         CAST(1 + (event_id * 7919) % 7462 AS INTEGER) AS current_hand_rank_value
  FROM events)"""


def counter_samples_cte() -> str:
    return """counter_samples AS (
  SELECT event_type AS series, CAST(ts AS TIMESTAMP) AS ts, CAST(event_id % 100 AS BIGINT) AS cum FROM events)"""


def run_log_cte() -> str:
    return """run_log AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS run_name,
         CASE WHEN o_orderkey % 5000 = 17 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS end_time
  FROM orders)"""


# ---------------------------------------------------------------------------
# hand ranking
# ---------------------------------------------------------------------------

def class_case(rank_col: str) -> str:
    whens = " ".join(f"WHEN {rank_col} <= {ub} THEN {c}" for c, ub in enumerate(CLASS_UPPER_BOUNDS))
    return f"CAST(CASE {whens} END AS INTEGER)"


def rank_table_cte() -> str:
    """rank5(lookup_key, rank_value, rank_class, is_flush, r1..r5): the 7,462 classes."""
    r = [f"r{i}" for i in range(1, 6)]
    eq = _plus([f"CAST({r[i]} = {r[j]} AS INTEGER)" for i in range(5) for j in range(i + 1, 5)])
    cnt = [_plus([f"CAST({r[i]} = {r[j]} AS INTEGER)" for j in range(5)]) for i in range(5)]
    first = ["TRUE"] + [f"{r[i]} <> {r[i - 1]}" for i in range(1, 5)]
    gkey = _plus([f"CASE WHEN {first[i]} THEN CAST(power(2, ({cnt[i]} - 1) * 13 + {r[i]} - 2) AS BIGINT) ELSE 0 END"
                  for i in range(5)])
    mask = _plus([f"CAST(power(2, {x} - 2) AS BIGINT)" for x in r])
    p5 = _plus([f"CAST(power(5, {x} - 2) AS BIGINT)" for x in r])
    return f"""rk AS (SELECT CAST(range AS INTEGER) AS r FROM range(2, 15)),
ms5 AS (
  SELECT a.r AS r1, b.r AS r2, c.r AS r3, d.r AS r4, e.r AS r5, FALSE AS is_flush
  FROM rk a, rk b, rk c, rk d, rk e
  WHERE a.r >= b.r AND b.r >= c.r AND c.r >= d.r AND d.r >= e.r AND a.r <> e.r
  UNION ALL
  SELECT a.r, b.r, c.r, d.r, e.r, TRUE
  FROM rk a, rk b, rk c, rk d, rk e
  WHERE a.r > b.r AND b.r > c.r AND c.r > d.r AND d.r > e.r),
ms5b AS (SELECT *, {eq} AS eqp, {mask} AS mask, {gkey} AS gkey, {p5} AS p5 FROM ms5),
ms5c AS (
  SELECT *, (eqp = 0 AND (r1 - r5 = 4 OR mask = 4111)) AS straight,
         CASE WHEN mask = 4111 THEN 5 ELSE r1 END AS shigh
  FROM ms5b),
ms5d AS (
  SELECT *,
    CASE WHEN is_flush THEN (CASE WHEN straight AND shigh = 14 THEN 0 WHEN straight THEN 1 ELSE 4 END)
         ELSE (CASE WHEN eqp = 6 THEN 2 WHEN eqp = 4 THEN 3 WHEN eqp = 3 THEN 6 WHEN eqp = 2 THEN 7
                    WHEN eqp = 1 THEN 8 WHEN straight THEN 5 ELSE 9 END) END AS rank_class,
    CASE WHEN straight THEN CAST(shigh AS BIGINT) ELSE gkey END AS okey,
    CASE WHEN is_flush THEN {FLUSH_OFFSET} + mask ELSE p5 END AS lookup_key
  FROM ms5c),
rank5 AS (
  SELECT lookup_key, CAST(row_number() OVER (ORDER BY rank_class, okey DESC) AS INTEGER) AS rank_value,
         CAST(rank_class AS INTEGER) AS rank_class, is_flush, r1, r2, r3, r4, r5
  FROM ms5d)"""


def seven_table_cte() -> str:
    """rank7(lookup_key, rank_value): best five-of-seven rank per seven-card key."""
    rs = [f"r{i}" for i in range(1, 8)]
    al = "abcdefg"
    sel = ", ".join(f"{al[i]}.r AS {rs[i]}" for i in range(7))
    frm = ", ".join(f"rk {a}" for a in al)
    cond = " AND ".join(f"{al[i]}.r >= {al[i + 1]}.r" for i in range(6))
    p = [f"CAST(power(5, {x} - 2) AS BIGINT)" for x in rs]
    subs = ", ".join(f"{_plus(p)} - {p[i]} - {p[j]}" for i in range(7) for j in range(i + 1, 7))
    return f"""ms7 AS (
  SELECT {sel} FROM {frm}
  WHERE {cond} AND a.r <> e.r AND b.r <> f.r AND c.r <> g.r),
nf7 AS (
  SELECT s.key7 AS lookup_key, min(t.rank_value) AS rank_value
  FROM (SELECT {_plus(p)} AS key7, unnest([{subs}]) AS sub FROM ms7) s
  JOIN rank5 t ON t.lookup_key = s.sub AND NOT t.is_flush
  GROUP BY s.key7),
fm AS (SELECT range AS m FROM range(0, 8192) WHERE bit_count(range) BETWEEN 5 AND 7),
f7 AS (
  SELECT {FLUSH_OFFSET} + fm.m AS lookup_key, min(t.rank_value) AS rank_value
  FROM fm JOIN rank5 t ON t.is_flush AND ((t.lookup_key - {FLUSH_OFFSET}) & fm.m) = (t.lookup_key - {FLUSH_OFFSET})
  GROUP BY fm.m),
rank7 AS (SELECT lookup_key, rank_value FROM nf7 UNION ALL SELECT lookup_key, rank_value FROM f7)"""


def five_key_sql(prefix: str = "") -> str:
    """Lookup key of S1,C1..S5,C5 (flush key when all five suits are equal)."""
    hi = [f"(CASE WHEN {prefix}C{i} = 1 THEN 14 ELSE {prefix}C{i} END)" for i in range(1, 6)]
    suited = " AND ".join(f"{prefix}S1 = {prefix}S{i}" for i in range(2, 6))
    return (f"CASE WHEN {suited} THEN {FLUSH_OFFSET} + {_plus([f'CAST(power(2, {h} - 2) AS BIGINT)' for h in hi])} "
            f"ELSE {_plus([f'CAST(power(5, {h} - 2) AS BIGINT)' for h in hi])} END")


def seven_key_sql(cards: list[str]) -> str:
    """Lookup key of seven 0..51 card numbers."""
    idx = [f"(({c} % 13 + 12) % 13)" for c in cards]
    cnt = {s: _plus([f"CAST({c} // 13 = {s} AS INTEGER)" for c in cards]) for s in range(4)}
    fs = "CASE " + " ".join(f"WHEN {cnt[s]} >= 5 THEN {s}" for s in range(4)) + " END"
    mask = _plus([f"CASE WHEN {c} // 13 = ({fs}) THEN CAST(power(2, {i}) AS BIGINT) ELSE 0 END" for c, i in zip(cards, idx)])
    p5 = _plus([f"CAST(power(5, {i}) AS BIGINT)" for i in idx])
    return f"CASE WHEN ({fs}) IS NULL THEN {p5} ELSE {FLUSH_OFFSET} + {mask} END"


def ranked_hands_cte() -> str:
    """ranked: hands + current_hand_rank_value + current_hand_class_value."""
    return f"""ranked AS (
  SELECT h.*, r.rank_value AS current_hand_rank_value, {class_case('r.rank_value')} AS current_hand_class_value
  FROM hands h LEFT JOIN rank5 r ON r.lookup_key = ({five_key_sql('h.')}))"""


def showdown_ctes(n: int = 10, seed: int = 0) -> str:
    """trials: one row per (hand row, trial) with both seven-card ranks."""
    ks = ", ".join(f"CAST((S{i} - 1) * 13 + C{i} - 1 AS BIGINT) AS k{i}" for i in range(1, 6))
    code = "((((k1 * 52 + k2) * 52 + k3) * 52 + k4) * 52 + k5)"
    return f"""hk AS (SELECT row_number() OVER () AS rid, *, {ks} FROM hands),
hk2 AS (SELECT *, {code} AS hcode FROM hk),
tr AS (SELECT *, unnest(range(1, {n + 1})) AS t FROM hk2),
tr1 AS (
  SELECT *, CAST(('0x' || substr(md5(concat_ws('|', hcode, t, '{seed}')), 1, 8)) AS BIGINT) % {47 * 46 * 45 * 44} AS x,
         list_filter(range(0, 52), lambda c: NOT list_contains([k1, k2, k3, k4, k5], c)) AS rem1
  FROM tr),
tr2 AS (SELECT *, rem1[x % 47 + 1] AS o1 FROM tr1),
tr3 AS (SELECT *, list_filter(rem1, lambda c: c <> o1) AS rem2 FROM tr2),
tr4 AS (SELECT *, rem2[(x // 47) % 46 + 1] AS o2 FROM tr3),
tr5 AS (SELECT *, list_filter(rem2, lambda c: c <> o2) AS rem3 FROM tr4),
tr6 AS (SELECT *, rem3[(x // 2162) % 45 + 1] AS b1 FROM tr5),
tr7 AS (SELECT *, list_filter(rem3, lambda c: c <> b1) AS rem4 FROM tr6),
tr8 AS (SELECT *, rem4[(x // 97290) % 44 + 1] AS b2 FROM tr7),
trials AS (
  SELECT tr8.*, p.rank_value AS player_rank, o.rank_value AS opponent_rank
  FROM tr8
  LEFT JOIN rank7 p ON p.lookup_key = ({seven_key_sql(['k1', 'k2', 'k3', 'k4', 'k5', 'b1', 'b2'])})
  LEFT JOIN rank7 o ON o.lookup_key = ({seven_key_sql(['o1', 'o2', 'k3', 'k4', 'k5', 'b1', 'b2'])}))"""


def seven_cards_ctes() -> str:
    """seven: hands with turn and river cards of the rest of the deck, and the best rank of all seven."""
    ks = ", ".join(f"CAST((S{i} - 1) * 13 + C{i} - 1 AS BIGINT) AS k{i}" for i in range(1, 6))
    return f"""sk AS (
  SELECT *, list_filter(range(0, 52), lambda c: NOT list_contains([k1, k2, k3, k4, k5], c)) AS rest
  FROM (SELECT *, {ks} FROM hands)),
sk1 AS (SELECT *, rest[l_partkey % 47 + 1] AS b1 FROM sk),
sk2 AS (SELECT *, list_filter(rest, lambda c: c <> b1)[l_suppkey % 46 + 1] AS b2 FROM sk1),
seven AS (
  SELECT sk2.*, p.rank_value AS best_rank FROM sk2
  LEFT JOIN rank7 p ON p.lookup_key = ({seven_key_sql(['k1', 'k2', 'k3', 'k4', 'k5', 'b1', 'b2'])}))"""


def equity_bin_sql(col: str) -> str:
    labels = equity_bin_labels(EQUITY_BIN_EDGES)
    parts = []
    for i, (lo, hi) in enumerate(zip(EQUITY_BIN_EDGES[:-1], EQUITY_BIN_EDGES[1:])):
        op = "<=" if i == len(labels) - 1 else "<"
        parts.append(f"WHEN {col} >= {lo} AND {col} {op} {hi} THEN '{labels[i]}'")
    return f"CASE {' '.join(parts)} ELSE '{labels[-1]}' END"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def live_cte() -> str:
    """live: telemetry rows built from ranked hands (needs the ranked CTE)."""
    return f"""live AS (
  SELECT ship_ts AS ts, {KEYS}, code, C1 = C2 AS hand_is_pair, S1 = S2 AS hand_is_suited,
         (C3 = C4 OR C4 = C5 OR C3 = C5) AS board_is_paired,
         CAST(code % 101 AS DOUBLE) / 100.0 AS equity,
         CAST(current_hand_class_value AS VARCHAR) AS current_hand_class_value
  FROM ranked)"""


def live_long_sql(src: str) -> str:
    """(feature, label) rows of the five drift features of ``src``."""
    parts = [f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS label FROM {src}"
             for f in ("hand_is_pair", "hand_is_suited", "board_is_paired")]
    parts.append(f"SELECT 'equity_bin' AS feature, {equity_bin_sql('equity')} AS label FROM {src}")
    parts.append(f"SELECT 'current_hand_class_value' AS feature, current_hand_class_value AS label FROM {src}")
    return "\nUNION ALL\n".join(parts)


def latest_cte(n: int, src: str = "live", name: str = "latest") -> str:
    return f"""{name} AS (SELECT * FROM {src} ORDER BY ts DESC NULLS LAST, {KEYS}, code LIMIT {n})"""


def hash_bucket_sql(cols: list[str], seed: int) -> str:
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(cols)}, '{seed}')), 1, 8)) AS BIGINT) % 10000)")


def islands_ctes(alerts: str) -> str:
    """isl: days (column ws) of ``alerts`` numbered within runs of days in a row."""
    return f"""lagged2 AS (SELECT ws, lag(ws) OVER (ORDER BY ws) AS before FROM {alerts}),
runs AS (SELECT ws, sum(CASE WHEN before + INTERVAL 1 DAY = ws THEN 0 ELSE 1 END) OVER (ORDER BY ws) AS run FROM lagged2),
islands AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ws) AS k FROM runs)"""


def islands_body(k: int) -> str:
    return f"""
SELECT {ts_text('min(ws)')} AS run_start, {ts_text('max(ws) + INTERVAL 1 DAY')} AS run_end, count(*) AS n_windows,
       {ts_text(f'min(CASE WHEN k = {k} THEN ws END)')} AS firing_from
FROM islands GROUP BY run HAVING count(*) >= {k}"""


def ts_text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
