"""Independent SQL (DuckDB dialect) for every registered query that SQL can state.

Written from each operator's definition, not from the Spark plan: windows
where the Spark side aggregates, a self-join where it runs FP-Growth,
HMAC pads computed by Python's ``hmac``-equivalent arithmetic here.
"""

from __future__ import annotations

import hashlib
import hmac

from laketide.functions.text_rules import DEFAULT_RULES
from laketide.plans import catalog as C


def _pads(key: bytes) -> tuple[str, str]:
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    block = key.ljust(64, b"\x00")
    return (bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex())


MAIN_PADS = _pads(C.TEST_KEY)
WORKSPACE_KEY = hmac.new(C.TEST_KEY, f"derive:workspace:{C.WORKSPACE}".encode(), hashlib.sha256).digest()
WORKSPACE_PADS = _pads(WORKSPACE_KEY)
UNKNOWN = "repeat('0', 64)"


def _tok(expr: str, domain: str, pads: tuple[str, str] = MAIN_PADS) -> str:
    ipad, opad = pads
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE sha256(unhex('{opad}') || unhex(sha256("
            f"unhex('{ipad}') || encode('token:{len(domain)}:{domain}:' || CAST({expr} AS VARCHAR))))) END")


GEO = "(SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"

A1 = f"""
WITH cust AS (SELECT {_tok('c_custkey', 'customer')} AS c_tok, c_nationkey, c_mktsegment FROM customer),
ord AS (SELECT o_orderkey, {_tok('o_custkey', 'customer')} AS o_tok, o_orderdate FROM orders),
fact AS (
  SELECT r_name, c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
  FROM lineitem JOIN ord ON l_orderkey = o_orderkey JOIN cust ON o_tok = c_tok
  JOIN {GEO} g ON c_nationkey = g.n_nationkey)
SELECT r_name, c_mktsegment, o_year, CAST(SUM(rev) AS DOUBLE) AS revenue, COUNT(*) AS n_lines,
       CAST(GROUPING(r_name, c_mktsegment, o_year) AS BIGINT) AS gid
FROM fact GROUP BY ROLLUP (r_name, c_mktsegment, o_year)
"""

_LINE_FACT = """(SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
  FROM lineitem)"""
_LINE_SELECT = """SELECT l_returnflag, l_linestatus, ship_year, SUM(l_quantity) AS sum_qty,
       CAST(SUM(rev) AS DOUBLE) AS revenue, COUNT(*) AS n_lines,
       CAST(GROUPING(l_returnflag, l_linestatus, ship_year) AS BIGINT) AS gid"""

A1_CUBE = f"""
{_LINE_SELECT}
FROM {_LINE_FACT} GROUP BY CUBE (l_returnflag, l_linestatus, ship_year)
"""

A1_SETS = f"""
{_LINE_SELECT}
FROM {_LINE_FACT} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (ship_year), ())
"""

P1 = f"""
SELECT {_tok('c_custkey', 'customer')} AS c_custkey, {_tok('c_name', 'customer_name')} AS c_name,
       c_nationkey, c_acctbal, c_mktsegment
FROM customer
"""

P2 = """
SELECT 'first_batch_ids' AS measure, COUNT(DISTINCT user_id) AS value FROM events
UNION ALL
SELECT 'second_batch_ids', COUNT(DISTINCT o_custkey) FROM orders
 WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
UNION ALL
SELECT 'vault_ids', COUNT(*) FROM (SELECT user_id AS id FROM events WHERE user_id IS NOT NULL
                                  UNION SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
UNION ALL
SELECT 'vault_tokens', COUNT(*) FROM (SELECT user_id AS id FROM events WHERE user_id IS NOT NULL
                                     UNION SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
"""

P3 = f"""
WITH vault AS (SELECT {_tok('c_custkey', 'customer')} AS token, c_custkey AS id FROM customer),
approved AS (SELECT {_tok('c_custkey', 'customer')} AS token FROM customer WHERE c_mktsegment = 'BUILDING'),
ord AS (SELECT o_orderkey, {_tok('o_custkey', 'customer')} AS o_custkey, o_totalprice FROM orders)
SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, v.id AS c_custkey
FROM ord o LEFT JOIN vault v ON o.o_custkey = v.token
WHERE o.o_custkey IN (SELECT token FROM approved WHERE token IS NOT NULL)
"""


def _mask_sql(table: str, id_col: str, text_col: str) -> str:
    """One step a rule. RE2 cannot look around: what must not stand beside a match is told by matching what may, and
    putting it back. Two passes, for a neighbour shared by two matches."""
    steps, src, counts = [], table, []
    for i, rule in enumerate(DEFAULT_RULES):
        text = "t" if i else text_col
        if rule.before:
            ends = {"[0-9]": r"$|[^0-9]", r"[0-9]|\.[0-9]": r"$|[^0-9.]|\.$|\.[^0-9]"}[rule.after]
            bounded = f"(^|[^{rule.before[1:]})({rule.pattern})({ends})"
            last = bounded.count("(")
            once = f"regexp_replace({text}, '{bounded}', '\\1{rule.mask}\\{last}', 'g')"
            new = f"regexp_replace({once}, '{bounded}', '\\1{rule.mask}\\{last}', 'g')"
        else:
            new = f"regexp_replace({text}, '{rule.pattern}', '{rule.mask}', 'g')"
        size = len(rule.mask)
        of = lambda x: f"((length({x}) - length(replace({x}, '{rule.mask}', ''))) // {size})"
        counts.append(f"n_{rule.kind}")
        kept = "".join(f", {c}" for c in counts[:-1])
        src = f"(SELECT {id_col}, n AS t, (CAST({of('n')} - {of('o')} AS INTEGER)) AS n_{rule.kind}{kept} FROM " \
              f"(SELECT {id_col}, {text} AS o, {new} AS n{kept} FROM {src}))"
    return f"SELECT {id_col}, t AS {text_col}, {', '.join(counts)} FROM {src}"


P4_DOCS = _mask_sql("documents", "doc_id", "text")
P4_PAGES = _mask_sql("pages", "page_id", "html")

P5_CUSTOMERS = f"""
SELECT c_custkey, g.r_name AS c_nationkey, CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS c_acctbal,
       c_mktsegment
FROM customer LEFT JOIN {GEO} g ON c_nationkey = g.n_nationkey
"""

P5_ORDERS = """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS o_orderyear,
       CAST(floor(o_totalprice / 10000) * 10000 AS BIGINT) AS o_totalprice
FROM orders
"""

P6 = f"""
SELECT c_custkey, c_nationkey, c_mktsegment FROM (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         COUNT(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n FROM customer)
WHERE n >= {C.K_SMALL_CELLS}
"""

P6_MASK = f"""
SELECT c_custkey,
       CASE WHEN n < {C.K_SMALL_CELLS} THEN NULL ELSE c_nationkey END AS c_nationkey,
       CASE WHEN n < {C.K_SMALL_CELLS} THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM (SELECT *, COUNT(*) FILTER (WHERE n < {C.K_SMALL_CELLS} OR (c_nationkey IS NULL AND c_mktsegment IS NULL))
             OVER () AS blank
      FROM (SELECT c_custkey, c_nationkey, c_mktsegment,
                   COUNT(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n FROM customer))
WHERE n >= {C.K_SMALL_CELLS} OR blank >= {C.K_SMALL_CELLS}
"""

P6_K = """
SELECT MIN(n) AS k, COUNT(*) AS n_groups
FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment)
"""

R1 = f"""
SELECT sha256(length(CAST(p_partkey AS VARCHAR)) || ':' || CAST(p_partkey AS VARCHAR)) AS part_key, p_partkey, p_name, p_brand, p_type FROM (
  SELECT p_partkey, p_name, p_brand, p_type,
         row_number() OVER (PARTITION BY p_partkey ORDER BY p_name DESC, p_brand DESC, p_type DESC) AS rn
  FROM part WHERE p_partkey IS NOT NULL)
WHERE rn = 1
UNION ALL SELECT {UNKNOWN}, NULL, 'Unknown', 'Unknown', 'Unknown'
"""

R2 = f"""
WITH pd AS (SELECT DISTINCT p_partkey, sha256(length(CAST(p_partkey AS VARCHAR)) || ':' || CAST(p_partkey AS VARCHAR)) AS part_key FROM part
            WHERE p_partkey IS NOT NULL),
sd AS (SELECT DISTINCT s_suppkey, sha256(length(CAST(s_suppkey AS VARCHAR)) || ':' || CAST(s_suppkey AS VARCHAR)) AS supp_key FROM supplier
       WHERE s_acctbal > 0 AND s_suppkey IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_quantity,
       coalesce(pd.part_key, {UNKNOWN}) AS part_key, coalesce(sd.supp_key, {UNKNOWN}) AS supp_key
FROM lineitem LEFT JOIN pd ON l_partkey = pd.p_partkey LEFT JOIN sd ON l_suppkey = sd.s_suppkey
"""

R3 = """
WITH daily AS (
  SELECT o_custkey, o_orderdate, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
  FROM orders GROUP BY o_custkey, o_orderdate),
flagged AS (
  SELECT *, lag(o_orderstatus) OVER w AS prev, row_number() OVER w AS rn
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderstatus)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM o_orderstatus)
SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from,
       lead(o_orderdate) OVER w AS valid_to, (lead(o_orderdate) OVER w) IS NULL AS is_current
FROM starts WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderstatus)
"""

R3_EVENTS = """
WITH flagged AS (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS prev, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS valid_from,
       lead(ts) OVER w AS valid_to, (lead(ts) OVER w) IS NULL AS is_current
FROM starts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)
"""

R3_NULLS = """
WITH e AS (
  SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 11 <> 0 THEN ts END AS ts, event_type
  FROM events),
flagged AS (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS prev, row_number() OVER w AS rn
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_type)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to,
       row_number() OVER w = count(*) OVER (PARTITION BY user_id) AS is_current
FROM starts WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_type)
"""

R3_BATCHES = """
WITH flagged AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, lag(o_orderstatus) OVER w AS prev, row_number() OVER w AS rn
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderstatus)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM o_orderstatus)
SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from,
       lead(o_orderdate) OVER w AS valid_to, row_number() OVER w = count(*) OVER (PARTITION BY o_custkey) AS is_current
FROM starts WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderstatus)
"""

_LINEITEM_NEWEST = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""


def _orphans(table: str, col: str, ref: str, ref_col: str, ref_where: str = "TRUE",
             ref_name: str | None = None) -> str:
    subject = f"{col}->{ref_name or ref}.{ref_col}"
    return f"""
SELECT '{table}', 'orphans', '{subject}', CAST(COUNT(*) AS DECIMAL(38,2)) FROM {table}
 WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {ref_col} FROM {ref} WHERE {ref_where} AND {ref_col} IS NOT NULL)
UNION ALL
SELECT '{table}', 'null_foreign_keys', '{subject}', CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS DECIMAL(38,2)) FROM {table}"""


def _dups(table: str, cols: str) -> str:
    return f"""
SELECT '{table}', 'duplicate_keys', '{cols}:keys', CAST(COUNT(*) AS DECIMAL(38,2))
  FROM (SELECT {cols} FROM {table} GROUP BY {cols} HAVING COUNT(*) > 1)
UNION ALL
SELECT '{table}', 'duplicate_keys', '{cols}:extra_rows', CAST(coalesce(SUM(n - 1), 0) AS DECIMAL(38,2))
  FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {cols} HAVING COUNT(*) > 1)"""


def _sums(side: str, src: str) -> str:
    return f"""
SELECT 'lineitem_storage', 'reconcile', '{side}:rows', CAST(COUNT(*) AS DECIMAL(38,2)) FROM {src}
UNION ALL SELECT 'lineitem_storage', 'reconcile', '{side}:sum(l_quantity)',
  CAST(SUM(CAST(l_quantity AS DECIMAL(38,2))) AS DECIMAL(38,2)) FROM {src}
UNION ALL SELECT 'lineitem_storage', 'reconcile', '{side}:sum(l_extendedprice)',
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2))) AS DECIMAL(38,2)) FROM {src}"""


def _differences(source: str, target: str) -> str:
    q, e = (f"SUM(CAST({c} AS DECIMAL(38,2)))" for c in ("l_quantity", "l_extendedprice"))
    parts = []
    for name, v in (("rows", "COUNT(*)"), ("sum(l_quantity)", q), ("sum(l_extendedprice)", e)):
        parts.append(f"SELECT 'lineitem_storage', 'reconcile', 'difference:{name}', CAST((SELECT {v} FROM {target}) "
                     f"- (SELECT {v} FROM {source}) AS DECIMAL(38,2))")
    return " UNION ALL ".join(parts)


R4 = "SELECT * FROM (" + " UNION ALL ".join([
    "SELECT 'lineitem' AS table_name, 'rows' AS \"check\", '*' AS subject, CAST(COUNT(*) AS DECIMAL(38,2)) AS value FROM lineitem",
    "SELECT 'orders', 'rows', '*', CAST(COUNT(*) AS DECIMAL(38,2)) FROM orders",
    "SELECT 'customer', 'rows', '*', CAST(COUNT(*) AS DECIMAL(38,2)) FROM customer",
    "SELECT 'orders', 'nulls', 'o_custkey', CAST(COUNT(*) FILTER (WHERE o_custkey IS NULL) AS DECIMAL(38,2)) FROM orders",
    "SELECT 'orders', 'nulls', 'o_orderdate', CAST(COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS DECIMAL(38,2)) FROM orders",
    "SELECT 'lineitem', 'nulls', 'l_orderkey', CAST(COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS DECIMAL(38,2)) FROM lineitem",
    "SELECT 'lineitem', 'nulls', 'l_partkey', CAST(COUNT(*) FILTER (WHERE l_partkey IS NULL) AS DECIMAL(38,2)) FROM lineitem",
    "SELECT 'lineitem', 'nulls', 'l_suppkey', CAST(COUNT(*) FILTER (WHERE l_suppkey IS NULL) AS DECIMAL(38,2)) FROM lineitem",
    _dups("lineitem", "l_orderkey,l_linenumber"),
    _dups("orders", "o_custkey,o_orderdate"),
    _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("orders", "o_custkey", "customer", "c_custkey"),
    _orphans("events", "user_id", "customer", "c_custkey"),
    _orphans("lineitem", "l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0", "active_supplier"),
    _sums("source", "lineitem"),
    _sums("target", f"({_LINEITEM_NEWEST})"),
    _differences("lineitem", f"({_LINEITEM_NEWEST})"),
]) + ")"

P6_LATTICE = f"""
WITH p AS (
  SELECT c_custkey, c_nationkey, r_name, c_acctbal, c_mktsegment FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
nodes AS (SELECT a.a, b.b, c.c, (a.a / 2.0 + b.b / 4.0 + c.c) / 3 AS loss FROM range(3) a(a), range(5) b(b), range(2) c(c)),
shown AS (
  SELECT nodes.*, c_custkey, CASE a WHEN 0 THEN c_nationkey::VARCHAR WHEN 1 THEN r_name ELSE '*' END AS q1,
    CASE b WHEN 0 THEN (floor(c_acctbal / 500) * 500)::BIGINT::VARCHAR WHEN 1 THEN (floor(c_acctbal / 1000) * 1000)::BIGINT::VARCHAR
      WHEN 2 THEN (floor(c_acctbal / 2000) * 2000)::BIGINT::VARCHAR WHEN 3 THEN (floor(c_acctbal / 4000) * 4000)::BIGINT::VARCHAR
      ELSE '*' END AS q2,
    CASE c WHEN 0 THEN c_mktsegment ELSE '*' END AS q3
  FROM p, nodes),
sizes AS (SELECT a, b, c, loss, q1, q2, q3, count(DISTINCT c_custkey) AS n FROM shown GROUP BY ALL),
best AS (SELECT a, b, c FROM sizes GROUP BY a, b, c, loss HAVING min(n) >= {C.K_LATTICE} ORDER BY round(loss, 9), a, b, c LIMIT 1)
SELECT c_custkey, q1 AS c_nationkey, q2 AS c_acctbal, q3 AS c_mktsegment, round(loss, 12) AS loss FROM shown SEMI JOIN best USING (a, b, c)
"""

def _protected_sql(rounds: int = 12) -> str:
    """The cube, then round by round one more cell on every margin with a single hidden one; more
    rounds than needed change nothing, and the last step fails the comparison if they did not suffice."""
    dims = ["r_name", "c_mktsegment", "band"]
    steps = [f"""WITH cube AS MATERIALIZED (
  SELECT r_name, c_mktsegment, floor(c_acctbal / 2500)::BIGINT AS band, count(*) AS customers,
    sum(c_acctbal::DECIMAL(12,2))::DOUBLE AS balance, grouping(r_name, c_mktsegment, band) AS gid
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY CUBE (r_name, c_mktsegment, band)),
h0 AS MATERIALIZED (
  SELECT *, row_number() OVER () AS id, CASE WHEN customers < {C.K_CUBE} THEN 'small' END AS hidden FROM cube)"""]
    for r in range(rounds):
        picks = []
        for i, d in enumerate(dims):
            bit = 1 << (2 - i)
            line = ", ".join([c for c in dims if c != d] + [f"gid & {7 - bit}"])
            picks.append(f"SELECT first(id ORDER BY customers, gid & {bit}, {d} NULLS FIRST) FILTER (hidden IS NULL) AS id FROM h{r} "
                         f"GROUP BY {line} HAVING count(hidden) = 1 AND max(gid & {bit}) > 0")
        steps.append(f"h{r + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN hidden IS NOT NULL THEN hidden "
                     f"WHEN id IN ({' UNION '.join(picks)}) THEN 'margin' END AS hidden) FROM h{r})")
    return ",\n".join(steps) + f"""
SELECT r_name, c_mktsegment, band, CASE WHEN hidden IS NULL THEN customers END AS customers,
  CASE WHEN hidden IS NULL THEN balance END AS balance, gid, hidden FROM h{rounds}
"""


A1_PROTECTED = _protected_sql()

R4_ROWS = """
WITH a AS (SELECT *, (l_orderkey // 250) % 23 AS band, l_orderkey % 7 AS place FROM lineitem),
b AS (
  SELECT * REPLACE (CASE WHEN band = 9 AND place = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM a
  WHERE NOT (band = 4 AND place = 1)
  UNION ALL SELECT * FROM a WHERE band = 16 AND place = 3),
x AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(a::VARCHAR)) AS r FROM a GROUP BY ALL),
y AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(b::VARCHAR)) AS r FROM b GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN y.n IS NULL THEN 'lost' WHEN x.n IS NULL THEN 'added' WHEN y.n > x.n THEN 'doubled'
  WHEN y.n < x.n THEN 'thinned' ELSE 'changed' END AS status, coalesce(x.n, 0) AS n_source, coalesce(y.n, 0) AS n_target
FROM x FULL JOIN y USING (l_orderkey, l_linenumber) WHERE x.r IS DISTINCT FROM y.r
"""

R5 = "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"

def _trend_sql(src: str, part: str, ts: str, measure: str, unit: str, width: int) -> str:
    """By the calendar: a spine of all periods, a self-join for the one before."""
    return f"""
WITH per AS (
  SELECT {part}, CAST(date_trunc('{unit}', {ts}) AS DATE) AS period, SUM(CAST({measure} AS DECIMAL(12,2))) AS v
  FROM {src} GROUP BY 1, 2)
SELECT p.{part}, p.period, CAST(p.v AS DOUBLE) AS value,
       CAST((SELECT SUM(x.v) FROM per x WHERE x.{part} = p.{part} AND x.period <= p.period) AS DOUBLE) AS running_total,
       (SELECT CAST(SUM(x.v) AS DOUBLE) / COUNT(*) FROM per x WHERE x.{part} = p.{part} AND x.period <= p.period
          AND x.period > p.period - INTERVAL {width} {unit}) AS moving_avg,
       CAST(p.v - b.v AS DOUBLE) AS change
FROM per p LEFT JOIN per b ON b.{part} = p.{part} AND b.period = p.period - INTERVAL 1 {unit}
"""


A2 = _trend_sql("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "month", 3)
A2_EVENTS = _trend_sql("events", "event_type", "ts", "value", "day", 7)
A2_LARGE = _trend_sql("(SELECT * FROM orders WHERE o_totalprice > 400000)", "o_orderpriority", "o_orderdate",
                      "o_totalprice", "day", 7)

A3_PARTS = """
WITH r AS (
  SELECT p_brand, p_partkey,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
              AS DOUBLE) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_partkey)
SELECT p_brand, p_partkey, revenue, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY revenue DESC, p_partkey ASC) AS rn FROM r)
WHERE rn <= 5
"""

A3 = """
SELECT c_nationkey, c_custkey, c_acctbal, CAST(rn AS INTEGER) AS rank FROM (
  SELECT c_nationkey, c_custkey, c_acctbal,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey ASC) AS rn
  FROM customer)
WHERE rn <= 3
"""

A4 = f"""
WITH l AS (SELECT {_tok('o_custkey', 'customer')} AS token, COUNT(*) AS n_orders,
                  SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS order_value
           FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
r AS (SELECT {_tok('user_id', 'customer')} AS token, COUNT(*) AS n_events
      FROM events WHERE user_id IS NOT NULL GROUP BY 1),
j AS (SELECT CASE WHEN l.token IS NOT NULL AND r.token IS NOT NULL THEN 'both'
                  WHEN l.token IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side,
             n_orders, order_value, n_events
      FROM l FULL OUTER JOIN r ON l.token = r.token)
SELECT side, COUNT(*) AS n_tokens, CAST(SUM(n_orders) AS BIGINT) AS n_orders,
       CAST(SUM(order_value) AS DOUBLE) AS order_value, CAST(SUM(n_events) AS BIGINT) AS n_events
FROM j GROUP BY side
"""

W1 = f"""
WITH g AS (
  SELECT {_tok('c_custkey', 'customer', WORKSPACE_PADS)} AS c_custkey, geo.r_name AS c_nationkey,
         c_mktsegment, CAST(floor(c_acctbal / 2500) * 2500 AS BIGINT) AS c_acctbal
  FROM customer LEFT JOIN {GEO} geo ON c_nationkey = geo.n_nationkey
  WHERE c_acctbal > 0)
SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY c_nationkey, c_mktsegment, c_acctbal) AS n FROM g)
WHERE n >= {C.K_SMALL_CELLS}
"""

W1_ORDERS = f"""
WITH g AS (
  SELECT {_tok('o_custkey', 'customer', WORKSPACE_PADS)} AS o_custkey,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate,
         CAST(floor(o_totalprice / 100000) * 100000 AS BIGINT) AS o_totalprice, o_orderpriority
  FROM orders),
safe AS (SELECT o_orderdate, o_totalprice, o_orderpriority FROM g GROUP BY ALL
         HAVING COUNT(DISTINCT o_custkey) >= {C.K_SMALL_CELLS})
SELECT g.o_custkey, g.o_orderdate, g.o_totalprice, g.o_orderpriority FROM g JOIN safe s
  ON g.o_orderdate IS NOT DISTINCT FROM s.o_orderdate AND g.o_totalprice IS NOT DISTINCT FROM s.o_totalprice
 AND g.o_orderpriority IS NOT DISTINCT FROM s.o_orderpriority
"""

W2 = f"""
SELECT * FROM orders
WHERE CAST(('0x' || substr(md5('{C.COHORT_SALT}|' || CAST(o_custkey AS VARCHAR)), 1, 8)) AS BIGINT) < 429496730
"""

W2_EVENTS = f"""
SELECT * FROM events
WHERE CAST(('0x' || substr(md5('{C.COHORT_SALT}|' || CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) < 429496730
"""


def _profile_sql() -> str:
    parts = []
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS n, COUNT(*) - COUNT({c}) AS n_null, "
            f"COUNT(DISTINCT {c}) AS n_distinct, MIN({x}) AS min, MAX({x}) AS max, AVG({x}) AS mean, "
            f"quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, 'exact' AS quantile_method FROM lineitem")
    c = "l_returnflag"
    parts.append(
        f"SELECT '{c}', COUNT({c}), COUNT(*) - COUNT({c}), COUNT(DISTINCT {c}), CAST(NULL AS DOUBLE), "
        "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        "CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM lineitem")
    return "\nUNION ALL\n".join(parts)


W3 = _profile_sql()

_BASKETS = """b AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
                   WHERE p_brand IS NOT NULL),
nb AS (SELECT COUNT(DISTINCT l_orderkey) AS n FROM b),
s1 AS (SELECT p_brand AS a, COUNT(*) AS freq FROM b GROUP BY p_brand),
s2 AS (SELECT x.p_brand AS a, y.p_brand AS c, COUNT(*) AS freq FROM b x JOIN b y
       ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY 1, 2),
s3 AS (SELECT x.p_brand AS a, y.p_brand AS c, z.p_brand AS d, COUNT(*) AS freq FROM b x
       JOIN b y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand
       JOIN b z ON y.l_orderkey = z.l_orderkey AND y.p_brand < z.p_brand GROUP BY 1, 2, 3)"""

W4_ITEMSETS = f"""
WITH {_BASKETS}
SELECT items, CAST(size AS INTEGER) AS size, freq, freq / n AS support FROM (
  SELECT a AS items, 1 AS size, freq FROM s1
  UNION ALL SELECT a || ',' || c, 2, freq FROM s2
  UNION ALL SELECT a || ',' || c || ',' || d, 3, freq FROM s3), nb
WHERE freq >= ceil(0.01 * n)
"""

W4_RULES = f"""
WITH {_BASKETS},
fp2 AS (SELECT s2.* FROM s2, nb WHERE s2.freq >= ceil(0.01 * nb.n)),
fp3 AS (SELECT s3.* FROM s3, nb WHERE s3.freq >= ceil(0.01 * nb.n)),
rules AS (
  SELECT fp2.a AS antecedent, fp2.c AS consequent, fp2.freq, s1.freq AS ante_freq
    FROM fp2 JOIN s1 ON s1.a = fp2.a
  UNION ALL SELECT fp2.c, fp2.a, fp2.freq, s1.freq FROM fp2 JOIN s1 ON s1.a = fp2.c
  UNION ALL SELECT fp3.a || ',' || fp3.c, fp3.d, fp3.freq, s2.freq
    FROM fp3 JOIN s2 ON s2.a = fp3.a AND s2.c = fp3.c
  UNION ALL SELECT fp3.a || ',' || fp3.d, fp3.c, fp3.freq, s2.freq
    FROM fp3 JOIN s2 ON s2.a = fp3.a AND s2.c = fp3.d
  UNION ALL SELECT fp3.c || ',' || fp3.d, fp3.a, fp3.freq, s2.freq
    FROM fp3 JOIN s2 ON s2.a = fp3.c AND s2.c = fp3.d)
SELECT antecedent, consequent, freq / ante_freq AS confidence, freq / nb.n AS support
FROM rules, nb
WHERE freq / ante_freq >= 0.1
"""

S2 = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

S3 = f"""
SELECT *, (SELECT max(ts) FROM events WHERE ts > TIMESTAMP '{C.INCREMENT_MARK}') AS new_mark
FROM events WHERE ts > TIMESTAMP '{C.INCREMENT_MARK}'
"""

S4 = "SELECT DISTINCT * FROM events"

S5 = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS ship_year
FROM ({_LINEITEM_NEWEST})
"""

S5_VERSIONED = f"""
WITH lines AS (SELECT *, l_shipdate <= TIMESTAMP '{C.SHIP_MARK}' AS early FROM lineitem),
every AS (
  SELECT * EXCLUDE (early), 9 AS seq, CASE WHEN early THEN 0 ELSE 1 END AS load FROM lines
  UNION ALL
  SELECT * EXCLUDE (early) REPLACE (l_shipdate + INTERVAL 400 DAYS AS l_shipdate), 10, 1 FROM lines WHERE l_orderkey % 7 = 0),
held AS (SELECT v, every.* FROM (VALUES (0), (1)) t(v) JOIN every ON load <= v),
one AS (
  SELECT *, row_number() OVER (PARTITION BY v, l_orderkey, l_linenumber
      ORDER BY seq DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM held)
SELECT * EXCLUDE (rn, v, load), CAST(year(l_shipdate) AS INTEGER) AS ship_year, 'version ' || v AS state FROM one WHERE rn = 1
UNION ALL
SELECT * EXCLUDE (early), NULL, NULL, 'quarantine' FROM lines WHERE l_orderkey % 101 = 0
"""

S3_STORED = "SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM events"

S4_LATE = f"""
WITH arrived AS (
  SELECT max(ts) - INTERVAL {C.LATE_DELAY} AS watermark FROM events WHERE event_id % 10 <> 0)
SELECT events.*, event_id % 10 = 0 AND ts < watermark AS late FROM events, arrived
"""

S6 = """
WITH delta AS (
  SELECT c_custkey, c_name || ' (revised)' AS c_name, c_nationkey, c_acctbal, c_mktsegment, 'U' AS op, 1 AS seq
    FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 1
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 2
    FROM customer WHERE c_acctbal < 0 AND c_nationkey = 1
  UNION ALL SELECT -c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 1
    FROM customer WHERE c_nationkey = 2
  UNION ALL SELECT c_custkey + 10000000000, c_name, c_nationkey, c_acctbal, c_mktsegment, 'I', 1
    FROM customer WHERE c_nationkey = 3),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey
      ORDER BY seq DESC, c_name DESC, c_nationkey DESC, c_acctbal DESC, c_mktsegment DESC, op DESC) AS rn
    FROM delta) WHERE rn = 1)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
 WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last WHERE op <> 'D'
"""

S5_SECOND = f"""
WITH every AS (
  SELECT *, 9 AS seq FROM lineitem
  UNION ALL
  SELECT * REPLACE (l_shipdate + INTERVAL 400 DAYS AS l_shipdate), 10 AS seq FROM lineitem WHERE l_orderkey % 7 = 0),
one AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY seq DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM every)
SELECT * EXCLUDE (rn), CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM one WHERE rn = 1
"""

S6_STORED = """
WITH delta AS (
  SELECT c_custkey, c_name || ' (revised)' AS c_name, c_nationkey, c_acctbal, c_mktsegment, 'U' AS op, 1 AS seq
    FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 1
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 2
    FROM customer WHERE c_acctbal < 0 AND c_nationkey = 1
  UNION ALL SELECT -c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 1
    FROM customer WHERE c_nationkey = 2
  UNION ALL SELECT NULL, c_name, c_nationkey, c_acctbal, c_mktsegment, 'I', 1 FROM customer WHERE c_nationkey = 3),
last AS (
  SELECT * FROM (SELECT * REPLACE (CASE WHEN c_nationkey <> 4 THEN op END AS op), row_number() OVER (PARTITION BY c_custkey
      ORDER BY seq DESC, c_name DESC, c_nationkey DESC, c_acctbal DESC, c_mktsegment DESC, op DESC) AS rn
    FROM delta) WHERE rn = 1)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
 WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.c_custkey IS NOT DISTINCT FROM customer.c_custkey)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last WHERE op IS DISTINCT FROM 'D'
"""

S6_VERSIONED = f"""
WITH delta AS ({S6.split("WITH delta AS (", 1)[1].split("),", 1)[0]}),
few AS (SELECT * FROM delta WHERE c_nationkey < 4),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey
      ORDER BY seq DESC, c_name DESC, c_nationkey DESC, c_acctbal DESC, c_mktsegment DESC, op DESC) AS rn
    FROM few) WHERE rn = 1),
touched AS (
  SELECT c_nationkey FROM last UNION SELECT customer.c_nationkey FROM customer SEMI JOIN last USING (c_custkey))
SELECT x.*, x.c_nationkey IN (SELECT c_nationkey FROM touched) AS rewritten FROM (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last WHERE op <> 'D') x
"""

W3_EXACT = """
WITH v AS (
  SELECT 'line_key' AS column_name, (9007199254740992 + l_orderkey * 2 + l_linenumber % 2)::DECIMAL(38,4) AS x FROM lineitem
  UNION ALL SELECT 'price', l_extendedprice::DECIMAL(12,2) FROM lineitem
  UNION ALL SELECT 'low_number', CASE WHEN l_linenumber < 3 THEN l_linenumber END FROM lineitem),
r AS (
  SELECT column_name, x, row_number() OVER (PARTITION BY column_name ORDER BY x) - 1 AS place, count(*) OVER (PARTITION BY column_name) AS n
  FROM v WHERE x IS NOT NULL),
q AS (
  SELECT column_name, k, max(x) FILTER (place = k * (n - 1) // 4) AS lo, max(x) FILTER (place = (k * (n - 1) + 3) // 4) AS hi,
    max(k * (n - 1) % 4) AS quarters
  FROM r, range(1, 4) t(k) GROUP BY ALL),
p AS (SELECT column_name, k, (lo + (hi - lo)::DECIMAL(16,4) * quarters::DECIMAL(2,0) / 4)::DECIMAL(38,4) AS e FROM q),
c AS (
  SELECT column_name, count(x) AS n, count(*) - count(x) AS n_null, count(DISTINCT x) AS n_distinct, min(x) AS min, max(x) AS max,
    sum((x * 10000)::HUGEINT) AS s FROM v GROUP BY 1)
SELECT column_name, n, n_null, n_distinct, min, max, (((2 * s + n) // (2 * n))::HUGEINT::DECIMAL(38,0) * 0.0001)::DECIMAL(38,4) AS mean,
  (SELECT e FROM p WHERE p.column_name = c.column_name AND k = 1) AS p25,
  (SELECT e FROM p WHERE p.column_name = c.column_name AND k = 2) AS p50,
  (SELECT e FROM p WHERE p.column_name = c.column_name AND k = 3) AS p75, 'exact' AS quantile_method
FROM c
"""

S7 = "SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier"

ORACLE: dict[str, str] = {
    "a1_management_report": A1,
    "a1_report_cube": A1_CUBE,
    "a1_protected_cube": A1_PROTECTED,
    "a1_report_grouping_sets": A1_SETS,
    "p1_pseudonymise": P1,
    "p2_token_vault": P2,
    "p3_reidentify": P3,
    "p4_mask_documents": P4_DOCS,
    "p4_mask_pages": P4_PAGES,
    "p5_generalise_customers": P5_CUSTOMERS,
    "p5_generalise_orders": P5_ORDERS,
    "p6_suppress_small_cells": P6,
    "p6_mask_small_cells": P6_MASK,
    "p6_k_anonymity": P6_K,
    "p6_least_generalisation": P6_LATTICE,
    "r1_build_dimension": R1,
    "r2_build_fact": R2,
    "r3_history_scd2": R3,
    "r3_history_events": R3_EVENTS,
    "r3_history_null_keys": R3_NULLS,
    "r3_history_batches": R3_BATCHES,
    "r4_quality_report": R4,
    "r4_reconcile_rows": R4_ROWS,
    "r5_flatten_json": R5,
    "a2_trend": A2,
    "a2_trend_events_daily": A2_EVENTS,
    "a2_trend_large_orders": A2_LARGE,
    "a3_top_n": A3,
    "a3_top_parts_by_revenue": A3_PARTS,
    "a4_cross_org_link": A4,
    "w1_workspace_extract": W1,
    "w1_orders_per_person": W1_ORDERS,
    "w2_sample_cohort": W2,
    "w2_sample_cohort_events": W2_EVENTS,
    "w3_profile": W3,
    "w3_profile_exact": W3_EXACT,
    "w4_mine_itemsets": W4_ITEMSETS,
    "w4_association_rules": W4_RULES,
    "s2_land_files": S2,
    "s3_ingest_incremental": S3,
    "s3_stored_marks": S3_STORED,
    "s4_stream_land": S4,
    "s4_stream_late": S4_LATE,
    "s5_promote_to_storage": S5,
    "s5_second_batch": S5_SECOND,
    "s5_versioned_loads": S5_VERSIONED,
    "s6_stored_upsert": S6_STORED,
    "s6_upsert_storage": S6,
    "s6_versioned_upsert": S6_VERSIONED,
    "s7_publish_workspace_table": S7,
}

ORACLE["w4_sequential_patterns"] = """
WITH e AS (SELECT user_id AS u, date_trunc('week', ts) AS s, event_type AS i,
                  row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS p
           FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL),
     held AS (SELECT DISTINCT u, s, i AS pattern, 1 AS length FROM e
              UNION ALL
              SELECT DISTINCT a.u, a.s, a.i || '>' || b.i, 2 FROM e a JOIN e b ON a.u = b.u AND a.s = b.s AND a.p < b.p
              UNION ALL
              SELECT DISTINCT a.u, a.s, a.i || '>' || b.i || '>' || c.i, 3
              FROM e a JOIN e b ON a.u = b.u AND a.s = b.s AND a.p < b.p
                       JOIN e c ON b.u = c.u AND b.s = c.s AND b.p < c.p),
     n AS (SELECT count(*) AS total FROM (SELECT DISTINCT u, s FROM e))
SELECT pattern, length, count(*) AS sessions, count(*) / (SELECT total FROM n) AS support
FROM held GROUP BY pattern, length HAVING count(*) / (SELECT total FROM n) >= 0.5
"""

ORACLE["w3_stored_sketches"] = """
WITH v AS (
  SELECT year(l_shipdate) AS ship_year, 'l_partkey' AS column_name, l_partkey::VARCHAR AS x FROM lineitem
  UNION ALL SELECT year(l_shipdate), 'l_extendedprice', l_extendedprice::VARCHAR FROM lineitem
  UNION ALL SELECT year(l_shipdate), 'l_returnflag', l_returnflag FROM lineitem
  UNION ALL SELECT year(l_shipdate), 'l_discount', l_discount::VARCHAR FROM lineitem
  UNION ALL SELECT year(l_shipdate), 'low_number', CASE WHEN l_linenumber < 3 THEN l_linenumber::VARCHAR END FROM lineitem),
n AS (SELECT ship_year, column_name, count(x) AS n, count(*) - count(x) AS n_null, count(DISTINCT x) AS n_distinct FROM v GROUP BY ALL),
h AS (SELECT ship_year, column_name, count(*) AS n_heavy FROM
        (SELECT ship_year, column_name, x, count(*) AS k FROM v WHERE x IS NOT NULL GROUP BY ALL) JOIN n USING (ship_year, column_name)
      WHERE k >= 0.05 * n GROUP BY ALL)
SELECT n.*, coalesce(n_heavy, 0) AS n_heavy, true AS counts_equal, true AS distinct_within, true AS ranks_within, true AS heavy_within
FROM n LEFT JOIN h USING (ship_year, column_name)
"""

ORACLE["a4_linkage_without_key"] = """
SELECT c_mktsegment, count(*) AS n_customers, true AS recall_reached, true AS precision_reached FROM customer GROUP BY 1
"""
