"""DuckDB formulations of the registered queries (the correctness oracle).

Independent of the Spark code paths: working days are counted by generating
every day of an interval, itemsets by self-joins, quantiles with
``quantile_cont``.  Views ``kopf`` / ``pos`` rebuild the header and position
tables from the driver tables with the same arithmetic as
``sources.driver_tables``.
"""

from __future__ import annotations

from servicelens import schema as S
from servicelens.functions.dates import parse_arg_date, spark_pattern
from servicelens.operators.clusters import TOLERANCE
from servicelens.operators.demand import period_months
from servicelens.plans import workload as W
from servicelens.sources import driver_tables as _dt


def _d(value: str) -> str:
    return f"DATE '{parse_arg_date(value).isoformat()}'"


START, END = _d(W.START), _d(W.END)
FULL_START, FULL_END = _d(W.FULL_START), _d(W.FULL_END)
TYPE = f"'{W.TYPE}'"

_MODULI = (5, 7, 3, 11, 13, 4)


def _stage_dates() -> str:
    out = [f"CAST(o.o_orderdate AS DATE) AS {S.STAGE_DATES[0]}"]
    acc = []
    for m, name in zip(_MODULI, S.STAGE_DATES[1:]):
        acc.append(f"o.o_orderkey % {m}")
        out.append(f"CAST(o.o_orderdate AS DATE) + CAST({' + '.join(acc)} AS INTEGER) AS {name}")
    return ",\n    ".join(out)


VIEWS = f"""
kopf AS (
  SELECT o.o_orderkey AS order_id,
    substr(printf('%02d', o.o_custkey % 100) || '.' || CAST(o.o_custkey AS VARCHAR) || '.' || CAST(o.o_custkey % 10 AS VARCHAR), 1, 2)
      || substr(printf('%02d', o.o_custkey % 100) || '.' || CAST(o.o_custkey AS VARCHAR) || '.' || CAST(o.o_custkey % 10 AS VARCHAR), 4) AS address_code,
    'K0' || printf('%06d', o.o_custkey % 19) AS product_article,
    c.c_mktsegment AS product_type,
    {_stage_dates()}
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
pos AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS "position",
    CASE l.l_partkey % 20 WHEN 0 THEN 'KK002' WHEN 1 THEN 'KK060'
      WHEN 2 THEN 'X' || printf('%06d', l.l_partkey)
      ELSE 'K0' || printf('%06d', l.l_partkey) END AS part_no,
    p.p_name AS part_name, l.l_quantity AS quantity, p.p_type AS part_type
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

# Public holidays (Rhineland-Palatinate) for the years of the data.
HOLIDAYS = """
yrs AS (SELECT CAST(range AS BIGINT) AS y FROM range(1980, 2031)),
eas0 AS (
  SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs
),
eas1 AS (
  SELECT y, a, b, c, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM eas0
),
eas2 AS (
  SELECT y, a, e, i, k, (19 * a + b - d - ((b - f + 1) // 3) + 15) % 30 AS h FROM eas1
),
eas3 AS (
  SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM eas2
),
easter AS (
  SELECT y, make_date(y, CAST((h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31 AS BIGINT),
                       CAST((h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1 AS BIGINT)) AS e
  FROM eas3
),
hol AS (
  SELECT make_date(y, 1, 1) AS h FROM yrs
  UNION ALL SELECT make_date(y, 5, 1) FROM yrs
  UNION ALL SELECT make_date(y, 10, 3) FROM yrs
  UNION ALL SELECT make_date(y, 11, 1) FROM yrs
  UNION ALL SELECT make_date(y, 12, 25) FROM yrs
  UNION ALL SELECT make_date(y, 12, 26) FROM yrs
  UNION ALL SELECT e - 2 FROM easter
  UNION ALL SELECT e + 1 FROM easter
  UNION ALL SELECT e + 39 FROM easter
  UNION ALL SELECT e + 50 FROM easter
  UNION ALL SELECT e + 60 FROM easter
  UNION ALL SELECT DATE '2017-10-31'
)"""


def brute_force_wd(pairs: str, name: str) -> str:
    """CTEs ``{name}`` (pid, n): working days of each (pid, a, b) pair in
    ``pairs``, counted day by day.  Pairs with no working day are absent."""
    return f"""
{name}_off AS (
  SELECT pid, lo, unnest(generate_series(1, hi - lo)) AS k
  FROM (SELECT pid, least(a, b) AS lo, greatest(a, b) AS hi FROM {pairs}) WHERE hi > lo
),
{name} AS (
  SELECT pid, count(*) AS n FROM (SELECT pid, lo + CAST(k AS INTEGER) AS d FROM {name}_off) t
  WHERE isodow(d) <= 5 AND d NOT IN (SELECT h FROM hol)
  GROUP BY pid
)"""


_STAGE_NAMES = S.STAGE_DURATIONS


def _stage_pairs() -> str:
    parts = []
    for i, (a, b) in enumerate(zip(S.STAGE_DATES, S.STAGE_DATES[1:])):
        parts.append(f"SELECT order_id * 10 + {i} AS pid, {a} AS a, {b} AS b FROM kopf")
    return "\n  UNION ALL ".join(parts)


STAGES = f"""
stage_pairs AS (
  {_stage_pairs()}
),
{brute_force_wd('stage_pairs', 'stage_n')},
kopf_wd AS (
  SELECT k.*,
    {", ".join(f"coalesce((SELECT n FROM stage_n s WHERE s.pid = k.order_id * 10 + {i}), 0) AS {n}" for i, n in enumerate(_STAGE_NAMES))}
  FROM kopf k
),
kopf_feat AS (
  SELECT *, {" + ".join(_STAGE_NAMES)} AS {S.LEAD_TIME},
    CASE WHEN len(string_split(address_code, '.')) <= 2 THEN string_split(address_code, '.')[1] END AS customer_no,
    CASE WHEN len(string_split(address_code, '.')) <= 2 THEN string_split(address_code, '.')[2] END AS contact_no
  FROM kopf_wd
)"""

PARTS = """
merged AS (SELECT * FROM kopf JOIN pos USING (order_id)),
kept AS (SELECT * FROM merged WHERE part_no LIKE 'K0%'),
parts AS (SELECT * FROM kept k WHERE NOT EXISTS (SELECT 1 FROM kept k2 WHERE k2.product_article = k.part_no))"""

FEATURED = f"""
labour AS (
  SELECT order_id, sum(quantity) AS labour_units FROM pos WHERE part_no IN ('KK002', 'KK060') GROUP BY order_id
),
featured AS (
  SELECT p.order_id, p."position", p.part_no, p.part_name, p.quantity, p.part_type, p.product_type,
    p.product_article, f.d_goods_in, f.d_goods_out, f.customer_no, f.contact_no,
    {", ".join("f." + c for c in _STAGE_NAMES)}, f.{S.LEAD_TIME}, l.labour_units
  FROM parts p JOIN kopf_feat f USING (order_id) LEFT JOIN labour l USING (order_id)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


BASE = with_(VIEWS, HOLIDAYS, STAGES, PARTS, FEATURED)

SEL = f"""
sel AS (
  SELECT * FROM featured
  WHERE d_goods_out >= {START} AND d_goods_out <= {END} AND product_type = {TYPE}
)"""

SEL_ALL = f"""
sel AS (
  SELECT * FROM featured WHERE d_goods_out >= {START} AND d_goods_out <= {END}
)"""


def _avg(c: str) -> str:
    return (
        f"CASE WHEN count(*) = 0 THEN NULL ELSE CAST(coalesce(sum({c}), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) END"
        f" AS {c}_avg"
    )


_TIME_SELECT = f"""
  CAST(count(*) AS BIGINT) AS n_orders,
  {", ".join(_avg(c) for c in S.DURATION_COLUMNS)}"""

TIME_BY_TYPE = f"""
po AS (SELECT DISTINCT order_id, product_type, {", ".join(S.DURATION_COLUMNS)} FROM sel),
times AS (
  SELECT {START} AS start_date, {END} AS end_date, product_type, {_TIME_SELECT}
  FROM po GROUP BY product_type
)"""


def _waterfall() -> str:
    parts = [
        f"SELECT product_type, {i} AS stage_ord, '{c}' AS stage, {c}_avg AS days FROM times"
        for i, c in enumerate(S.DURATION_COLUMNS)
    ]
    return "\n  UNION ALL ".join(parts)


PROCESS = f"""
po AS (SELECT DISTINCT order_id, labour_units FROM sel),
sc AS (
  SELECT CAST(count(*) AS BIGINT) AS n_orders, CAST(coalesce(sum(labour_units), 0) AS DOUBLE) AS total_labour_units FROM po
),
period AS (SELECT 0 AS pid, {START} AS a, {END} AS b),
{brute_force_wd('period', 'period_n')},
pp0 AS (
  SELECT part_no, first(part_name ORDER BY order_id, "position") AS part_name,
    CAST(sum(quantity) AS DOUBLE) AS total_part_qty, min(order_id) AS first_order
  FROM sel GROUP BY part_no
),
pp AS (
  SELECT pp0.*, CAST(row_number() OVER (ORDER BY first_order, first_pos, part_no) AS BIGINT) AS part_seq
  FROM pp0 JOIN (
    SELECT s.part_no, min(s."position") AS first_pos FROM sel s JOIN pp0 p
      ON s.part_no = p.part_no AND s.order_id = p.first_order GROUP BY s.part_no
  ) fp USING (part_no)
),
process AS (
  SELECT {START} AS start_date, {END} AS end_date, {TYPE} AS product_type, sc.n_orders, sc.total_labour_units,
    sc.total_labour_units / CAST(sc.n_orders AS DOUBLE) AS labour_units_per_order,
    CAST(coalesce((SELECT n FROM period_n), 0) AS DOUBLE) / CAST(sc.n_orders AS DOUBLE) AS order_cycle,
    pp.part_seq, pp.part_no, pp.part_name, pp.total_part_qty,
    pp.total_part_qty / CAST(sc.n_orders AS DOUBLE) AS part_qty_per_order
  FROM pp CROSS JOIN sc
)"""

_KEY_FIGURES = ["n_orders", "total_labour_units", "labour_units_per_order", "order_cycle"]


ORACLE: dict[str, str] = {
    "working_days_delta": with_(
        VIEWS,
        HOLIDAYS,
        """
lp AS (
  SELECT row_number() OVER () AS pid, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
    CAST(o.o_orderdate AS DATE) AS a, CAST(l.l_shipdate AS DATE) AS b
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)""",
        brute_force_wd("lp", "lp_n"),
    )
    + """
SELECT lp.l_orderkey, lp.l_linenumber, lp.l_partkey, lp.l_suppkey, lp.a AS order_date, lp.b AS ship_date,
  CAST(coalesce(lp_n.n, 0) AS BIGINT) AS working_days
FROM lp LEFT JOIN lp_n USING (pid)""",
    "stage_durations": with_(VIEWS, HOLIDAYS, STAGES)
    + f"""
SELECT order_id, product_type, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _STAGE_NAMES)},
  CAST({S.LEAD_TIME} AS BIGINT) AS {S.LEAD_TIME}
FROM kopf_feat""",
    "time_analysis": BASE[:-1]
    + ","
    + SEL.strip("\n")
    + f""",
po AS (SELECT DISTINCT order_id, {", ".join(S.DURATION_COLUMNS)} FROM sel)
SELECT {START} AS start_date, {END} AS end_date, {TYPE} AS product_type, {_TIME_SELECT}
FROM po""",
    "time_analysis_by_type": BASE[:-1] + "," + SEL_ALL.strip("\n") + "," + TIME_BY_TYPE.strip("\n") + "\nSELECT * FROM times",
    "time_waterfall": BASE[:-1]
    + ","
    + SEL_ALL.strip("\n")
    + ","
    + TIME_BY_TYPE.strip("\n")
    + f""",
bars AS (
  {_waterfall()}
)
SELECT product_type, stage_ord, stage, days,
  coalesce(sum(days) OVER (PARTITION BY product_type ORDER BY stage_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS bar_start
FROM bars""",
    "prepared_parts": with_(VIEWS, PARTS)
    + """
SELECT order_id, "position", part_no, part_name, quantity, product_article, product_type FROM parts""",
    "labour_units": BASE + """
SELECT order_id, "position", part_no, labour_units FROM featured""",
    "featured_parts": BASE
    + f"""
SELECT order_id, "position", part_no, product_type, customer_no, contact_no,
  {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _STAGE_NAMES)}, CAST({S.LEAD_TIME} AS BIGINT) AS {S.LEAD_TIME}, labour_units
FROM featured""",
    "process_analysis": BASE[:-1] + "," + SEL.strip("\n") + "," + PROCESS.strip("\n") + "\nSELECT * FROM process",
    "part_ranking": BASE[:-1]
    + ","
    + SEL.strip("\n")
    + ","
    + PROCESS.strip("\n")
    + """
SELECT product_type, part_no, part_name, total_part_qty,
  CAST(row_number() OVER (ORDER BY total_part_qty DESC, product_type, part_no) AS BIGINT) AS rank
FROM process""",
    "key_figures": BASE[:-1]
    + ","
    + SEL.strip("\n")
    + ","
    + PROCESS.strip("\n")
    + ",\nk AS (SELECT DISTINCT product_type, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _KEY_FIGURES)
    + " FROM process)\n"
    + "\nUNION ALL ".join(
        f"SELECT product_type, '{c}' AS figure, {c} AS value, {i} AS figure_ord FROM k"
        for i, c in enumerate(_KEY_FIGURES)
    ),
}


# ---------------------------------------------------------------------------
# Rules: itemsets by self-joins over the whole item vocabulary (six part
# types), rules by joining disjoint itemset pairs to their union.
# ---------------------------------------------------------------------------

RULE_SUPPORT = repr(W.RULE_MIN_SUPPORT)
RULE_CONFIDENCE = repr(W.RULE_MIN_CONFIDENCE)
WATCH = ", ".join(f"'{x}'" for x in W.RULE_WATCH)


def _combo(k: int) -> str:
    alias = [f"x{i}" for i in range(k)]
    frm = " JOIN ".join(
        f"b {a}" + ("" if i == 0 else f" ON {a}.order_id = x0.order_id AND {alias[i - 1]}.item < {a}.item")
        for i, a in enumerate(alias)
    )
    items = ", ".join(f"{a}.item" for a in alias)
    return f"SELECT [{items}] AS items, count(*) AS freq FROM {frm} GROUP BY {items}"


RULE_BASE = (
    with_(VIEWS, PARTS)[:-1]
    + f""",
rsel AS (
  SELECT * FROM parts WHERE d_goods_out >= {START} AND d_goods_out <= {END} AND product_type = {TYPE}
),
b AS (SELECT DISTINCT order_id, part_type AS item FROM rsel WHERE part_type IS NOT NULL),
nb AS (SELECT count(DISTINCT order_id) AS n FROM b),
allsets AS (
  {" UNION ALL ".join(_combo(k) for k in range(1, 7))}
),
fi AS (
  SELECT items, len(items) AS size, freq, CAST(freq AS DOUBLE) / CAST(n AS DOUBLE) AS support
  FROM allsets CROSS JOIN nb
  WHERE CAST(freq AS DOUBLE) / CAST(n AS DOUBLE) >= {RULE_SUPPORT}
),
ru0 AS (
  SELECT a.items AS antecedents, c.items AS consequents, a.support AS antecedent_support,
    c.support AS consequent_support, u.support AS support
  FROM fi a JOIN fi c ON len(list_intersect(a.items, c.items)) = 0
  JOIN fi u ON u.items = list_sort(list_concat(a.items, c.items))
),
ru AS (
  SELECT antecedents, consequents, array_to_string(antecedents, '_und_') AS antecedent,
    array_to_string(consequents, '_und_') AS consequent, antecedent_support, consequent_support, support,
    support / antecedent_support AS confidence,
    (support / antecedent_support) / consequent_support AS lift,
    support - antecedent_support * consequent_support AS leverage,
    CASE WHEN support / antecedent_support = 1.0 THEN 'inf'::DOUBLE
      ELSE (1.0 - consequent_support) / (1.0 - support / antecedent_support) END AS conviction,
    CASE WHEN greatest(support * (1.0 - antecedent_support), antecedent_support * (consequent_support - support)) = 0.0 THEN 0.0
      ELSE (support - antecedent_support * consequent_support)
        / greatest(support * (1.0 - antecedent_support), antecedent_support * (consequent_support - support)) END AS zhang
  FROM ru0
  WHERE support / antecedent_support >= {RULE_CONFIDENCE}
),
wr AS (
  SELECT * FROM ru WHERE list_has_any(antecedents, [{WATCH}]) AND list_has_any(consequents, [{WATCH}])
),
na AS (SELECT count(DISTINCT antecedent) AS n FROM wr),
nodes AS (
  SELECT CAST(row_number() OVER (ORDER BY antecedent) - 1 AS BIGINT) AS node_id, antecedent AS label, 'antecedent' AS side
  FROM (SELECT DISTINCT antecedent FROM wr)
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY consequent) - 1 + (SELECT n FROM na) AS BIGINT), consequent, 'consequent'
  FROM (SELECT DISTINCT consequent FROM wr)
)
"""
)



def _combo_by_type(k: int) -> str:
    alias = [f"x{i}" for i in range(k)]
    frm = " JOIN ".join(
        f"b {a}" + ("" if i == 0 else f" ON {a}.order_id = x0.order_id AND {a}.product_type = x0.product_type AND {alias[i - 1]}.item < {a}.item")
        for i, a in enumerate(alias)
    )
    items = ", ".join(f"{a}.item" for a in alias)
    return f"SELECT x0.product_type, [{items}] AS items, count(*) AS freq FROM {frm} GROUP BY x0.product_type, {items}"


RULES_BY_TYPE = (
    with_(VIEWS, PARTS)[:-1]
    + f""",
b AS (
  SELECT DISTINCT product_type, order_id, part_type AS item FROM parts
  WHERE d_goods_out >= {START} AND d_goods_out <= {END} AND part_type IS NOT NULL
),
nb AS (SELECT product_type, count(DISTINCT order_id) AS n FROM b GROUP BY product_type),
fi AS (
  SELECT s.product_type, items, len(items) AS size, freq, CAST(freq AS DOUBLE) / CAST(n AS DOUBLE) AS support
  FROM ({" UNION ALL ".join(_combo_by_type(k) for k in range(1, 7))}) s JOIN nb USING (product_type)
  WHERE CAST(freq AS DOUBLE) / CAST(n AS DOUBLE) >= {RULE_SUPPORT}
),
ru0 AS (
  SELECT a.product_type, a.items AS antecedents, c.items AS consequents, a.support AS antecedent_support,
    c.support AS consequent_support, u.support AS support
  FROM fi a JOIN fi c ON a.product_type = c.product_type AND len(list_intersect(a.items, c.items)) = 0
  JOIN fi u ON u.product_type = a.product_type AND u.items = list_sort(list_concat(a.items, c.items))
)
"""
)

_RULE_METRICS = """array_to_string(antecedents, '_und_') AS antecedent,
    array_to_string(consequents, '_und_') AS consequent, antecedent_support, consequent_support, support,
    support / antecedent_support AS confidence,
    (support / antecedent_support) / consequent_support AS lift,
    support - antecedent_support * consequent_support AS leverage,
    CASE WHEN support / antecedent_support = 1.0 THEN 'inf'::DOUBLE
      ELSE (1.0 - consequent_support) / (1.0 - support / antecedent_support) END AS conviction,
    CASE WHEN greatest(support * (1.0 - antecedent_support), antecedent_support * (consequent_support - support)) = 0.0 THEN 0.0
      ELSE (support - antecedent_support * consequent_support)
        / greatest(support * (1.0 - antecedent_support), antecedent_support * (consequent_support - support)) END AS zhang"""

_RULE_OUT = "antecedent, consequent, antecedent_support, consequent_support, support, confidence, lift, leverage, conviction, zhang"

ORACLE.update(
    {
        "baskets": RULE_BASE
        + "SELECT order_id, array_to_string(list_sort(list(item)), '_und_') AS items, CAST(count(*) AS BIGINT) AS n_items FROM b GROUP BY order_id",
        "frequent_itemsets": RULE_BASE
        + "SELECT array_to_string(items, '_und_') AS items, CAST(size AS BIGINT) AS size, CAST(freq AS BIGINT) AS freq, support FROM fi",
        "association_rules": RULE_BASE + f"SELECT {_RULE_OUT} FROM ru",
        "frequent_itemsets_by_type": RULES_BY_TYPE
        + """SELECT product_type, array_to_string(items, '_und_') AS items, CAST(size AS BIGINT) AS size,
  CAST(freq AS BIGINT) AS freq, support FROM fi""",
        "association_rules_by_type": RULES_BY_TYPE
        + f"SELECT product_type, {_RULE_METRICS} FROM ru0 WHERE support / antecedent_support >= {RULE_CONFIDENCE}",
        "watched_rules": RULE_BASE + f"SELECT {_RULE_OUT} FROM wr",
        "rule_edges": RULE_BASE + "SELECT antecedent AS source, consequent AS target, confidence FROM wr",
        "sankey_nodes": RULE_BASE + "SELECT * FROM nodes",
        "sankey_links": RULE_BASE
        + """SELECT s.node_id AS source_id, t.node_id AS target_id, wr.confidence * 100.0 AS value, wr.antecedent, wr.consequent
FROM wr JOIN nodes s ON s.side = 'antecedent' AND s.label = wr.antecedent
JOIN nodes t ON t.side = 'consequent' AND t.label = wr.consequent""",
    }
)


# ---------------------------------------------------------------------------
# Demand series and part features.
# ---------------------------------------------------------------------------

_LAGS = ", ".join(f"lag(qty, {k}) OVER w AS lag_{k:02d}" for k in range(1, 13))

DEMAND_BASE = (
    with_(VIEWS, PARTS)[:-1]
    + f""",
dsel AS (
  SELECT * FROM parts WHERE d_goods_out >= {FULL_START} AND d_goods_out <= {FULL_END} AND product_type = {TYPE}
),
mon AS (
  SELECT CAST(date_trunc('month', d_goods_out) AS DATE) AS month, part_no, CAST(sum(quantity) AS DOUBLE) AS qty
  FROM dsel GROUP BY 1, 2
),
tot AS (SELECT part_no, sum(qty) AS total_qty FROM mon GROUP BY part_no),
shr AS (SELECT part_no, total_qty, total_qty / (SELECT sum(total_qty) FROM tot) AS share FROM tot),
thr AS (SELECT quantile_cont(share, 0.9) AS threshold FROM shr),
top AS (SELECT shr.* FROM shr, thr WHERE share >= threshold),
smon AS (SELECT * FROM mon WHERE part_no IN (SELECT part_no FROM top)),
months AS (
  SELECT CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM smon
),
filled AS (
  SELECT m.month, p.part_no, coalesce(s.qty, 0.0) AS qty
  FROM months m CROSS JOIN (SELECT DISTINCT part_no FROM smon) p
  LEFT JOIN smon s ON s.month = m.month AND s.part_no = p.part_no
),
nm AS (SELECT count(*) AS n FROM months),
seq AS (
  SELECT part_no, month, qty, {_LAGS}, row_number() OVER w AS rn FROM filled
  WINDOW w AS (PARTITION BY part_no ORDER BY month)
)
"""
)

DEMAND_BY_TYPE = (
    with_(VIEWS, PARTS)[:-1]
    + f""",
mon AS (
  SELECT product_type, CAST(date_trunc('month', d_goods_out) AS DATE) AS month, part_no, CAST(sum(quantity) AS DOUBLE) AS qty
  FROM parts WHERE d_goods_out >= {FULL_START} AND d_goods_out <= {FULL_END} GROUP BY 1, 2, 3
),
tot AS (SELECT product_type, part_no, sum(qty) AS total_qty FROM mon GROUP BY ALL),
grand AS (SELECT product_type, sum(total_qty) AS grand_qty FROM tot GROUP BY ALL),
shr AS (SELECT product_type, part_no, total_qty, total_qty / grand_qty AS share FROM tot JOIN grand USING (product_type)),
thr AS (SELECT product_type, quantile_cont(share, 0.9) AS threshold FROM shr GROUP BY ALL),
top AS (SELECT product_type, part_no, total_qty, share, threshold FROM shr JOIN thr USING (product_type) WHERE share >= threshold),
smon AS (SELECT mon.* FROM mon SEMI JOIN top USING (product_type, part_no)),
months AS (
  SELECT product_type, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM smon GROUP BY product_type
),
filled AS (
  SELECT m.product_type, m.month, p.part_no, coalesce(s.qty, 0.0) AS qty
  FROM months m JOIN (SELECT DISTINCT product_type, part_no FROM smon) p USING (product_type)
  LEFT JOIN smon s ON s.product_type = m.product_type AND s.month = m.month AND s.part_no = p.part_no
),
nm AS (SELECT product_type, count(*) AS n FROM months GROUP BY ALL),
seq AS (
  SELECT product_type, part_no, month, qty, {_LAGS}, row_number() OVER w AS rn FROM filled
  WINDOW w AS (PARTITION BY product_type, part_no ORDER BY month)
)
"""
)

_SEQ_OUT = ", ".join(f"lag_{k:02d}" for k in range(12, 0, -1))

CLUSTER_BASE = (
    with_(VIEWS, PARTS)[:-1]
    + f""",
csel AS (
  SELECT * FROM parts WHERE d_goods_out >= {START} AND d_goods_out <= {END} AND product_type = {TYPE}
),
pf AS (
  SELECT part_no, first(part_name ORDER BY order_id, "position") AS part_name, CAST(sum(quantity) AS DOUBLE) AS quantity,
    CAST(count(DISTINCT order_id) AS BIGINT) AS frequency
  FROM csel GROUP BY part_no
),
top5 AS (SELECT part_name FROM pf ORDER BY quantity DESC, frequency DESC, part_no LIMIT 5),
crit AS (SELECT * FROM pf WHERE part_name IN (SELECT part_name FROM top5))
"""
)


def _translations() -> str:
    rows = ", ".join(
        "('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in S.PART_NAME_TRANSLATIONS.items()
    )
    return f"(VALUES {rows}) AS t(part_name, en)"


ORACLE.update(
    {
        "monthly_demand": DEMAND_BASE + "SELECT strftime(month, '%Y-%m') AS month, part_no, qty FROM mon",
        "part_share": DEMAND_BASE + "SELECT part_no, total_qty, share FROM shr",
        "top_contributors": DEMAND_BASE + "SELECT part_no, total_qty, share FROM top",
        "demand_filled": DEMAND_BASE + "SELECT strftime(month, '%Y-%m') AS month, part_no, qty FROM filled",
        "demand_sequences": DEMAND_BASE
        + f"""SELECT part_no, strftime(month, '%Y-%m') AS target_month, CAST(rn - 13 AS BIGINT) AS sample_idx,
  CASE WHEN rn - 13 < floor(0.8 * ((SELECT n FROM nm) - 12)) THEN 'train' ELSE 'validation' END AS split,
  {_SEQ_OUT}, qty AS target
FROM seq WHERE rn > 12""",
        "top_contributors_by_type": DEMAND_BY_TYPE + "SELECT * FROM top",
        "demand_sequences_by_type": DEMAND_BY_TYPE
        + f"""SELECT product_type, part_no, strftime(month, '%Y-%m') AS target_month, CAST(rn - 13 AS BIGINT) AS sample_idx,
  CASE WHEN rn - 13 < floor(0.8 * (n - 12)) THEN 'train' ELSE 'validation' END AS split,
  {_SEQ_OUT}, qty AS target
FROM seq JOIN nm USING (product_type) WHERE rn > 12""",
        "part_features": CLUSTER_BASE + "SELECT * FROM pf",
        "critical_parts": CLUSTER_BASE + "SELECT part_name, part_no, quantity, frequency FROM crit",
        "translated_parts": CLUSTER_BASE
        + f"""SELECT c.part_name, c.part_no, c.quantity, c.frequency, coalesce(t.en, c.part_name) AS english_name
FROM crit c LEFT JOIN {_translations()} ON c.part_name = t.part_name""",
    }
)

# k-means by recursion: first centres drawn one by one, then Lloyd's iterations of
# every run (g, k) until no centre moves farther than the tolerance.
_LO, _HI = S.DEFAULT_K_RANGE
_MOVED = "list_max(list_transform(range(1, k + 1), lambda i: (old[i].x - centres[i].x) * (old[i].x - centres[i].x) + (old[i].y - centres[i].y) * (old[i].y - centres[i].y)))"
_NEAR = "list_transform(centres, lambda c: (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y))"


def _draw(step: str) -> str:
    return f"-ln((CAST('0x' || substr(md5(name || ':' || {step}), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0)"


def _kmeans(features: str) -> str:
    """CTEs over ``features`` (g, part_no, quantity, frequency): ``runs`` (g, k,
    centres) and ``scores`` (g, k, silhouette, chosen)."""
    square = f"{TOLERANCE!r}::DOUBLE * {TOLERANCE!r}::DOUBLE"
    total = "(c.n * (p.x * p.x + p.y * p.y) - 2 * (p.x * c.sx + p.y * c.sy) + c.sq)"
    return f"""
pts AS (
  SELECT g, CAST(quantity AS DOUBLE) AS x, CAST(frequency AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS weight, min(part_no) AS name
  FROM {features} GROUP BY 1, 2, 3
),
seeds AS (
  SELECT g, 1 AS step, [first({{'x': x, 'y': y}} ORDER BY {_draw("0")} / weight, name)] AS centres FROM pts GROUP BY g
  UNION ALL
  SELECT g, step + 1, list_append(centres, first({{'x': x, 'y': y}} ORDER BY {_draw("step")} / (weight * near), name))
  FROM (SELECT s.g, s.step, s.centres, p.x, p.y, p.weight, p.name, list_min({_NEAR}) AS near FROM seeds s JOIN pts p USING (g)) t
  WHERE weight * near > 0 AND step < {_HI} GROUP BY g, step, centres
),
sizes AS (SELECT g, sum(weight) AS n FROM pts GROUP BY g),
lloyd AS (
  SELECT g, step AS k, centres, CAST(NULL AS STRUCT(x DOUBLE, y DOUBLE)[]) AS old FROM seeds JOIN sizes USING (g) WHERE step >= {_LO} AND step < n
  UNION ALL
  SELECT g, k, list_transform(range(1, k + 1), lambda i: coalesce(means[i], centres[i])), centres
  FROM (
    SELECT g, k, centres, map(list(cluster), list({{'x': sx / n, 'y': sy / n}})) AS means
    FROM (
      SELECT g, k, centres, cluster, sum(weight * x) AS sx, sum(weight * y) AS sy, sum(weight) AS n
      FROM (
        SELECT r.g, r.k, r.centres, p.x, p.y, p.weight, list_position({_NEAR}, list_min({_NEAR})) AS cluster
        FROM lloyd r JOIN pts p USING (g) WHERE r.old IS NULL OR {_MOVED} > {square}
      ) a GROUP BY g, k, centres, cluster
    ) b GROUP BY g, k, centres
  ) c
),
runs AS (SELECT g, k, centres FROM lloyd WHERE old IS NOT NULL AND {_MOVED} <= {square}),
assigned AS (
  SELECT r.g, r.k, p.x, p.y, p.weight, list_position({_NEAR}, list_min({_NEAR})) AS cluster FROM runs r JOIN pts p USING (g)
),
stats AS (
  SELECT g, k, cluster, sum(weight) AS n, sum(weight * x) AS sx, sum(weight * y) AS sy, sum(weight * (x * x + y * y)) AS sq
  FROM assigned GROUP BY g, k, cluster
),
ab AS (
  SELECT p.g, p.k, p.weight, p.x, p.y,
    max(CASE WHEN c.cluster = p.cluster AND c.n > 1 THEN {total} / (c.n - 1) END) AS a,
    min(CASE WHEN c.cluster <> p.cluster THEN {total} / c.n END) AS b
  FROM assigned p JOIN stats c ON c.g = p.g AND c.k = p.k GROUP BY ALL
),
scored AS (
  SELECT g, k, sum(weight * CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) / sum(weight) AS silhouette
  FROM ab GROUP BY g, k
),
scores AS (
  SELECT g, CAST(k AS INTEGER) AS k, silhouette, row_number() OVER (PARTITION BY g ORDER BY silhouette DESC, k) = 1 AS chosen FROM scored
)
"""


CLUSTERS = (
    CLUSTER_BASE.replace("WITH ", "WITH RECURSIVE ", 1)
    + ", pg AS (SELECT 'all' AS g, * FROM pf),"
    + _kmeans("pg")
    + f""",
best AS (SELECT runs.* FROM runs JOIN scores USING (g, k) WHERE chosen),
labelled AS (
  SELECT p.part_no, p.part_name, p.quantity, p.frequency, {_NEAR.replace("p.x", "CAST(p.quantity AS DOUBLE)").replace("p.y", "CAST(p.frequency AS DOUBLE)")} AS ds
  FROM pf p, best
)
"""
)

CLUSTERS_BY_TYPE = (
    with_(VIEWS, PARTS)[:-1].replace("WITH ", "WITH RECURSIVE ", 1)
    + f""",
pg AS (
  SELECT product_type AS g, part_no, CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(count(DISTINCT order_id) AS BIGINT) AS frequency
  FROM parts WHERE d_goods_out >= {START} AND d_goods_out <= {END} GROUP BY 1, 2
),"""
    + _kmeans("pg")
)

ORACLE["k_sweep"] = CLUSTERS + "SELECT k, silhouette, chosen FROM scores"
ORACLE["k_sweep_by_type"] = CLUSTERS_BY_TYPE + "SELECT g AS product_type, k, silhouette, chosen FROM scores"
ORACLE["cluster_centers"] = CLUSTERS + (
    "SELECT CAST(i - 1 AS INTEGER) AS cluster, centres[i].x AS quantity, centres[i].y AS frequency "
    "FROM (SELECT centres, unnest(range(1, len(centres) + 1)) AS i FROM best)"
)
ORACLE["part_clusters"] = (
    CLUSTERS
    + f"""SELECT l.part_no, l.part_name, l.quantity, l.frequency, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS cluster,
  l.part_no IN (SELECT part_no FROM crit) AS is_critical, coalesce(t.en, l.part_name) AS english_name
FROM labelled l LEFT JOIN {_translations()} ON l.part_name = t.part_name"""
)
# What must hold of any clustering, with the scores as the recursion gives them.
ORACLE["k_sweep_facts"] = CLUSTERS + (
    "SELECT k, silhouette BETWEEN -1 AND 1 AS score_holds, (SELECT count(*) FROM scores WHERE chosen) AS n_chosen FROM scores"
)

ORACLE["part_cluster_facts"] = (
    CLUSTER_BASE
    + f"""SELECT p.part_no, p.part_name, p.quantity, p.frequency, p.part_no IN (SELECT part_no FROM crit) AS is_critical,
  coalesce(t.en, p.part_name) AS english_name, true AS own_centre_nearest, true AS centre_is_mean
FROM pf p LEFT JOIN {_translations()} ON p.part_name = t.part_name"""
)

ORACLE["demand_pivot"] = (
    DEMAND_BASE
    + "SELECT part_no, "
    + ", ".join(
        f"coalesce(sum(qty) FILTER (WHERE strftime(month, '%Y-%m') = '{m}'), 0.0) AS \"{m}\"" for m in period_months(W.FULL_START, W.FULL_END)
    )
    + " FROM filled GROUP BY part_no"
)


# ---------------------------------------------------------------------------
# Raw text: the exports rebuilt as strings, then cleaned.
# ---------------------------------------------------------------------------


_MARKERS = "[" + ", ".join("'" + m.replace("'", "''") + "'" for m in S.NA_MARKERS) + "]"
_RAW_ADDR = (
    "printf('%02d', o.o_custkey % 100) || '.' || CAST(o.o_custkey AS VARCHAR) || '.' || CAST(o.o_custkey % 10 AS VARCHAR)"
)


def _p2(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 2, '0')"


def _render(d: str, key: str, shift: int) -> str:
    y = f"CAST(year({d}) AS VARCHAR)"
    m, dd = f"month({d})", f"day({d})"
    hh, mi, ss = _p2(f"{key} % 24"), _p2(f"{key} % 60"), _p2(f"({key} // 7) % 60")
    frac = f"lpad(CAST({key} % 1000000 AS VARCHAR), 6, '0')"
    ymd = lambda sep: f"{y} || '{sep}' || {_p2(m)} || '{sep}' || {_p2(dd)}"
    dmy = lambda sep: f"{_p2(dd)} || '{sep}' || {_p2(m)} || '{sep}' || {y}"
    k = f"(({key} + {shift}) % {_dt.DATE_RENDER_CYCLE})"
    cases = [
        dmy("-"),
        f"CAST({dd} AS VARCHAR) || '.' || CAST({m} AS VARCHAR) || '.' || {y}",
        dmy("/"),
        ymd("-"),
        ymd("."),
        ymd("/"),
        f"{ymd('-')} || ' ' || {hh} || ':' || {mi} || ':' || {ss} || '.' || {frac}",
        f"{ymd('-')} || ' ' || {hh} || ':' || {mi} || ':' || {ss}",
        f"{ymd('-')} || ' ' || {hh} || ':' || {mi}",
        f"{dmy('.')} || ' ' || {hh} || ':' || {mi}",
        f"{_p2(dd)} || '.' || {_p2(m)} || '.' || substr({y}, 3, 2)",
    ]
    whens = " ".join(f"WHEN {k} = {i} THEN {c}" for i, c in enumerate(cases))
    return f"CASE {whens} ELSE '31.02.' || {y} END"


def _raw_header() -> str:
    src = list(S.HEADER_SOURCE_COLUMNS)
    acc, dcols = [], [("CAST(o.o_orderdate AS DATE)", src[4])]
    for m, name in zip(_MODULI, src[5:]):
        acc.append(f"o.o_orderkey % {m}")
        dcols.append((f"CAST(o.o_orderdate AS DATE) + CAST({' + '.join(acc)} AS INTEGER)", name))
    dates_sql = ",\n    ".join(f"{_render(d, 'o.o_orderkey', j)} AS {name}" for j, (d, name) in enumerate(dcols))
    return f"""
rawk AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS serviceauftrag,
    CASE WHEN o.o_orderkey % {_dt.NA_EVERY} = 0 THEN {_MARKERS}[(o.o_orderkey // {_dt.NA_EVERY}) % {len(S.NA_MARKERS)} + 1]
      WHEN o.o_orderkey % {_dt.KEPT_TEXT_EVERY} = 0 THEN ' NA'
      WHEN o.o_custkey % {_dt.EXTRA_PART_EVERY} = 0 THEN {_RAW_ADDR} || '.7'
      ELSE {_RAW_ADDR} END AS adresse,
    'K0' || printf('%06d', o.o_custkey % 19) AS artikel,
    c.c_mktsegment AS typ,
    {dates_sql}
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""


RAW_POS = """
rawp AS (
  SELECT CAST(order_id AS VARCHAR) AS "SERVICEAUFTRAG", CAST("position" AS VARCHAR) AS "POSITION", part_no AS "ARTIKEL",
    part_name AS "NAME",
    CASE WHEN "position" = 7 THEN replace(CAST(quantity AS VARCHAR), '.', ',') || ',5'
      WHEN "position" = 6 THEN '1.' || replace(CAST(quantity AS VARCHAR), '.', ',')
      ELSE replace(CAST(quantity AS VARCHAR), '.', ',') END AS "MENGE"
  FROM pos
)"""

_DEC_RE = r"^\s*[+-]?([0-9]+([.,][0-9]*)?|[.,][0-9]+)\s*$"


def _parse(x: str) -> str:
    tries = []
    for fmt in S.DATE_FORMATS:
        _, regex = spark_pattern(fmt)
        tries.append(f"CASE WHEN regexp_full_match(trim({x}), '{regex}') THEN try_strptime(trim({x}), '{fmt}') END")
    return "coalesce(" + ", ".join(tries) + ")"


RAW_BASE = with_(VIEWS, _raw_header(), RAW_POS)
_STAGE_SRC = list(S.HEADER_SOURCE_COLUMNS)[4:]
_CHARS = [(";", "';'"), (",", "','"), ("\t", "chr(9)"), ("|", "'|'")]


def _profile() -> str:
    parts = []
    for i, (_, lit) in enumerate(_CHARS):
        n = f"(length(line) - length(replace(line, {lit}, '')))"
        parts.append(
            f"SELECT {lit} AS delimiter, {i} AS candidate_ord, CAST(count(*) AS BIGINT) AS lines, "
            f"CAST(min({n}) AS BIGINT) AS min_count, CAST(max({n}) AS BIGINT) AS max_count, "
            f"CAST(sum({n}) AS BIGINT) AS total_count FROM lines"
        )
    return "\n  UNION ALL ".join(parts)


ORACLE.update(
    {
        "address_split": RAW_BASE
        + """, a AS (SELECT serviceauftrag AS order_id, substr(adresse, 1, 2) || substr(adresse, 4) AS address_code FROM rawk)
SELECT order_id, address_code,
  CASE WHEN len(string_split(address_code, '.')) <= 2 THEN string_split(address_code, '.')[1] END AS customer_no,
  CASE WHEN len(string_split(address_code, '.')) <= 2 THEN string_split(address_code, '.')[2] END AS contact_no,
  len(string_split(address_code, '.')) <= 2 AS address_ok
FROM a""",
        "decimal_comma": RAW_BASE
        + f"""SELECT "SERVICEAUFTRAG" AS order_id, "POSITION" AS position, "ARTIKEL" AS part_no, "MENGE" AS quantity_raw,
  CASE WHEN regexp_full_match("MENGE", '{_DEC_RE}') THEN TRY_CAST(trim(replace("MENGE", ',', '.')) AS DOUBLE) END AS quantity
FROM rawp""",
        "quantity_quarantine": RAW_BASE
        + f"""SELECT "SERVICEAUFTRAG" AS order_id, CAST(TRY_CAST(trim("POSITION") AS INTEGER) AS INTEGER) AS position,
  "ARTIKEL" AS part_no, "MENGE" AS quantity_raw, 'bad_quantity' AS reject_reason
FROM rawp
WHERE "MENGE" NOT IN (SELECT unnest({_MARKERS})) AND "SERVICEAUFTRAG" NOT IN (SELECT unnest({_MARKERS}))
  AND "POSITION" NOT IN (SELECT unnest({_MARKERS})) AND "ARTIKEL" NOT IN (SELECT unnest({_MARKERS}))
  AND "NAME" NOT IN (SELECT unnest({_MARKERS}))
  AND (CASE WHEN regexp_full_match("MENGE", '{_DEC_RE}') THEN TRY_CAST(trim(replace("MENGE", ',', '.')) AS DOUBLE) END) IS NULL""",
        "parse_dates": RAW_BASE
        + "SELECT order_id, stage, raw, "
        + _parse("raw")
        + " AS parsed FROM (\n"
        + "\n  UNION ALL ".join(f"SELECT serviceauftrag AS order_id, '{c}' AS stage, {c} AS raw FROM rawk" for c in _STAGE_SRC)
        + "\n)",
        "na_drop": RAW_BASE
        + f"""SELECT serviceauftrag AS order_id, substr(adresse, 1, 2) || substr(adresse, 4) AS address_code, typ AS product_type,
  {_parse('datum_waein')} AS d_goods_in, {_parse('datum_wausgang')} AS d_goods_out
FROM rawk
WHERE {" AND ".join(f"{c} NOT IN (SELECT unnest({_MARKERS}))" for c in S.HEADER_SOURCE_COLUMNS)}""",
        "delimiter_profile": RAW_BASE
        + f""", lines AS (
  SELECT concat_ws(';', "SERVICEAUFTRAG", "POSITION", "ARTIKEL", "NAME", "MENGE") AS line FROM rawp
),
prof AS (
  {_profile()}
),
best AS (
  SELECT delimiter FROM (SELECT *, (min_count = max_count AND min_count > 0) AS consistent FROM prof)
  ORDER BY consistent DESC, max_count DESC, total_count DESC, candidate_ord LIMIT 1
)
SELECT p.delimiter, p.candidate_ord, p.lines, p.min_count, p.max_count, p.total_count,
  (p.min_count = p.max_count AND p.min_count > 0) AS consistent, p.delimiter IN (SELECT delimiter FROM best) AS chosen
FROM prof p""",
        "coverage_check": with_(VIEWS, PARTS)
        + f"""SELECT product_type, {START} AS start_date, {END} AS end_date, min(d_goods_out) AS min_date, max(d_goods_out) AS max_date,
  min(d_goods_out) <= {START} AS start_covered, max(d_goods_out) >= {END} AS end_covered
FROM parts GROUP BY product_type""",
    }
)


def _not_marker(cols) -> str:
    return " AND ".join(f"{c} NOT IN (SELECT unnest({_MARKERS}))" for c in cols)


_QTY = f"""CASE WHEN regexp_full_match("MENGE", '{_DEC_RE}') THEN TRY_CAST(trim(replace("MENGE", ',', '.')) AS DOUBLE) END"""

ORACLE["ingested_parts"] = (
    RAW_BASE
    + f""", hk AS (
  SELECT serviceauftrag AS order_id, artikel AS product_article, typ AS product_type,
    {_parse('datum_wausgang')} AS d_goods_out
  FROM rawk WHERE {_not_marker(S.HEADER_SOURCE_COLUMNS)}
),
pk AS (
  SELECT "SERVICEAUFTRAG" AS order_id, TRY_CAST(trim("POSITION") AS INTEGER) AS "position", "ARTIKEL" AS part_no,
    {_QTY} AS quantity
  FROM rawp
  WHERE {_not_marker(['"' + c + '"' for c in S.POSITION_SOURCE_COLUMNS])} AND {_QTY} IS NOT NULL
),
mk AS (SELECT * FROM hk JOIN pk USING (order_id) WHERE part_no LIKE 'K0%')
SELECT order_id, "position" AS position, part_no, quantity, product_type, d_goods_out
FROM mk WHERE NOT EXISTS (SELECT 1 FROM mk m2 WHERE m2.product_article = mk.part_no)"""
)

ORACLE["process_analysis_by_type"] = (
    BASE[:-1]
    + ","
    + SEL_ALL.strip("\n")
    + f""",
po AS (SELECT DISTINCT order_id, product_type, labour_units FROM sel),
sc AS (
  SELECT product_type, CAST(count(*) AS BIGINT) AS n_orders,
    CAST(coalesce(sum(labour_units), 0) AS DOUBLE) AS total_labour_units
  FROM po GROUP BY product_type
),
period AS (SELECT 0 AS pid, {START} AS a, {END} AS b),
{brute_force_wd('period', 'period_n')},
pp0 AS (
  SELECT product_type, part_no, first(part_name ORDER BY order_id, "position") AS part_name,
    CAST(sum(quantity) AS DOUBLE) AS total_part_qty, min(order_id) AS first_order
  FROM sel GROUP BY product_type, part_no
),
pp AS (
  SELECT pp0.*, CAST(row_number() OVER (ORDER BY product_type, first_order, first_pos, part_no) AS BIGINT) AS part_seq
  FROM pp0 JOIN (
    SELECT s.product_type, s.part_no, min(s."position") AS first_pos FROM sel s JOIN pp0 p
      ON s.product_type = p.product_type AND s.part_no = p.part_no AND s.order_id = p.first_order
    GROUP BY s.product_type, s.part_no
  ) fp USING (product_type, part_no)
)
SELECT {START} AS start_date, {END} AS end_date, pp.product_type, sc.n_orders, sc.total_labour_units,
  sc.total_labour_units / CAST(sc.n_orders AS DOUBLE) AS labour_units_per_order,
  CAST(coalesce((SELECT n FROM period_n), 0) AS DOUBLE) / CAST(sc.n_orders AS DOUBLE) AS order_cycle,
  pp.part_seq, pp.part_no, pp.part_name, pp.total_part_qty,
  pp.total_part_qty / CAST(sc.n_orders AS DOUBLE) AS part_qty_per_order
FROM pp JOIN sc USING (product_type)"""
)

ORACLE["key_figures_by_type"] = (
    "WITH k AS (SELECT DISTINCT product_type, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _KEY_FIGURES)
    + " FROM (\n"
    + ORACLE["process_analysis_by_type"]
    + "\n) p)\n"
    + "\nUNION ALL ".join(
        f"SELECT product_type, '{c}' AS figure, {c} AS value, {i} AS figure_ord FROM k"
        for i, c in enumerate(_KEY_FIGURES)
    )
)

ORACLE["part_ranking_by_type"] = (
    "SELECT product_type, part_no, part_name, total_part_qty,\n"
    "  CAST(row_number() OVER (ORDER BY total_part_qty DESC, product_type, part_no) AS BIGINT) AS rank\nFROM (\n"
    + ORACLE["process_analysis_by_type"]
    + "\n) p"
)

ORACLE["coverage_total"] = with_(VIEWS, PARTS) + f"""SELECT {START} AS start_date, {END} AS end_date,
  min(d_goods_out) AS min_date, max(d_goods_out) AS max_date,
  min(d_goods_out) <= {START} AS start_covered, max(d_goods_out) >= {END} AS end_covered
FROM parts"""

_STAGE_BARS = "\n  UNION ALL ".join(
    f"SELECT product_type, {i} AS stage_ord, '{c}' AS stage, {c}_avg AS days FROM times"
    for i, c in enumerate(S.STAGE_DURATIONS)
)

ORACLE["time_stage_bars"] = (
    BASE[:-1]
    + ","
    + SEL_ALL.strip("\n")
    + ","
    + TIME_BY_TYPE.strip("\n")
    + f""",
bars AS (
  {_STAGE_BARS}
)
SELECT product_type, stage_ord, stage, days,
  coalesce(sum(days) OVER (PARTITION BY product_type ORDER BY stage_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS bar_start
FROM bars"""
)

ORACLE["translated_names"] = (
    CLUSTER_BASE
    + """SELECT p.part_name, p.part_no, p.quantity, p.frequency, coalesce(t.en, p.part_name) AS english_name
FROM pf p LEFT JOIN (VALUES ('red plate', 'Plate, red'), ('small widget', 'Widget, small'), ('hot ring', 'Ring, hot'),
  ('large rod', 'Rod, large'), ('blue ring', 'Ring, blue'), ('hot bolt', 'Bolt, hot')) AS t(name, en) ON t.name = p.part_name"""
)

_MATRIX = ("K0000003", "K0000004", "K0000010", "K0000011", "K0000077", "K0000150", "K0000199", "K0999999")

ORACLE["demand_matrix"] = (
    DEMAND_BASE[:-1]
    + ", mx AS (SELECT * FROM mon WHERE part_no IN ("
    + ", ".join(f"'{p}'" for p in _MATRIX)
    + ")),\nmm AS (SELECT CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM mx)\n"
    + "SELECT strftime(mm.month, '%Y-%m') AS month, "
    + ", ".join(f"coalesce(sum(qty) FILTER (WHERE part_no = '{p}'), 0.0) AS {p}" for p in _MATRIX)
    + " FROM mm LEFT JOIN mx ON mm.month = mx.month GROUP BY mm.month"
)

# Cells without a line break and markers survive the CSV round trip unchanged.
ORACLE["csv_round_trip"] = ORACLE["decimal_comma"].rsplit("SELECT \"SERVICEAUFTRAG\" AS order_id", 1)[0] + """, q AS (
  SELECT "SERVICEAUFTRAG" AS order_id, CAST("POSITION" AS BIGINT) AS position, "ARTIKEL" AS part_no,
    TRY_CAST(replace("MENGE", ',', '.') AS DOUBLE) AS quantity FROM rawp
)
SELECT order_id, position, part_no, round_even(quantity / 8, 2) AS eighth FROM q WHERE quantity IS NOT NULL"""
