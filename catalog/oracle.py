"""For each query the ANSI SQL it must equal, for DuckDB over the same tables."""

from __future__ import annotations

from catalog import deliveries as d
from catalog.queries import LATE, NEVER
from tidemark.contract import SOURCES

ORACLE: dict[str, str] = {}


def _values(rows: list[tuple]) -> str:
    def lit(v) -> str:
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))

    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


CONTROL = f"""
vm(tenant_id, source, column_name, raw_value, canonical_value) AS ({_values(d.VALUE_MAP)}),
tenant(tenant_id, currency) AS ({_values([(t, c) for t, _, c in d.TENANTS])})"""

_O = """'t' || (o_orderkey % 2) AS tenant_id, {batch} AS batch_no, o_orderkey + 2 AS line_no,
  'o-' || o_orderkey AS order_id, {created} AS created_at,
  nullif(trim(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  ' ELSE o_orderpriority END, ' '), '') AS raw_channel,
  {gross} AS gross, 'USD' AS currency, 'c' || o_custkey || '@example.invalid' AS customer_email"""

# The delivered lines of each source as text, before typing; {ok} keeps the files a ledger counts as loaded.
LINES = {
    "orders": "SELECT " + _O.format(
        batch="year(o_orderdate) - 1994",
        created="""CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' AND o_totalprice::DECIMAL(18,2) > 400000
                   THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END""",
        gross="""CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'pending'
                 ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END""",
    ) + " FROM orders UNION ALL SELECT " + _O.format(
        batch="8",
        created="""strftime(o_orderdate + (CASE WHEN o_orderpriority = '2-HIGH' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END),
                   '%Y-%m-%d') || 'T00:00:00Z'""",
        gross="(o_totalprice::DECIMAL(18,2) - 100.00::DECIMAL(18,2))::VARCHAR",
    ) + " FROM orders WHERE o_orderstatus = 'P'",
    "ad_spend": """SELECT 't' || (l_orderkey % 2) AS tenant_id, year(l_shipdate) - 1994 AS batch_no,
  l_orderkey * 10 + l_linenumber AS line_no, strftime(l_shipdate, '%Y-%m-%d') AS date, 'c-' || l_suppkey AS campaign_id,
  l_returnflag AS raw_platform,
  CASE WHEN l_tax::DECIMAL(4,2) = 0 AND l_quantity = 1 THEN 'n/a'
       ELSE (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2))::VARCHAR END AS spend FROM lineitem""",
    "refunds": """SELECT 't' || (l_orderkey % 2) AS tenant_id, year(l_shipdate) - 1994 AS batch_no,
  (l_orderkey * 10 + l_linenumber) * 100000000 + l_partkey AS line_no, 'r-' || l_orderkey || '-' || l_linenumber AS refund_id,
  strftime(l_shipdate, '%Y-%m-%d') AS refunded_at,
  CASE WHEN l_discount::DECIMAL(4,2) = 0 THEN NULL WHEN l_discount::DECIMAL(4,2) >= 0.10 THEN 'x-' || l_orderkey
       ELSE 'o-' || l_orderkey END AS order_id,
  (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::VARCHAR AS amount, 'USD' AS currency
  FROM lineitem WHERE l_returnflag = 'R'""",
    "email_events": """SELECT 't' || (user_id % 2) AS tenant_id, (day(ts) - 1) // 6 + 1 AS batch_no, event_id + 1 AS line_no,
  'e-' || event_id AS event_id, event_type AS raw_type, 'u' || user_id || '@example.invalid' AS email,
  'k-' || json_extract_string(props, '$.k') AS campaign_id, ts::VARCHAR AS occurred_at FROM events""",
}
MAPPED = {"orders": "channel", "ad_spend": "platform", "email_events": "type", "refunds": None}


def text(p: str, source: str, ok: str) -> str:
    """CTE {p}_{source}_text: the loaded lines with file ids and the mapped column."""
    i = SOURCES.index(source)
    column = MAPPED[source]
    mapped = f", coalesce(vm.canonical_value, l.raw_{column}) AS {column}" if column else ""
    join = (f" LEFT JOIN vm ON vm.tenant_id = l.tenant_id AND vm.source = '{source}' AND vm.column_name = '{column}'"
            f" AND vm.raw_value = l.raw_{column}") if column else ""
    return f"""{p}_{source}_text AS (SELECT l.*, '{source}' AS source,
  (1000 * (substr(l.tenant_id, 2, 1)::INT + 1) + {100 * i} + l.batch_no)::BIGINT AS batch_file_id{mapped}
  FROM ({LINES[source]}) l{join} WHERE {ok.format(s=source)})"""


NUM = "TRY_CAST({0} AS DECIMAL(18,6))"
TS = "CASE WHEN regexp_matches({0}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}([ T]|$)') THEN TRY_CAST(replace({0}, 'Z', '') AS TIMESTAMP) END"
DAY = "CASE WHEN regexp_matches({0}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN TRY_CAST({0} AS DATE) END"
LATEST = "QUALIFY row_number() OVER (PARTITION BY tenant_id, {0} ORDER BY batch_no DESC, line_no DESC) = 1"
KEPT = "batch_file_id, batch_no::INT AS batch_no, line_no::BIGINT AS line_no"


def staging_cte(p: str, ok: str = "TRUE") -> str:
    parts = [text(p, s, ok) for s in SOURCES]
    parts.append(f"""{p}_orders AS (SELECT tenant_id, order_id, {TS.format('created_at')} AS created_ts,
  ({TS.format('created_at')})::DATE AS order_date, channel, {NUM.format('gross')} AS gross,
  currency AS reported_currency, customer_email, {KEPT} FROM {p}_orders_text {LATEST.format('order_id')})""")
    parts.append(f"""{p}_email_events AS (SELECT tenant_id, event_id, type AS event_type, email, campaign_id,
  {TS.format('occurred_at')} AS occurred_ts, ({TS.format('occurred_at')})::DATE AS event_date, {KEPT}
  FROM {p}_email_events_text {LATEST.format('event_id')})""")
    parts.append(f"""{p}_ad_spend AS (SELECT tenant_id, {DAY.format('date')} AS spend_date, campaign_id, platform,
  {NUM.format('spend')} AS spend, {KEPT} FROM {p}_ad_spend_text {LATEST.format('date, campaign_id, platform')})""")
    parts.append(f"""{p}_refunds AS (SELECT r.tenant_id, refund_id, {TS.format('refunded_at')} AS refunded_ts,
  ({TS.format('refunded_at')})::DATE AS refund_date, order_id, {NUM.format('amount')} AS amount,
  currency AS reported_currency,
  NOT EXISTS (SELECT 1 FROM {p}_orders o WHERE o.tenant_id = r.tenant_id AND o.order_id = r.order_id) AS is_orphan,
  {KEPT} FROM (SELECT * FROM {p}_refunds_text {LATEST.format('refund_id')}) r)""")
    return ",\n".join(parts)


def marts_cte(p: str) -> str:
    roas = """CASE WHEN s.spend <> 0 THEN
   (((coalesce(r.revenue, 0) * 1000000)::HUGEINT * 20000 + (s.spend * 1000000)::HUGEINT)
    // (2 * (s.spend * 1000000)::HUGEINT))::DECIMAL(20,0) * 0.0001::DECIMAL(5,4) END"""
    return f"""{p}_daily_revenue AS (
  SELECT tenant_id, day, currency, coalesce(orders, 0)::INT AS orders, coalesce(gross, 0)::DECIMAL(28,6) AS gross,
    coalesce(refunds, 0)::DECIMAL(28,6) AS refunds, (coalesce(gross, 0) - coalesce(refunds, 0))::DECIMAL(28,6) AS net,
    coalesce(orphan_refund_count, 0)::INT AS orphan_refund_count,
    coalesce(orphan_refund_amount, 0)::DECIMAL(28,6) AS orphan_refund_amount
  FROM (SELECT tenant_id, order_date AS day, count(gross) AS orders, sum(gross) AS gross FROM {p}_orders
        WHERE order_date IS NOT NULL GROUP BY ALL) o
  FULL JOIN (SELECT tenant_id, refund_date AS day, sum(amount) FILTER (WHERE NOT is_orphan) AS refunds,
        count(*) FILTER (WHERE is_orphan) AS orphan_refund_count,
        sum(amount) FILTER (WHERE is_orphan) AS orphan_refund_amount FROM {p}_refunds
        WHERE refund_date IS NOT NULL GROUP BY ALL) r USING (tenant_id, day)
  JOIN tenant USING (tenant_id)),
{p}_daily_ad_spend AS (SELECT tenant_id, spend_date AS day, platform, currency, sum(spend)::DECIMAL(28,6) AS spend
  FROM {p}_ad_spend JOIN tenant USING (tenant_id) GROUP BY ALL),
{p}_daily_email_engagement AS (SELECT tenant_id, event_date AS day,
    (count(*) FILTER (WHERE event_type = 'delivered'))::INT AS delivered,
    (count(*) FILTER (WHERE event_type = 'open'))::INT AS opens,
    (count(*) FILTER (WHERE event_type = 'click'))::INT AS clicks,
    (count(*) FILTER (WHERE event_type = 'unsubscribe'))::INT AS unsubscribes
  FROM {p}_email_events WHERE event_date IS NOT NULL GROUP BY tenant_id, event_date),
{p}_daily_channel_performance AS (
  SELECT tenant_id, day, channel, currency, coalesce(r.revenue, 0)::DECIMAL(28,6) AS revenue,
    coalesce(s.spend, 0)::DECIMAL(28,6) AS spend, {roas} AS roas
  FROM (SELECT tenant_id, order_date AS day, channel, sum(gross)::DECIMAL(28,6) AS revenue FROM {p}_orders
        WHERE order_date IS NOT NULL AND channel IS NOT NULL GROUP BY ALL) r
  FULL JOIN (SELECT tenant_id, spend_date AS day, platform AS channel, sum(spend)::DECIMAL(28,6) AS spend
        FROM {p}_ad_spend GROUP BY ALL) s USING (tenant_id, day, channel)
  JOIN tenant USING (tenant_id))"""


def _json(pairs: list[tuple[str, str]]) -> str:
    if not pairs:
        return "'{}'"
    each = [f"""'"{n}":' || CASE WHEN {e} IS NULL THEN 'null' ELSE '"' || ({e})::VARCHAR || '"' END""" for n, e in pairs]
    return "'{' || " + " || ',' || ".join(each) + " || '}'"


METRICS = {
    "daily_revenue": ([], ["orders", "gross", "refunds", "net", "orphan_refund_count", "orphan_refund_amount"]),
    "daily_ad_spend": (["platform"], ["spend"]),
    "daily_email_engagement": ([], ["delivered", "opens", "clicks", "unsubscribes"]),
    "daily_channel_performance": (["channel"], ["revenue", "spend", "roas"]),
}


def keys_cte(p: str) -> str:
    selects = [
        f"SELECT tenant_id, '{m}' AS mart, day, {_json([(c, c) for c in dims])} AS dims, "
        f"{_json([(c, c) for c in metrics])} AS metrics FROM {p}_{m}"
        for m, (dims, metrics) in METRICS.items()
    ]
    return f"{p}_keys AS ({' UNION ALL '.join(selects)})"


FEEDS = [
    ("daily_revenue", "orders", "order_date", None), ("daily_revenue", "refunds", "refund_date", None),
    ("daily_ad_spend", "ad_spend", "spend_date", ("platform", "platform")),
    ("daily_email_engagement", "email_events", "event_date", None),
    ("daily_channel_performance", "orders", "order_date", ("channel", "channel")),
    ("daily_channel_performance", "ad_spend", "spend_date", ("channel", "platform")),
]


def lineage_cte(p: str) -> str:
    selects = [
        f"SELECT tenant_id, '{m}' AS mart, {day} AS day, {_json([dim] if dim else [])} AS dims, batch_file_id "
        f"FROM {p}_{s} WHERE {day} IS NOT NULL"
        for m, s, day, dim in FEEDS
    ]
    return f"{p}_lineage AS ({' UNION '.join(selects)})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([CONTROL.strip(), *ctes]) + "\n"


ALL = staging_cte("a")
LINEAGE = "batch_file_id, batch_no, line_no"

ORACLE["staging_orders"] = _with(ALL) + f"""SELECT tenant_id, order_id, epoch_us(created_ts) AS created_at, order_date,
  channel, gross::DOUBLE AS gross, reported_currency, customer_email, {LINEAGE} FROM a_orders"""
ORACLE["staging_email_events"] = _with(ALL) + f"""SELECT tenant_id, event_id, event_type, email, campaign_id,
  epoch_us(occurred_ts) AS occurred_at, event_date, {LINEAGE} FROM a_email_events"""
ORACLE["staging_ad_spend"] = _with(ALL) + f"""SELECT tenant_id, spend_date, campaign_id, platform, spend::DOUBLE AS spend,
  {LINEAGE} FROM a_ad_spend"""
ORACLE["staging_refunds"] = _with(ALL) + f"""SELECT tenant_id, refund_id, epoch_us(refunded_ts) AS refunded_at, refund_date,
  order_id, amount::DOUBLE AS amount, reported_currency, is_orphan, {LINEAGE} FROM a_refunds"""

MARTS_ALL = _with(ALL, marts_cte("a"))
ORACLE["daily_revenue"] = MARTS_ALL + """SELECT tenant_id, day, currency, orders, gross::DOUBLE AS gross,
  refunds::DOUBLE AS refunds, net::DOUBLE AS net, orphan_refund_count,
  orphan_refund_amount::DOUBLE AS orphan_refund_amount FROM a_daily_revenue"""
ORACLE["daily_ad_spend"] = MARTS_ALL + """SELECT tenant_id, day, platform, currency, spend::DOUBLE AS spend
  FROM a_daily_ad_spend"""
ORACLE["daily_email_engagement"] = MARTS_ALL + "SELECT * FROM a_daily_email_engagement"
ORACLE["daily_channel_performance"] = MARTS_ALL + """SELECT tenant_id, day, channel, currency, revenue::DOUBLE AS revenue,
  spend::DOUBLE AS spend, roas::DOUBLE AS roas FROM a_daily_channel_performance"""
ORACLE["reconciliation"] = MARTS_ALL + """SELECT tenant_id, day, m.gross::DOUBLE AS gross,
  t.gross::DOUBLE AS gross_reported, (coalesce(m.gross, 0) - coalesce(t.gross, 0))::DOUBLE AS difference
  FROM a_daily_revenue m FULL JOIN (SELECT 't' || (o_orderkey % 2) AS tenant_id, o_orderdate::DATE AS day,
    sum(o_totalprice::DECIMAL(18,2)) AS gross FROM orders GROUP BY ALL) t USING (tenant_id, day)
  WHERE m.gross IS DISTINCT FROM t.gross"""

_NUM_BAD, _TS_BAD, _DAY_BAD = (f"({f.format('v')}) IS NULL" for f in (NUM, TS, DAY))
REQUIRED = [
    ("orders", "order_id", "order_id", "text", None), ("orders", "created_at", "created_at", "timestamptz", _TS_BAD),
    ("orders", "channel", "raw_channel", "text", None), ("orders", "gross", "gross", "numeric", _NUM_BAD),
    ("email_events", "event_id", "event_id", "text", None), ("email_events", "type", "raw_type", "text", None),
    ("email_events", "occurred_at", "occurred_at", "timestamptz", _TS_BAD),
    ("ad_spend", "date", "date", "date", _DAY_BAD), ("ad_spend", "campaign_id", "campaign_id", "text", None),
    ("ad_spend", "platform", "raw_platform", "text", None), ("ad_spend", "spend", "spend", "numeric", _NUM_BAD),
    ("refunds", "refund_id", "refund_id", "text", None), ("refunds", "refunded_at", "refunded_at", "timestamptz", _TS_BAD),
    ("refunds", "order_id", "order_id", "text", None), ("refunds", "amount", "amount", "numeric", _NUM_BAD),
]


def invalid_cte() -> str:
    selects = [
        f"""SELECT tenant_id, source, batch_file_id, batch_no::INT AS batch_no, line_no::BIGINT AS line_no,
  '{c}' AS column_name, v AS raw_value, CASE WHEN v IS NULL THEN 'missing' ELSE 'invalid {k}' END AS problem
  FROM (SELECT *, {e} AS v FROM a_{s}_text) WHERE v IS NULL{' OR ' + bad if bad else ''}"""
        for s, c, e, k, bad in REQUIRED
    ]
    kept = " UNION ALL ".join(f"SELECT '{s}' AS source, tenant_id, batch_file_id, line_no FROM a_{s}" for s in SOURCES)
    return f"""inv AS ({' UNION ALL '.join(selects)}), kept AS ({kept}),
live AS (SELECT source, tenant_id, batch_file_id, line_no FROM kept UNION
  SELECT source, tenant_id, batch_file_id, line_no FROM inv WHERE source || '.' || column_name IN ('orders.order_id',
    'email_events.event_id', 'ad_spend.date', 'ad_spend.campaign_id', 'ad_spend.platform', 'refunds.refund_id')),
cur AS (SELECT inv.* FROM inv SEMI JOIN live USING (source, tenant_id, batch_file_id, line_no))"""


QUALITY = _with(ALL, invalid_cte())
ORACLE["invalid_rows"] = QUALITY + "SELECT * FROM inv"
ORACLE["current_invalid_rows"] = QUALITY + "SELECT * FROM cur"
ORACLE["superseded_invalid_rows"] = QUALITY + """SELECT tenant_id, source, column_name, count(*) AS rows
  FROM (SELECT * FROM inv EXCEPT ALL SELECT * FROM cur) GROUP BY ALL"""
ORACLE["invalid_row_findings"] = QUALITY + """SELECT tenant_id, source, column_name, count(*) AS rows,
  (array_agg(batch_no ORDER BY batch_no, line_no))[1] AS first_batch,
  (array_agg(line_no ORDER BY batch_no, line_no))[1] AS first_line FROM cur GROUP BY tenant_id, source, column_name"""
ORACLE["uncounted_values"] = _with(ALL) + """SELECT tenant_id, 'email_events' AS source, 'type' AS column_name,
  event_type AS value, count(*) AS rows FROM a_email_events
  WHERE event_type NOT IN ('delivered', 'open', 'click', 'unsubscribe') GROUP BY ALL"""

FIRST_OK = "NOT ((" + ") OR (".join(f"'{{s}}' = '{s}' AND batch_no = {b}" for s, b in LATE) + "))"
SECOND_OK = "NOT ((" + ") OR (".join(
    f"l.tenant_id = '{t}' AND '{{s}}' = '{s}' AND batch_no = {b}" for t, s, b in NEVER) + "))"
_WINDOWS = [(t, s, b, d.path(t, s, b), *d.window(s, b), st) for (t, s, b), st in NEVER.items()]
WINDOWS = f"""w(tenant_id, source, batch_no, path, covers_from, covers_to, status) AS ({_values(_WINDOWS)}),
feed(mart, source) AS ({_values([(m, s) for m, s, _, _ in FEEDS])}),
mw AS (SELECT w.*, mart FROM w JOIN feed USING (source))"""
IN_WINDOW = """mw.tenant_id = k.tenant_id AND mw.mart = k.mart AND k.day BETWEEN mw.covers_from::DATE AND mw.covers_to::DATE"""
CLASSIFIED = f"""done AS (SELECT * FROM (SELECT k.*, CASE
    WHEN NOT is_now AND before IS NULL THEN NULL
    WHEN EXISTS (SELECT 1 FROM mw WHERE {IN_WINDOW}) THEN 'withheld'
    WHEN NOT is_was THEN 'new' WHEN NOT is_now THEN 'tombstone' WHEN before = after THEN 'unchanged'
    ELSE 'restated' END AS action
  FROM (SELECT tenant_id, mart, day, dims, f.metrics AS before, s.metrics AS after, f.tenant_id IS NOT NULL AS is_was,
        s.tenant_id IS NOT NULL AS is_now FROM f_keys f FULL JOIN s_keys s USING (tenant_id, mart, day, dims)) k)
  WHERE action IS NOT NULL)"""
RUNS = _with(
    staging_cte("f", FIRST_OK), marts_cte("f"), keys_cte("f"), staging_cte("s", SECOND_OK), marts_cte("s"), keys_cte("s"),
    WINDOWS, CLASSIFIED)

ORACLE["incomplete_windows"] = RUNS + f"""SELECT mw.tenant_id, mw.mart, source, batch_no, path, covers_from, covers_to,
  status, count(k.day) AS keys FROM mw LEFT JOIN s_keys k ON {IN_WINDOW} GROUP BY ALL"""
ORACLE["publish_versions"] = RUNS + """SELECT tenant_id, mart, day, dims, (CASE WHEN is_was THEN 2 ELSE 1 END)::INT AS version,
  after AS metrics FROM done WHERE action IN ('new', 'restated', 'tombstone')"""
for _name, _action in (("restatements", "restated"), ("tombstones", "tombstone")):
    ORACLE[_name] = RUNS + f"""SELECT tenant_id, mart, day, dims, 1::INT AS from_version, 2::INT AS to_version, before, after
  FROM done WHERE action = '{_action}'"""
ORACLE["withheld_keys"] = RUNS + f"""SELECT mw.tenant_id, mw.mart, source, batch_no, path, covers_from, covers_to, status,
  k.day AS day, k.dims AS dims FROM mw LEFT JOIN (SELECT * FROM done WHERE action = 'withheld') k ON {IN_WINDOW}"""
ORACLE["publish_summary"] = RUNS + """SELECT tenant_id,
  count(*) FILTER (WHERE action IN ('new', 'restated', 'tombstone')) AS published,
  count(*) FILTER (WHERE action IN ('restated', 'tombstone')) AS restated,
  count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'withheld') AS withheld
  FROM done GROUP BY tenant_id"""
_FILES = [
    (t, d.file_id(t, s, b), s, (s, b) not in LATE, (t, s, b) not in NEVER)
    for t, _, _ in d.TENANTS for s in SOURCES for b in range(1, d.BATCHES[s] + 1)
]
ORACLE["caused_by"] = RUNS.rstrip() + f""",
{lineage_cte('s')},
file(tenant_id, batch_file_id, source, seen, loaded) AS ({_values(_FILES)}),
chg AS (SELECT * FROM done WHERE action IN ('restated', 'tombstone')),
direct AS (SELECT c.tenant_id, c.mart, c.day, c.dims, string_agg(l.batch_file_id::VARCHAR, ',' ORDER BY l.batch_file_id) AS ids
  FROM chg c JOIN s_lineage l USING (tenant_id, mart, day, dims)
  JOIN file ON file.tenant_id = c.tenant_id AND file.batch_file_id = l.batch_file_id AND NOT file.seen GROUP BY ALL),
since AS (SELECT tenant_id, mart, string_agg(batch_file_id::VARCHAR, ',' ORDER BY batch_file_id) AS ids
  FROM file JOIN feed USING (source) WHERE loaded AND NOT seen GROUP BY ALL)
SELECT c.tenant_id, c.mart, c.day, c.dims, 2::INT AS to_version, coalesce(direct.ids, since.ids, '') AS caused_by
FROM chg c LEFT JOIN direct USING (tenant_id, mart, day, dims) LEFT JOIN since USING (tenant_id, mart)"""
ORACLE["reported_metric"] = RUNS + """SELECT tenant_id, mart, day, dims,
  (CASE WHEN action = 'restated' THEN 2 ELSE 1 END)::INT AS version,
  CASE WHEN action IN ('new', 'restated') THEN after ELSE before END AS metrics,
  (CASE WHEN action IN ('new', 'restated') THEN 2 ELSE 1 END)::BIGINT AS run_id
  FROM done WHERE action IN ('new', 'restated', 'unchanged') OR (action = 'withheld' AND is_was)"""
ORACLE["lineage"] = _with(ALL, lineage_cte("a")) + "SELECT * FROM a_lineage"
ORACLE["published_incomplete"] = RUNS + f"""SELECT mw.tenant_id, mw.mart, source, batch_no, status, count(*) AS keys,
  min(k.day) AS first_day, max(k.day) AS last_day FROM mw JOIN f_keys k ON {IN_WINDOW} GROUP BY ALL"""

TALLY = _with(ALL).rstrip() + """, tally AS (
  SELECT tenant_id, 'orders' AS source, 'channel' AS column_name, raw_channel AS raw_value, channel AS value, count(*) AS rows
    FROM a_orders_text WHERE raw_channel IS NOT NULL GROUP BY ALL
  UNION ALL SELECT tenant_id, 'email_events', 'type', raw_type, type, count(*) FROM a_email_events_text GROUP BY ALL
  UNION ALL SELECT tenant_id, 'ad_spend', 'platform', raw_platform, platform, count(*) FROM a_ad_spend_text GROUP BY ALL)
"""
ORACLE["value_tally"] = TALLY + "SELECT * FROM tally"
ORACLE["unmapped_values"] = TALLY + """SELECT * FROM tally t WHERE column_name <> 'type'
  AND EXISTS (SELECT 1 FROM vm WHERE vm.tenant_id = t.tenant_id AND vm.source = t.source AND vm.column_name = t.column_name)
  AND NOT EXISTS (SELECT 1 FROM vm WHERE vm.tenant_id = t.tenant_id AND vm.source = t.source AND vm.column_name = t.column_name
    AND (vm.raw_value = t.raw_value OR vm.canonical_value = t.raw_value))"""
ORACLE["channel_mismatch"] = TALLY.rstrip() + """, r AS (SELECT DISTINCT tenant_id, value FROM tally WHERE source = 'orders'),
 s AS (SELECT DISTINCT tenant_id, value FROM tally WHERE source = 'ad_spend')
 SELECT *, 'revenue' AS side FROM (SELECT * FROM r EXCEPT SELECT * FROM s)
 UNION ALL SELECT *, 'spend' AS side FROM (SELECT * FROM s EXCEPT SELECT * FROM r)"""
ORACLE["near_misses"] = r"""WITH h AS (SELECT DISTINCT regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
    regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages),
  s AS (SELECT host FROM h WHERE scheme = 'https'), p AS (SELECT host FROM h WHERE scheme = 'http' AND host NOT IN (SELECT host FROM s))
  SELECT p.host AS name, s.host AS candidate, levenshtein(p.host, s.host)::INT AS distance FROM p, s
  WHERE p.host <> s.host AND (levenshtein(p.host, s.host) <= 2 OR lower(p.host) = lower(s.host))"""
ORACLE["missing_files"] = """SELECT p_partkey, p_name FROM part
  WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount::DECIMAL(4,2) = 0.10)"""

YEARS = """WITH y AS (SELECT 'c' || o_custkey AS tenant_id, 'orders' AS source, (year(o_orderdate) - 1994)::INT AS batch_no,
  o_orderkey, o_orderstatus FROM orders)"""

def _ranges(source: str, keys: str) -> str:
    return f"""i AS (SELECT {keys}, batch_no, batch_no - row_number() OVER (PARTITION BY {keys} ORDER BY batch_no) AS g
    FROM (SELECT DISTINCT {keys}, batch_no FROM {source})),
  runs AS (SELECT {keys}, g, min(batch_no) AS lo, max(batch_no) AS hi, count(*) AS n FROM i GROUP BY ALL),
  ranges AS (SELECT {keys}, CASE WHEN sum(n) = 1 THEN 'batch ' ELSE 'batches ' END || string_agg(
    CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ', ' ORDER BY lo) AS batches FROM runs GROUP BY {keys})"""


ORACLE["batch_ranges"] = YEARS + ", " + _ranges("y", "tenant_id, source") + " SELECT * FROM ranges"
ORACLE["batch_gap"] = YEARS + """, m AS (SELECT tenant_id, source, max(batch_no) AS top FROM y GROUP BY ALL),
  n AS (SELECT tenant_id, source, unnest(range(1, top))::INT AS missing FROM m)
  SELECT n.* FROM n ANTI JOIN y ON y.tenant_id = n.tenant_id AND y.batch_no = n.missing"""
LEDGER = YEARS + """,
 l AS (SELECT *, o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'batch_conflict' WHEN 'P' THEN 'unknown_header,missing_column' END
   AS codes FROM y),
 m AS (SELECT tenant_id, source, b::INT AS batch_no, tenant_id || '/' || (1994 + b) AS path, (1994 + b) || '-12-31' AS covers_to
   FROM (SELECT DISTINCT tenant_id, source FROM y), range(1, 8) r(b)),
 a AS (SELECT m.*, l.id, l.codes, l.o_orderstatus FROM m LEFT JOIN l USING (tenant_id, source, batch_no)),
 st AS (SELECT tenant_id, source, batch_no, path, covers_to, CASE WHEN count(id) = 0 THEN 'not_received'
   WHEN bool_or(o_orderstatus = 'F') THEN 'loaded' ELSE 'quarantined' END AS status, arg_max(codes, id) AS last_codes,
   min(id) FILTER (WHERE o_orderstatus = 'F') AS loaded_id FROM a GROUP BY ALL),
 cfg AS (SELECT 'c' || c_custkey AS tenant_id, CASE WHEN c_acctbal >= 0 THEN 'orders' ELSE 'refunds' END AS source FROM customer)
"""
ORACLE["batch_health"] = LEDGER + """SELECT tenant_id, source, batch_no, path, covers_to, status,
  CASE WHEN status = 'quarantined' THEN last_codes END AS reason_codes FROM st"""
ORACLE["conflicting_redelivery"] = LEDGER + """SELECT st.tenant_id, st.source, st.batch_no, path, covers_to,
  arg_max(codes, id) AS reason_codes FROM st JOIN l ON l.tenant_id = st.tenant_id AND l.batch_no = st.batch_no
  AND l.id > st.loaded_id AND l.o_orderstatus = 'O' GROUP BY ALL"""
ORACLE["stale_sources"] = LEDGER + """SELECT * FROM (SELECT tenant_id, source,
  max(covers_to) FILTER (WHERE status = 'loaded') AS fresh_through, '2001-12-31' AS as_of
  FROM st JOIN cfg USING (tenant_id, source) GROUP BY ALL) WHERE fresh_through IS NULL OR fresh_through < as_of"""
ORACLE["no_manifest_entries"] = LEDGER + "SELECT * FROM cfg ANTI JOIN m USING (tenant_id, source)"
ORACLE["source_not_configured"] = LEDGER + """SELECT DISTINCT m.tenant_id, m.source FROM m ANTI JOIN cfg
  ON cfg.tenant_id = m.tenant_id AND cfg.source = m.source"""
ORACLE["alias_notes"] = YEARS + """, u AS (SELECT tenant_id, source, batch_no, 'total' AS header, 'gross' AS column_name FROM y
  WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0), """ + _ranges("u", "tenant_id, source, header, column_name") + " SELECT * FROM ranges"

ORACLE["content_hash"] = "SELECT lang AS source, doc_id AS batch_no, sha256(text) AS sha256 FROM documents"
ORACLE["duplicate_content"] = """SELECT * FROM (SELECT lang AS source, doc_id AS batch_no,
  min(doc_id) OVER (PARTITION BY lang, text) AS first_batch FROM documents) WHERE first_batch < batch_no"""
ORACLE["replay_classification"] = """WITH f AS (SELECT lang AS source, doc_id AS batch_no, sha256(text) AS sha FROM documents),
 l AS (SELECT lang AS source, sha, min(doc_id) AS batch_no FROM (SELECT lang, doc_id,
   sha256(CASE WHEN toxic = 1 THEN text || ' (before)' ELSE text END) AS sha FROM documents JOIN labels USING (doc_id)) GROUP BY ALL),
 v AS (SELECT f.*, b.sha AS bsha, s.batch_no AS sbatch FROM f LEFT JOIN l b ON b.source = f.source AND b.batch_no = f.batch_no
   LEFT JOIN l s ON s.source = f.source AND s.sha = f.sha),
 w AS (SELECT *, CASE WHEN bsha = sha THEN 'skipped' WHEN bsha IS NOT NULL THEN 'batch_conflict'
   WHEN sbatch IS NOT NULL THEN 'duplicate_content' WHEN source NOT IN ('en', 'fr') THEN 'source_not_configured' ELSE 'parse' END AS k FROM v),
 x AS (SELECT *, min(batch_no) FILTER (WHERE k = 'parse') OVER (PARTITION BY source, sha) AS first FROM w)
 SELECT source, batch_no, CASE WHEN k = 'skipped' THEN k WHEN k <> 'parse' OR first < batch_no THEN 'quarantined' ELSE 'loaded' END AS status,
   CASE WHEN k = 'skipped' THEN NULL WHEN k <> 'parse' THEN k WHEN first < batch_no THEN 'duplicate_content' END AS code,
   CASE WHEN k = 'batch_conflict' THEN 'batch ' || batch_no || ' was already loaded with different content (sha256 ' || bsha || ')'
     WHEN k = 'duplicate_content' THEN 'file has the same content as batch ' || sbatch || ', which is already loaded'
     WHEN k = 'source_not_configured' THEN 'docs has no ' || source || ' source'
     WHEN k = 'parse' AND first < batch_no THEN 'file has the same content as batch ' || first || ', which is already loaded' END AS message,
   CASE WHEN k = 'skipped' THEN batch_no + 1 END AS earlier_rows FROM x"""

# RE2 has no look-ahead, so every delimiter is doubled first: each field then has its own pair.
CSV = r"""WITH s AS (SELECT doc_id::VARCHAR AS file, string_split(text, chr(10)) AS ls FROM documents),
 n AS (SELECT file, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS line_no FROM s),
 t AS (SELECT *, max(line_no) FILTER (WHERE line <> '') OVER (PARTITION BY file) AS top,
   length(line) - length(replace(line, '"', '')) AS q FROM n),
 p AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1
   AS o FROM t WHERE line_no <= top),
 c AS (SELECT *, regexp_matches(line, '^([^"]|"")*"([^"]|$)') AS closes FROM p),
 r AS (SELECT *, CASE WHEN NOT o THEN line WHEN closes THEN regexp_replace(line, '^([^"]|"")*"([^"]|$)', '\2') ELSE '' END AS rest FROM c),
 b AS (SELECT *, regexp_replace(regexp_replace(replace(rest, ',', ',,'), '(^|,)"([^"]|"")*"(,|$)', '\1\3', 'g'),
   '(^|,)"([^"]|"")*$', '\1') AS bare FROM r),
 e AS (SELECT *, (o AND closes AND rest <> '' AND rest[1] <> ',') OR bare LIKE '%"%' AS bad,
   (length(bare) - length(replace(bare, ',', ''))) // 2 AS commas, o <> (q % 2 = 1) AS o_end,
   max(CASE WHEN NOT o THEN line_no END) OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS record FROM b),
 shapes AS (SELECT file, record, max(line_no) AS end_line, (sum(commas) + 1)::INT AS fields,
   bool_or(bad) OR arg_max(o_end, line_no) AS stray FROM e GROUP BY file, record)
"""
ORACLE["csv_line_numbers"] = CSV + "SELECT * FROM shapes"
ORACLE["quarantine_reasons"] = CSV + """SELECT file, CASE WHEN stray THEN 'malformed_csv' ELSE 'column_count' END AS code,
  CASE WHEN NOT stray THEN end_line END::INT AS line FROM (SELECT s.*, h.fields AS expected FROM shapes s
  JOIN shapes h ON h.file = s.file AND h.record = 1) WHERE stray OR fields <> expected
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY record) = 1"""
ORACLE["csv_records"] = """SELECT o_orderkey::VARCHAR AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS created_at,
  '"' || o_orderpriority || '", said' AS channel, o_totalprice::DECIMAL(18,2)::VARCHAR AS gross, 'USD' AS currency,
  CASE WHEN o_orderstatus = 'P' THEN 'c' || chr(10) || o_custkey ELSE o_custkey::VARCHAR END AS customer_email FROM orders"""
ORACLE["ndjson_records"] = """SELECT event_id::VARCHAR AS event_id, event_type AS type, props AS email,
  json_extract_string(props, '$.k') AS campaign_id, strftime(ts, '%Y-%m-%d') AS occurred_at FROM events"""
ORACLE["header_resolution"] = """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '' WHEN 'BUILDING' THEN ''
  WHEN 'FURNITURE' THEN 'unknown_header: header "' || c_name || '" is neither a column of ad_spend nor a declared alias; '
    || 'missing_column: column "campaign_id" is missing'
  WHEN 'HOUSEHOLD' THEN 'duplicate_header: header "date" appears more than once; missing_column: column "platform" is missing'
  ELSE 'ambiguous_column: headers "spend" and "cost_usd" both map to column "spend"; '
    || 'unknown_header: header "Platform" is neither a column of ad_spend nor a declared alias; '
    || 'missing_column: column "date" is missing; missing_column: column "platform" is missing' END AS reasons FROM customer"""
ORACLE["adapted_headers"] = """SELECT c_custkey, 'cost_usd' AS header, 'spend' AS column_name FROM customer
  WHERE c_mktsegment = 'BUILDING'"""
ORACLE["value_mapping"] = f"""WITH {CONTROL.strip()} SELECT o_orderkey, 't' || (o_orderkey % 2) AS tenant_id,
  coalesce(canonical_value, o_orderpriority) AS channel FROM orders LEFT JOIN vm ON vm.tenant_id = 't' || (o_orderkey % 2)
  AND vm.source = 'orders' AND column_name = 'channel' AND raw_value = o_orderpriority"""
ORACLE["column_value"] = """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('view', 'click')
  THEN event_type ELSE json_extract_string(props, '$.k') END AS value FROM events"""
ORACLE["safe_casts"] = """SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN o_totalprice::DECIMAL(18,2)::DOUBLE
    WHEN o_orderpriority = '5-LOW' THEN (o_totalprice::DECIMAL(18,2)::VARCHAR || '00001')::DOUBLE END AS amount,
  epoch_us(moment) AS at_us, moment::DATE AS utc_day, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderdate::DATE END AS iso_day
  FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 25 HOUR + INTERVAL 30 MINUTE
    WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 3723 SECOND WHEN '4-NOT SPECIFIED' THEN o_orderdate END AS moment FROM orders)"""
ORACLE["tenant_upsert"] = """SELECT 'c' || c_custkey AS tenant_id,
  CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS display_name, 'USD' AS currency,
  CASE WHEN c_acctbal > 9000 THEN 'insert' ELSE 'update' END AS action FROM customer
  WHERE c_acctbal > 9000 OR (c_acctbal < 0 AND upper(c_name) <> c_name)"""
ORACLE["value_map_sync"] = """WITH c AS (SELECT 'n' || c_nationkey AS tenant_id, 'orders' AS source, 'channel' AS column_name,
  c_name AS raw_value, c_mktsegment AS seg, c_acctbal FROM customer)
 SELECT tenant_id, source, column_name, raw_value, seg AS canonical_value, 'remove' AS action FROM c
   WHERE c_acctbal > 9000 OR c_acctbal < 0
 UNION ALL SELECT tenant_id, source, column_name, raw_value, lower(seg), 'add' FROM c WHERE c_acctbal < 0"""
ORACLE["tenant_scope"] = _with(ALL) + """SELECT tenant_id, batch_no, count(*) AS orders FROM a_orders
  WHERE tenant_id = 't1' GROUP BY ALL"""

_BATCHES = """WITH o AS (SELECT 't' || (o_orderkey % 2) AS tenant_id, (year(o_orderdate::DATE) - 1994)::INT AS batch_no, o_orderkey,
    o_totalprice::DECIMAL(18,2) AS price FROM orders),
years AS (SELECT tenant_id, batch_no, count(*) AS n, count(*) FILTER (o_orderkey % 5 = 0) AS fifth FROM o GROUP BY ALL),
"""
ORACLE["load_result"] = _BATCHES + """said AS (
  SELECT 1 AS load, tenant_id, batch_no, CASE WHEN batch_no = 5 THEN 'quarantined' ELSE 'loaded' END AS status,
    CASE WHEN batch_no <> 5 THEN n END AS row_count, CASE WHEN batch_no = 5 THEN 'unknown_header,missing_column' END AS codes FROM years
  UNION ALL SELECT 1, tenant_id, 8, 'quarantined', NULL, 'duplicate_content' FROM years WHERE batch_no = 1
  UNION ALL SELECT 1, tenant_id, 9, 'missing', NULL, NULL FROM years WHERE batch_no = 1
  UNION ALL SELECT 2, tenant_id, batch_no, CASE batch_no WHEN 2 THEN 'quarantined' WHEN 5 THEN 'loaded' ELSE 'skipped' END,
    CASE WHEN batch_no <> 2 THEN n END, CASE WHEN batch_no = 2 THEN 'batch_conflict' END FROM years
  UNION ALL SELECT 2, tenant_id, 8, 'quarantined', NULL, 'duplicate_content' FROM years WHERE batch_no = 1
  UNION ALL SELECT 2, tenant_id, 9, 'loaded', fifth, NULL FROM years WHERE batch_no = 1)
SELECT load::INT AS load, tenant_id, batch_no::INT AS batch_no, status, row_count::BIGINT AS row_count, codes FROM said"""
ORACLE["load_raw"] = _BATCHES + """kept AS (SELECT tenant_id, batch_no, o_orderkey, price FROM o
  UNION ALL SELECT tenant_id, 9, o_orderkey, price FROM o WHERE batch_no = 1 AND o_orderkey % 5 = 0)
SELECT tenant_id, batch_no::INT AS batch_no, (1 + row_number() OVER (PARTITION BY tenant_id, batch_no ORDER BY o_orderkey))::INT AS line_no,
  o_orderkey::VARCHAR AS order_id, price::VARCHAR AS gross FROM kept"""

# --- runs over derived files (catalog/runs.py) ---------------------------------------------------------

_ARRIVALS = """WITH o AS (SELECT 't' || (o_orderkey % 2) AS tenant_id, (year(o_orderdate::DATE) - 1994)::INT AS batch_no, o_orderkey,
    o_orderdate::DATE AS day, o_totalprice::DECIMAL(18,2) AS price FROM orders),
e AS (SELECT 't' || (user_id % 2) AS tenant_id, ((dayofmonth(ts) - 1) // 6 + 1)::INT AS batch_no, event_id FROM events),
f AS (
  SELECT tenant_id, 'orders' AS source, batch_no, batch_no = 5 AS late, 0 AS broken, count(*) AS n, 1 AS key_sets,
    CASE WHEN tenant_id = 't1' THEN 'total' ELSE '' END AS aliases FROM o GROUP BY ALL
  UNION ALL SELECT tenant_id, 'orders', 9, true, 0, count(*), 1, CASE WHEN tenant_id = 't1' THEN 'total' ELSE '' END
  FROM o WHERE batch_no = 1 AND o_orderkey % 5 = 0 GROUP BY tenant_id
  UNION ALL SELECT tenant_id, 'email_events', batch_no, batch_no IN (4, 5),
    count(*) FILTER (tenant_id = 't1' AND batch_no = 4 AND event_id % 100 = 0), count(*), count(DISTINCT event_id % 2),
    CASE WHEN count(*) FILTER (event_id % 2 = 0) > 0 THEN 'event' ELSE '' END FROM e GROUP BY tenant_id, batch_no),
"""
_ATTEMPTS = _ARRIVALS + """x AS (SELECT *, broken > 0 AS bad FROM f)
SELECT tenant_id, source, batch_no::INT AS batch_no, CASE WHEN bad THEN 'quarantined' ELSE 'loaded' END AS status,
  CASE WHEN NOT bad THEN n END::BIGINT AS row_count, CASE WHEN NOT bad THEN n END::BIGINT AS lines, CASE WHEN NOT bad THEN key_sets END::BIGINT AS key_sets,
  CASE WHEN bad THEN '' ELSE aliases END AS aliases,
  CASE WHEN bad THEN rtrim(repeat('not_an_object,', least(broken, 20)::INT), ',') || CASE WHEN broken > 20 THEN ',truncated' ELSE '' END END AS codes
FROM x"""
ORACLE["load_ledger"] = _ATTEMPTS
ORACLE["load_stream"] = _ATTEMPTS + " WHERE source = 'orders'"
ORACLE["load_summary"] = _ARRIVALS + """listed AS (
  SELECT 't' || t AS tenant_id, 'orders' AS source, unnest([1, 2, 3, 4, 5, 6, 7, 9]) AS batch_no FROM range(2) r(t)
  UNION ALL SELECT 't' || t, 'email_events', unnest([1, 2, 3, 4, 5]) FROM range(2) r(t)),
said AS (
  SELECT 1 AS load, tenant_id, source, CASE WHEN n IS NULL OR late THEN 'missing' WHEN broken > 0 THEN 'quarantined' ELSE 'loaded' END AS status
  FROM listed LEFT JOIN f USING (tenant_id, source, batch_no)
  UNION ALL SELECT 2, tenant_id, source, CASE WHEN n IS NULL THEN 'missing' WHEN broken > 0 THEN 'quarantined' WHEN late THEN 'loaded' ELSE 'skipped' END
  FROM listed LEFT JOIN f USING (tenant_id, source, batch_no))
SELECT load::INT AS load, tenant_id, source, status, count(*) AS files FROM said GROUP BY ALL"""
_REPORTS = """WITH o AS (SELECT 't' || (o_orderkey % 2) AS tenant_id, (year(o_orderdate::DATE) - 1994)::INT AS batch_no, o_orderkey,
    o_orderdate::DATE AS day, o_totalprice::DECIMAL(18,2) AS price FROM orders),
live AS (SELECT tenant_id, day, count(*) AS n, sum(price) AS gross FROM o WHERE batch_no <> 5 GROUP BY ALL),
p AS (SELECT * FROM live WHERE day NOT BETWEEN DATE '1995-01-01' AND DATE '1995-01-31'),
c AS (
  SELECT tenant_id, CASE WHEN fixed AND o_orderkey % 10 = 0 THEN day + 1 ELSE day END AS day, count(*) AS n,
    sum(CASE WHEN fixed THEN price + 1 ELSE price END) AS gross, bool_or(fixed) AS has_fixed
  FROM (SELECT *, batch_no = 1 AND o_orderkey % 5 = 0 AS fixed FROM o) GROUP BY ALL),
both_runs AS (
  SELECT coalesce(p.tenant_id, c.tenant_id) AS tenant_id, coalesce(p.day, c.day) AS day, p.n AS n1, p.gross AS gross1, c.n AS n2, c.gross AS gross2, has_fixed,
    CASE WHEN p.day IS NULL THEN 'new' WHEN c.day IS NULL THEN 'tombstone' WHEN p.n = c.n AND p.gross = c.gross THEN 'unchanged' ELSE 'restated' END AS action
  FROM p FULL JOIN c ON p.tenant_id = c.tenant_id AND p.day = c.day)
"""
ORACLE["publish_run"] = _REPORTS + """, said AS (
  SELECT 1 AS run, tenant_id, true AS recorded, count(*) FILTER (day NOT BETWEEN DATE '1995-01-01' AND DATE '1995-01-31') AS published, 0 AS restated, 0 AS unchanged,
    count(*) FILTER (day BETWEEN DATE '1995-01-01' AND DATE '1995-01-31') AS withheld FROM live GROUP BY tenant_id
  UNION ALL SELECT 2, tenant_id, true, count(*) FILTER (action <> 'unchanged'), count(*) FILTER (action IN ('restated', 'tombstone')),
    count(*) FILTER (action = 'unchanged'), 0 FROM both_runs GROUP BY tenant_id
  UNION ALL SELECT 3, tenant_id, false, 0, 0, count(*), 0 FROM c GROUP BY tenant_id)
SELECT run::INT AS run, tenant_id, recorded, published::BIGINT AS published, restated::BIGINT AS restated, unchanged::BIGINT AS unchanged, withheld::BIGINT AS withheld,
  2::BIGINT AS runs FROM said"""
ORACLE["publish_history"] = _REPORTS + """, why AS (SELECT tenant_id, day, unnest(CASE WHEN action = 'restated' AND has_fixed THEN [9] ELSE [5, 9] END) AS batch_no
  FROM both_runs WHERE action IN ('restated', 'tombstone'))
SELECT tenant_id, day, 1::INT AS version, 1::INT AS run, n::INT AS orders, gross::DOUBLE AS gross, NULL::DOUBLE AS gross_before, NULL::INT AS batch_no FROM p
UNION ALL SELECT tenant_id, day, 1, 2, n2::INT, gross2::DOUBLE, NULL, NULL FROM both_runs WHERE action = 'new'
UNION ALL SELECT b.tenant_id, b.day, 2, 2, n2::INT, gross2::DOUBLE, gross1::DOUBLE, batch_no::INT FROM both_runs b JOIN why w ON w.tenant_id = b.tenant_id AND w.day = b.day"""
ORACLE["publish_withheld"] = _REPORTS + """SELECT tenant_id, 'daily_revenue' AS mart, 'orders' AS source, 9::INT AS batch_no, 'not_received' AS status, day
FROM live WHERE day BETWEEN DATE '1995-01-01' AND DATE '1995-01-31'
UNION ALL SELECT DISTINCT tenant_id, 'daily_revenue', 'orders', 5, 'not_received', NULL::DATE FROM live"""
_SCOPED = """WITH o AS (SELECT o_orderkey % 2 AS t, year(o_orderdate::DATE) - 1994 AS batch_no FROM orders
  UNION ALL SELECT o_orderkey % 2, 8 FROM orders WHERE o_orderstatus = 'P')
"""
ORACLE["scoped_read"] = _SCOPED + """SELECT 't1' AS reader, 't1' AS tenant_id, (2000 + batch_no)::BIGINT AS batch_file_id, count(*) AS lines FROM o WHERE t = 1 GROUP BY ALL"""
ORACLE["scoped_write"] = _SCOPED + """SELECT 't0' AS tenant_id, (1000 + batch_no)::BIGINT AS batch_file_id, count(*) AS lines, true AS refused FROM o WHERE t = 0 GROUP BY ALL"""
