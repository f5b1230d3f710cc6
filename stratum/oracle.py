"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: the domain mapping of ``stratum.plans.domain``
is restated as SQL CTEs and every operator as plain SQL.  Output types are cast to
the Spark result types.  Spark rounds decimals HALF_UP at fixed scales while DuckDB
turns decimal division and ``AVG(decimal)`` into DOUBLE, so those values are
computed here with exact integer arithmetic (``_half_up_div``).
"""

from __future__ import annotations

# ---------------------------------------------------------------- helpers


def _half_up_div(num: str, den: str) -> str:
    """round_half_up(num / den) for integer expressions, den > 0 (HUGEINT)."""
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def pct2(num: str, den: str) -> str:
    """Spark ``ROUND(num / den * 100, 2)`` for decimal(.,2) inputs, den > 0 -> DECIMAL(38,2)."""
    q = _half_up_div(f"{_cents(num)} * 10000", _cents(den))
    return f"(CAST({q} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)))"


def avg2(sum_expr: str, cnt_expr: str) -> str:
    """Spark ``ROUND(AVG(decimal(10,2)), 2)``: HALF_UP to 6 places, then to 2."""
    micros = _half_up_div(f"{_cents(sum_expr)} * 10000", cnt_expr)
    q = _half_up_div(micros, "10000")
    return f"(CAST({q} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)))"


def round_double2(x: str) -> str:
    """Spark ``ROUND(double, 2)``: HALF_UP on the shortest decimal text of the double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(10,2))"


# ---------------------------------------------------------------- domain mapping

CLAIM = f"""
claim AS (
  SELECT o_orderkey AS claim_id,
         'CLM-' || CAST(o_orderkey AS VARCHAR) AS claim_number,
         o_custkey AS policy_id, o_custkey AS member_id,
         o_orderpriority AS claim_type,
         CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Assessed' ELSE 'Lodged' END AS claim_status,
         CAST(o_orderdate AS DATE) AS service_date,
         CAST(o_orderdate AS DATE) + 2 AS lodgement_date,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 9 END AS assessment_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 16 END AS payment_date,
         'PRV-' || CAST(o_custkey AS VARCHAR) AS provider_id,
         CAST(NULL AS VARCHAR) AS hospital_id,
         {_money('o_totalprice')} AS total_charge,
         {_money(_money('o_totalprice') + ' - ' + _money('floor(o_totalprice / 10)'))} AS total_benefit,
         {_money('floor(o_totalprice / 10)')} AS total_gap,
         {_money("CASE WHEN o_orderpriority = '1-URGENT' THEN 500 ELSE 0 END")} AS excess_applied,
         {_money('0')} AS co_payment_applied,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'online' ELSE 'branch' END AS claim_channel,
         (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS is_fraud,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'inflation' END AS fraud_type,
         o_orderdate AS __START_AT,
         CAST(NULL AS TIMESTAMP) AS __END_AT
  FROM orders
)"""

_GAP = _money("CAST(l_quantity AS DECIMAL(10,2)) * 10")

CLAIM_ASSESSMENT = f"""
claim_assessment AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS assessment_id,
         l_orderkey AS claim_id,
         CASE WHEN l_linestatus = 'F' THEN 'auto' ELSE 'manual' END AS assessment_type,
         l_shipdate AS assessment_date,
         'assessor-' || CAST(l_suppkey AS VARCHAR) AS assessed_by,
         {_money('l_extendedprice')} AS original_benefit,
         {_money(_money('l_extendedprice') + ' - CAST(l_quantity AS DECIMAL(10,2))')} AS adjusted_benefit,
         CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending_review' END AS outcome
  FROM lineitem
)"""

_ANNUAL = _money("CASE l_returnflag WHEN 'A' THEN 150000 WHEN 'R' THEN 250000 ELSE 0 END")

BENEFIT_USAGE = f"""
benefit_usage AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS benefit_usage_id,
         o_custkey AS policy_id, o_custkey AS member_id, l_orderkey AS claim_id,
         l_linenumber AS benefit_category_id,
         CAST(year(l_shipdate) AS INTEGER) AS benefit_year,
         CAST(l_shipdate AS DATE) AS usage_date,
         {_money('l_extendedprice')} AS usage_amount,
         CAST(l_quantity AS INTEGER) AS usage_count,
         {_ANNUAL} AS annual_limit,
         {_money(_ANNUAL + ' - ' + _money('l_extendedprice'))} AS remaining_limit,
         CASE WHEN l_linestatus = 'F' THEN 'Dollar' ELSE 'Visits' END AS limit_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_PAID = _money("CASE o_orderstatus WHEN 'F' THEN " + _money('o_totalprice')
               + " WHEN 'P' THEN " + _money('floor(o_totalprice / 2)') + " ELSE 0 END")

AS_OF_SQL = "DATE '1998-08-02'"

# ---------------------------------------------------------------- gold views
# Derived from the driver tables by another route than the views take: versions as maxima of
# structs, sorted lists in place of windows, FILTER in place of conditional columns.

_CHARGE = _money("l_extendedprice")
_VERSION = f"""
version AS (   -- latest version of a claim line; the greatest values stand for equal times
  SELECT l_orderkey AS k, max({{'at': l_shipdate, 'item': CAST(l_partkey AS VARCHAR), 'quantity': CAST(l_quantity AS INTEGER),
         'charge': {_CHARGE}, 'benefit': {_money(_CHARGE + ' - ' + _GAP)}, 'gap': {_GAP}, 'status': l_linestatus,
         'supplier': CAST(l_suppkey AS VARCHAR)}}) AS v
  FROM lineitem GROUP BY l_orderkey, l_linenumber
)"""
_PER_CLAIM = """
per_claim AS (SELECT k, count(*) AS lines, sum(v.charge) AS charge, sum(v.benefit) AS benefit, sum(v.gap) AS gap FROM version GROUP BY k)"""
_VERDICT = f"""
verdict AS (
  SELECT l_orderkey AS k, max({{'at': l_shipdate, 'id': concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey),
         'kind': if(l_linestatus = 'F', 'auto', 'manual'), 'person': 'assessor-' || l_suppkey,
         'said': CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending_review' END,
         'was': {_CHARGE}, 'became': {_money(_CHARGE + ' - CAST(l_quantity AS DECIMAL(10,2))')}}}) AS a
  FROM lineitem GROUP BY l_orderkey
)"""
_DAY = "CAST(o_orderdate AS DATE)"
_TENTH = _money("floor(o_totalprice / 10)")
# what a claim shows of its order: (column, expression)
_OF_ORDER = {
    "claim_id": "o_orderkey", "claim_number": "concat('CLM-', o_orderkey)", "policy_id": "o_custkey", "member_id": "o_custkey",
    "claim_type": "o_orderpriority", "claim_status": "coalesce(map {'F': 'Paid', 'O': 'Assessed'}[o_orderstatus], 'Lodged')",
    "service_date": _DAY, "lodgement_date": f"{_DAY} + 2", "assessment_date": f"if(o_orderstatus <> 'P', {_DAY} + 9, NULL)",
    "payment_date": f"if(o_orderstatus = 'F', {_DAY} + 16, NULL)", "total_charge": _money("o_totalprice"),
    "total_benefit": _money(_money("o_totalprice") + " - " + _TENTH), "total_gap": _TENTH,
    "excess_applied": _money("if(o_orderpriority = '1-URGENT', 500, 0)"), "co_payment_applied": _money("0"),
    "claim_channel": "if(o_orderpriority[1] IN ('1', '2'), 'online', 'branch')",
    "is_fraud": "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'",
    "fraud_type": "if(o_orderpriority = '1-URGENT' AND o_orderstatus = 'P', 'inflation', NULL)",
    # nine days after service less two for lodgement; seven more to payment
    "days_to_assess": "if(o_orderstatus <> 'P', 7, NULL)::INTEGER", "days_to_pay": "if(o_orderstatus = 'F', 7, NULL)::INTEGER",
}


def _order(*leave_out: str) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in _OF_ORDER.items() if c not in leave_out)


def _big(x: str) -> str:
    return f"CAST(coalesce({x}, 0) AS DECIMAL(20,2))"


CLAIM_SUMMARY = f"""
WITH {_VERSION}, {_PER_CLAIM}, {_VERDICT}
SELECT {_order()}, coalesce(p.lines, 0)::BIGINT AS line_count, {_big('p.charge')} AS total_line_charge,
       {_big('p.benefit')} AS total_line_benefit, {_big('p.gap')} AS total_line_gap,
       a.kind AS assessment_type, a.person AS assessed_by, a.said AS assessment_outcome,
       a.was AS assessed_original_benefit, a.became AS assessed_adjusted_benefit
FROM orders LEFT JOIN per_claim p ON p.k = o_orderkey LEFT JOIN verdict d ON d.k = o_orderkey
"""

BENEFIT_UTILIZATION = f"""
WITH once AS (   -- one row for each claim within a group, so that counting rows counts claims
  SELECT o_custkey AS c, l_linenumber AS n, year(l_shipdate)::INTEGER AS y, if(l_linestatus = 'F', 'Dollar', 'Visits') AS t, o_orderkey,
         o_orderstatus IN ('F', 'O') AS approved, sum({_CHARGE}) AS amount, sum(l_quantity::INTEGER) AS used,
         max({_ANNUAL}) AS most, min({_money(_ANNUAL + ' - ' + _CHARGE)}) AS least, min(l_shipdate)::DATE AS d0, max(l_shipdate)::DATE AS d1
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL
),
g AS (SELECT c, n, y, t, sum(amount) AS amount, sum(used) AS used, max(most) AS most, min(least) AS least, count(*) AS claims,
             count(*) FILTER (approved) AS approved, min(d0) AS d0, max(d1) AS d1 FROM once GROUP BY ALL)
SELECT c AS policy_id, c AS member_id, n AS benefit_category_id, y AS benefit_year, t AS limit_type, amount::DECIMAL(20,2) AS total_usage_amount,
       used::BIGINT AS total_usage_count, most AS annual_limit, least AS remaining_limit, claims::BIGINT AS claim_count, approved::BIGINT AS approved_claim_count,
       d0 AS first_usage_date, d1 AS last_usage_date,
       CAST(if(t = 'Dollar' AND most > 0, {pct2('amount', 'most')}, NULL) AS DECIMAL(27,2)) AS utilization_pct
FROM g
"""


def _billing(paid: str, arrears: str, policy: str, tie: str) -> str:
    """Invoices per customer straight from orders; payments as the greatest (time, tie) of an order's lines."""
    whole = _money("o_totalprice")
    due = f"({_money(whole + ' - ' + paid)})"
    return f"""
WITH bill AS (
  SELECT o_custkey AS c, count(*) AS n, sum({whole}) AS total, sum({paid}) AS paid, sum({due}) AS due,
         count(*) FILTER ({due} > 0 AND {_DAY} + 30 < {AS_OF_SQL}) AS late, count(*) FILTER ({arrears}) AS behind, min({_DAY}) AS d0, max({_DAY}) AS d1
  FROM orders GROUP BY o_custkey
),
last AS (SELECT o_custkey AS c, max({{'at': l_shipdate, {tie}}}) AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_orderkey),
money_in AS (SELECT c, count(*) AS n, sum(p.amount) AS total, max(p.at)::DATE AS d FROM last WHERE p.state = 'Completed' GROUP BY c)
SELECT {policy} AS policy_id, bill.n::BIGINT AS total_invoices, {_big('bill.total')} AS total_invoiced_amount, {_big('bill.paid')} AS total_paid_amount,
       {_big('bill.due')} AS total_outstanding, late::BIGINT AS overdue_count, behind::BIGINT AS arrears_count, d0 AS first_invoice_date, d1 AS last_invoice_date,
       coalesce(money_in.n, 0)::BIGINT AS total_payments, {_big('money_in.total')} AS total_payment_amount, money_in.d AS last_payment_date,
       CAST(if(bill.total > 0, {pct2('bill.paid', 'bill.total')}, 0) AS DECIMAL(27,2)) AS payment_rate_pct
FROM bill LEFT JOIN money_in ON money_in.c = bill.c
"""


_STATE = "if(l_linestatus = 'F', 'Completed', 'Pending')"
POLICY_BILLING_SUMMARY = _billing(_PAID, "o_orderstatus = 'O' AND o_orderpriority[1] IN ('1', '2')", "bill.c",
                                  f"'amount': {_CHARGE}, 'state': {_STATE}, 'bank': CAST(l_partkey AS VARCHAR)")

# Members as sorted lists: an element's neighbours, prefixes and rank come from its place in the list.
def _members(member: str, day: str) -> str:
    return f"""
own AS (SELECT {member} AS m, o_orderkey AS id, {day} AS d, {_money('o_totalprice')} AS x, {_OF_ORDER['total_benefit']} AS b FROM orders),
lists AS (SELECT m, list({{'d': d, 'id': id, 'x': x, 'b': b}} ORDER BY d NULLS FIRST, id) AS l, sum(x) AS life, count(*) AS n FROM own GROUP BY m),
placed AS (SELECT m, l, life, n, unnest(range(1, n + 1)) AS i FROM lists),
member AS (
  SELECT m, l[i].id AS id, l[i].x AS x, life, n, i::INTEGER AS member_claim_seq,
         (l[i].d - l[i - 1].d)::INTEGER AS before_, (l[i + 1].d - l[i].d)::INTEGER AS after_, i,
         list_sum([e.x FOR e IN l[1:i]])::DECIMAL(20,2) AS member_running_total_charge,
         list_sum([e.b FOR e IN l[1:i]])::DECIMAL(20,2) AS member_running_total_benefit,
         CAST({avg2('list_sum([e.x FOR e IN l[greatest(i - 2, 1):i]])', 'least(i, 3)')} AS DECIMAL(11,2)) AS member_moving_avg_charge_3,
         n::BIGINT AS member_total_claims, life::DECIMAL(20,2) AS member_lifetime_charge,
         CAST({avg2('life', 'n')} AS DECIMAL(11,2)) AS member_avg_charge,
         (1 + len([e FOR e IN l IF e.x > l[i].x]))::INTEGER AS member_charge_rank
  FROM placed
),
gaps AS (SELECT *, if(i > 1, before_, NULL) AS days_since_prev_claim, if(i < n, after_, NULL) AS days_to_next_claim FROM member),
below AS (SELECT a.life, coalesce((SELECT sum(n) FROM lists b WHERE b.life < a.life), 0) AS rows FROM (SELECT DISTINCT life FROM lists) a)"""


_MEMBERS = _members("o_custkey", _DAY)

MEMBER_CLAIM_ACTIVITY = f"""
WITH {_VERSION}, {_PER_CLAIM}, {_VERDICT}, {_MEMBERS}
SELECT {_order()}, concat('PRV-', o_custkey) AS provider_id, NULL::VARCHAR AS hospital_id, a.said AS assessment_outcome, a.kind AS assessment_type,
       coalesce(p.lines, 0)::BIGINT AS line_count, g.* EXCLUDE (m, id, x, life, n, i, before_, after_),
       CAST(g.x - member_avg_charge AS DECIMAL(13,2)) AS charge_variance_from_avg,
       {round_double2('100 * (below.rows::DOUBLE / ((SELECT count(*) FROM orders) - 1)::DOUBLE)')} AS member_cost_percentile,
       coalesce(days_since_prev_claim < 7, false) AS rapid_reclaim_flag, g.x > 2 * member_avg_charge AS high_cost_outlier_flag,
       g.i >= 3 AND member_moving_avg_charge_3 > 1.5 * member_avg_charge AS escalating_cost_flag
FROM orders JOIN gaps g ON g.id = o_orderkey JOIN below ON below.life = g.life
LEFT JOIN per_claim p ON p.k = o_orderkey LEFT JOIN verdict d ON d.k = o_orderkey
"""


def gold_sql() -> dict[str, str]:
    return {
        "claim_summary": CLAIM_SUMMARY,
        "benefit_utilization": BENEFIT_UTILIZATION,
        "policy_billing_summary": POLICY_BILLING_SUMMARY,
        "member_claim_activity": MEMBER_CLAIM_ACTIVITY,
    }


# ---------------------------------------------------------------- operator queries

_EV = "SELECT user_id, ts, event_type, value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL"

LATEST_PER_KEY = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1
"""

SCD1_LATEST = f"""
SELECT user_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
      ORDER BY ts DESC, event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
  FROM ({_EV})) WHERE rn = 1
"""

_SCD2_FULL = f"""
WITH one AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, ts
        ORDER BY event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
    FROM ({_EV})) WHERE rn = 1
),
hist AS (
  SELECT user_id, event_type, value, ts AS __START_AT,
         LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT
  FROM one
)"""

PROGRESS_EVENTS = """
WITH ev AS (SELECT event_id % 3 AS batch_id, if(event_id % 11 <> 0, user_id, NULL) AS user_id, ts, event_type, value FROM events),
tops AS (SELECT user_id, batch_id, max(ts) AS top FROM ev WHERE user_id IS NOT NULL GROUP BY ALL),
late AS (SELECT ev.batch_id, count_if(coalesce(ev.ts < (SELECT max(top) FROM tops t WHERE t.user_id = ev.user_id AND t.batch_id < ev.batch_id), false)) AS late_rows
         FROM ev GROUP BY ev.batch_id),
counts AS (SELECT batch_id, count(*) AS input_rows, count_if(user_id IS NULL OR ts IS NULL) AS invalid_rows,
                  count_if(coalesce(value > 50, false)) AS p1, count_if(coalesce(event_type <> 'error', false)) AS p2 FROM ev GROUP BY batch_id),
rules AS (SELECT batch_id, input_rows, invalid_rows, unnest(['value_over_50', 'no_error']) AS rule, unnest([p1, p2]) AS passed FROM counts)
SELECT f.layer, f.flow, batch_id, input_rows, if(f.flow = 'user_state', invalid_rows, NULL)::BIGINT AS invalid_rows,
       if(f.flow = 'user_state', late_rows, NULL)::BIGINT AS late_rows, rule, passed::BIGINT AS passed, (input_rows - passed)::BIGINT AS failed
FROM rules JOIN late USING (batch_id), (VALUES ('silver', 'user_state'), ('bronze', 'event_rows')) f(layer, flow)
"""

SCD2_BURST_KEY = """
WITH ev AS (
  SELECT if(event_id % 20 = 0, -1, user_id) AS user_id, event_type, value,
         if(event_id % 20 = 0, '2024-01-15 12:00:00.' || lpad(event_id::VARCHAR, 12, '0'), strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS seq_at
  FROM events),
one AS (
  SELECT * FROM ev WHERE user_id IS NOT NULL AND seq_at IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, seq_at ORDER BY event_type DESC NULLS LAST, value DESC NULLS LAST) = 1)
SELECT user_id, event_type, value, seq_at AS __START_AT, LEAD(seq_at) OVER (PARTITION BY user_id ORDER BY seq_at) AS __END_AT
FROM one
"""

SCD2_HISTORY = _SCD2_FULL + "\nSELECT * FROM hist\n"
SCD2_CURRENT = _SCD2_FULL + "\nSELECT * FROM hist WHERE __END_AT IS NULL\n"

SCD2_PARTIAL_UPDATE = """
WITH ev AS (
  SELECT user_id, ts,
         CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
         CASE WHEN event_type = 'purchase' THEN value END AS value
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL
),
one AS (SELECT user_id, ts, FIRST(event_type ORDER BY event_type DESC NULLS LAST, value DESC NULLS LAST) FILTER (event_type IS NOT NULL) AS event_type,
               FIRST(value ORDER BY event_type DESC NULLS LAST, value DESC NULLS LAST) FILTER (value IS NOT NULL) AS value
        FROM ev GROUP BY user_id, ts)
SELECT user_id,
       LAST_VALUE(event_type IGNORE NULLS) OVER w AS event_type,
       LAST_VALUE(value IGNORE NULLS) OVER w AS value,
       ts AS __START_AT,
       LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT
FROM one
WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

SCD2_COMPOSITE_KEY = """
WITH one AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type, ts
        ORDER BY value DESC NULLS LAST, props DESC NULLS LAST) AS rn
    FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL) WHERE rn = 1
)
SELECT user_id, event_type, value, props, ts AS __START_AT,
       LEAD(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS __END_AT
FROM one
"""

SEQUENCE_FALLBACK = """
WITH e AS (
  SELECT event_id, user_id, event_type, value,
         COALESCE(CASE WHEN event_type <> 'signup' THEN ts END,
                  CASE WHEN event_type <> 'error' THEN ts - INTERVAL 1 SECOND END) AS seq
  FROM events
),
one AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, seq
        ORDER BY event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
    FROM e WHERE user_id IS NOT NULL AND seq IS NOT NULL) WHERE rn = 1
)
SELECT user_id, event_id, event_type, value, seq AS __START_AT,
       LEAD(seq) OVER (PARTITION BY user_id ORDER BY seq) AS __END_AT
FROM one
"""

_U = "upper(md5(CAST(event_id AS VARCHAR)))"
_DASHED = (f"substr({_U}, 1, 8) || '-' || substr({_U}, 9, 4) || '-' || substr({_U}, 13, 4)"
           f" || '-' || substr({_U}, 17, 4) || '-' || substr({_U}, 21, 12)")

UUID_TEXT = f"""
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN {_DASHED} ELSE '' END AS event_uuid,
       CASE WHEN event_type <> 'error' THEN {_DASHED} END AS event_uuid_or_null
FROM events
"""

HEX_TEXT = f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {_U} END AS event_uuid FROM events"

EPOCH_CONVERSION = "SELECT event_id, ts AS created_at, CAST(ts AS DATE) AS event_day FROM events"

PERCENT_RANK_GLOBAL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       PERCENT_RANK() OVER (ORDER BY CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END ASC NULLS FIRST) AS pct_rank
FROM lineitem
"""

CONDITIONAL_COUNTS = """
SELECT o_custkey AS customer,
       COUNT(*) AS orders,
       COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS finished,
       CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_sum,
       COUNT(DISTINCT o_orderpriority) AS priorities,
       COUNT(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS pending_priorities,
       MIN(CAST(o_orderdate AS DATE)) AS first_order,
       MAX(CAST(o_orderdate AS DATE)) AS last_order
FROM orders GROUP BY o_custkey
"""

def _from_windows(cols: str) -> str:
    return f"WITH {_MEMBERS}\nSELECT {cols} FROM gaps\n"


def _quality_sql() -> str:
    from stratum.operators.quality import SILVER_RULES
    parts = []
    for t in ("claim", "claim_assessment", "benefit_usage"):
        for name, expr in SILVER_RULES[t]:
            ok = f"COALESCE(({expr}), false)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{name}' AS rule, "
                f"CAST(COUNT(*) FILTER (WHERE {ok}) AS BIGINT) AS passed, "
                f"CAST(COUNT(*) FILTER (WHERE NOT {ok}) AS BIGINT) AS failed FROM {t}")
    return f"WITH {CLAIM}, {CLAIM_ASSESSMENT}, {BENEFIT_USAGE}\n" + "\nUNION ALL\n".join(parts)


_TOTAL, _CHARGED = _money("o_totalprice"), _money("l_extendedprice")
_BENEFIT = _money("l_extendedprice - l_quantity * 10")
# Spelled out over the driver tables: what each rule says of the derived feed (ids made by hashing are never null).
FEED_RULES = {
    ("invoice", "orders"): {
        "invoice_id_not_null": "true", "invoice_number_not_null": "o_orderkey IS NOT NULL", "policy_id_not_null": "true",
        "invoice_date_not_null": "o_orderdate IS NOT NULL", "net_amount_non_negative": f"{_TOTAL} >= 0",
        "total_amount_non_negative": f"{_TOTAL} >= 0", "gst_amount_non_negative": "true",
        "paid_amount_non_negative": f"if(o_orderstatus = 'F', {_TOTAL}, 0) >= 0",
        "balance_due_non_negative": f"{_TOTAL} >= 0 OR (o_orderstatus = 'F' AND o_totalprice IS NOT NULL)",
        "valid_invoice_status": "true", "period_end_after_start": "o_orderdate IS NOT NULL",
        "due_date_after_invoice_date": "o_orderdate IS NOT NULL"},
    ("payment", "lineitem JOIN orders ON l_orderkey = o_orderkey"): {
        "payment_id_not_null": "true", "payment_number_not_null": "true", "policy_id_not_null": "true", "invoice_id_not_null": "true",
        "payment_date_not_null": "l_shipdate IS NOT NULL", "payment_amount_positive": f"{_CHARGED} > 0",
        "valid_payment_status": "false", "valid_payment_method": "true"},      # 'Completed' and 'Pending' are written with capitals
    ("claim_line", "lineitem"): {
        "claim_line_id_not_null": "true", "claim_id_not_null": "l_orderkey IS NOT NULL", "line_number_positive": "l_linenumber > 0",
        "item_code_not_null": "l_partkey IS NOT NULL", "service_date_not_null": "l_shipdate IS NOT NULL",
        "quantity_positive": "trunc(l_quantity) > 0", "charge_amount_non_negative": f"{_CHARGED} >= 0",
        "benefit_amount_non_negative": f"{_BENEFIT} >= 0", "gap_amount_non_negative": "l_quantity * 10 >= 0",
        "schedule_fee_non_negative": "false",                                   # the feed has no fee: null
        "benefit_not_exceed_charge": f"{_BENEFIT} <= {_CHARGED}"},
}


def _feed_quality_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE coalesce({says}, false))::BIGINT AS passed, "
        f"count(*) FILTER (WHERE NOT coalesce({says}, false))::BIGINT AS failed FROM {source}"
        for (t, source), rules in FEED_RULES.items() for rule, says in rules.items())


def operator_sql() -> dict[str, str]:
    return {
        "latest_per_key": LATEST_PER_KEY,
        "scd1_latest": SCD1_LATEST,
        "scd2_history": SCD2_HISTORY,
        "scd2_partial_update": SCD2_PARTIAL_UPDATE,
        "scd2_current": SCD2_CURRENT,
        "scd2_composite_key": SCD2_COMPOSITE_KEY,
        "scd2_burst_key": SCD2_BURST_KEY,
        "sequence_fallback": SEQUENCE_FALLBACK,
        "uuid_text": UUID_TEXT,
        "hex_text": HEX_TEXT,
        "epoch_conversion": EPOCH_CONVERSION,
        "expectation_counts": _quality_sql(),
        "expectation_counts_feeds": _feed_quality_sql(),
        "expectation_passthrough": f"WITH {CLAIM_ASSESSMENT} SELECT * FROM claim_assessment",
        "member_windows_nulls": "WITH " + _members("if(o_orderkey % 7 <> 0, o_custkey, NULL)", f"if(o_orderkey % 5 <> 0, {_DAY}, NULL)")
        + "\nSELECT id AS claim_id, m AS member_id, * EXCLUDE (m, id, x, life, n, i, before_, after_) FROM gaps",
        "member_sequence_gaps": _from_windows(
            "id AS claim_id, m AS member_id, member_claim_seq, days_since_prev_claim, days_to_next_claim"),
        "running_totals": _from_windows(
            "id AS claim_id, member_running_total_charge, member_running_total_benefit"),
        "moving_average": _from_windows("id AS claim_id, member_moving_avg_charge_3"),
        "partition_totals": _from_windows(
            "id AS claim_id, member_total_claims, member_lifetime_charge, member_avg_charge"),
        "charge_rank": _from_windows("id AS claim_id, member_charge_rank"),
        "percent_rank_global": PERCENT_RANK_GLOBAL,
        "conditional_counts": CONDITIONAL_COUNTS,
    }


# ---------------------------------------------------------------- ingest, flows, landing

_ORDERS_MONTH = "strftime(o_orderdate, '%Y-%m')"
_ORDERS_OUT = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, {d} AS o_orderdate, "
               "{p} AS o_orderpriority, " + _ORDERS_MONTH + " AS extraction_month")

_MONTHS = """
table_months AS (
  SELECT 'claims' AS schema_name, 'orders' AS table_name, strftime(o_orderdate, '%Y-%m') AS month FROM orders
  UNION SELECT 'claims', 'lineitem', strftime(l_shipdate, '%Y-%m') FROM lineitem
  UNION SELECT 'web', 'events', strftime(ts, '%Y-%m') FROM events
)"""

_TRACKED = f"""
WITH {_MONTHS},
n AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT schema_name, table_name FROM table_months)),
tracked AS (
  SELECT month AS simulation_month,
         CAST((SELECT n FROM n) AS INTEGER) AS total_tables_found,
         CAST(COUNT(*) AS INTEGER) AS tables_with_files,
         CAST((SELECT n FROM n) - COUNT(*) AS INTEGER) AS tables_skipped,
         CAST(COUNT(*) AS INTEGER) AS total_files_transferred,
         'success' AS status
  FROM table_months WHERE month <= '2001-08' GROUP BY month
)"""


TRACKER_STATUS = f"""
WITH m AS (SELECT DISTINCT {_ORDERS_MONTH} AS simulation_month FROM orders WHERE {_ORDERS_MONTH} <= '1996-06'),
f AS (SELECT simulation_month, if(simulation_month = '1996-03', 1, 2) AS files, (simulation_month IN ('1996-03', '1996-05'))::INT AS lost FROM m)
SELECT simulation_month, 2::INTEGER AS total_tables_found, files::INTEGER AS tables_with_files, (2 - files)::INTEGER AS tables_skipped,
       (files - lost)::INTEGER AS total_files_transferred, CASE WHEN lost = 0 THEN 'success' WHEN lost = files THEN 'failed' ELSE 'partial' END AS status,
       lost = 0 AS all_bytes, lost::BIGINT AS errors
FROM f
"""

TRACKER_ATTEMPTS = f"""
WITH m AS (SELECT DISTINCT {_ORDERS_MONTH} AS simulation_month FROM orders WHERE {_ORDERS_MONTH} <= '1996-06'),
a AS (SELECT simulation_month, 1 AS attempt, simulation_month <> '1996-03' AS good FROM m
      UNION ALL SELECT simulation_month, 2, simulation_month = '1996-02' FROM m WHERE simulation_month IN ('1996-02', '1996-03')
      UNION ALL SELECT simulation_month, 3, true FROM m WHERE simulation_month = '1996-03')
SELECT simulation_month, attempt::INTEGER AS attempt, good::INTEGER AS files, if(good, 'success', 'failed') AS status, true AS bytes_agree, true AS mb_agree,
       (SUM(good::INT) OVER ())::BIGINT AS all_successful_runs, (SUM((NOT good)::INT) OVER ())::BIGINT AS all_failed_runs
FROM a
"""


def flow_sql() -> dict[str, str]:
    plain = _ORDERS_OUT.format(d="o_orderdate", p="o_orderpriority")
    evolved = "SELECT " + _ORDERS_OUT.format(d="o_orderdate", p=f"CASE WHEN {_ORDERS_MONTH} <= '1997-12' THEN NULL ELSE o_orderpriority END") + " FROM orders"
    return {
        "release_new_column": evolved,
        "release_csv_reordered": f"SELECT {_ORDERS_OUT.format(d='CAST(o_orderdate AS DATE)', p='o_orderpriority')} FROM orders",
        "release_late_files": f"SELECT {plain} FROM orders",
        "tracker_status_partial": TRACKER_STATUS,
        "tracker_attempts": TRACKER_ATTEMPTS,
        "release_corrected_file": f"""SELECT o_orderkey, CASE WHEN {_ORDERS_MONTH} > '1997-12' THEN 'Z' ELSE o_orderstatus END AS o_orderstatus, {_ORDERS_MONTH} AS extraction_month,
            ({_ORDERS_MONTH} > '1997-12')::BIGINT AS versions_replaced FROM orders""",
        "ingest_parquet_incremental": f"SELECT {plain} FROM orders",
        "ingest_json_incremental": f"SELECT {plain} FROM orders",
        "ingest_csv_incremental":
            f"SELECT {_ORDERS_OUT.format(d='CAST(o_orderdate AS DATE)', p='o_orderpriority')} FROM orders",
        "schema_evolution": "SELECT " + _ORDERS_OUT.format(
            d="o_orderdate",
            p=f"CASE WHEN {_ORDERS_MONTH} <= '1997-12' THEN NULL ELSE o_orderpriority END") + " FROM orders",
        "lineage_columns": f"SELECT o_orderkey, {_ORDERS_MONTH} AS extraction_month, true AS path_has_month, "
                           "true AS path_ends_with_name, true AS stamped FROM orders",
        "ingest_mixed_types": f"""
            SELECT CASE WHEN m <= '1997-12' THEN k WHEN k * 1000003 <= 2147483647 THEN k * 1000003 END::INT AS o_orderkey, o_orderstatus,
                   CASE WHEN m > '1997-12' AND k * 1000003 > 2147483647 THEN '{{"o_orderkey":"' || (k * 1000003) || '"}}' END AS _rescued, m AS extraction_month
            FROM (SELECT o_orderkey::BIGINT AS k, o_orderstatus, {_ORDERS_MONTH} AS m FROM orders)""",
        "ingest_csv_mixed_types": f"""
            SELECT CASE WHEN m <= '1997-12' OR k % 2 = 1 THEN k END::INT AS o_orderkey, o_orderstatus,
                   CASE WHEN m > '1997-12' AND k % 2 = 0 THEN '{{"o_orderkey":"K' || k || '"}}' END AS _rescued, m AS extraction_month
            FROM (SELECT o_orderkey::BIGINT AS k, o_orderstatus, {_ORDERS_MONTH} AS m FROM orders)""",
        "ingest_case_clash": f"""
            SELECT o_orderkey::BIGINT AS o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS status,
                   CASE WHEN o_orderkey % 3 = 0 THEN '{{"status":"' || o_orderstatus || '"}}' END AS _rescued, {_ORDERS_MONTH} AS extraction_month FROM orders""",
        "scd2_streaming": SCD2_HISTORY,
        "scd2_retry": SCD2_HISTORY,
        "scd1_streaming": SCD1_LATEST,
        "append_epoch_conversion": "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_day, "
                                   "ts AS created_at FROM events",
        "uuid_append_flow": HEX_TEXT,
        "scd1_struct_sequence": SCD1_LATEST,
        "sql_stream_flow": "SELECT event_id, user_id, upper(event_type) AS kind, ts::DATE AS event_day, "
                           f"{round_double2('value * 2')} AS twice FROM events WHERE event_type <> 'error'",
        "sql_file_view": "SELECT ts::DATE AS event_day, event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY ALL",
        "quality_metrics_table": "SELECT 'events' AS \"table\", rule, sum(ok::BIGINT)::BIGINT AS passed, sum((NOT ok)::BIGINT)::BIGINT AS failed, true AS several_batches FROM ("
                                 "SELECT unnest(['value_over_50', 'known_user', 'no_error']) AS rule, "
                                 "unnest([coalesce(value > 50, false), user_id IS NOT NULL, coalesce(event_type <> 'error', false)]) AS ok FROM events) GROUP BY rule",
        "progress_events": PROGRESS_EVENTS,
        "month_inventory": f"WITH {_MONTHS} SELECT schema_name, table_name, month, CAST(1 AS BIGINT) AS files "
                           "FROM table_months",
        "dry_run_listing": f"WITH {_MONTHS} SELECT schema_name, table_name, COUNT(DISTINCT month) AS months, "
                           "MIN(month) AS first_month, MAX(month) AS last_month FROM table_months "
                           "GROUP BY schema_name, table_name",
        "next_month": f"""WITH {_MONTHS}, m AS (SELECT DISTINCT month FROM table_months)
            SELECT (SELECT MAX(month) FROM m WHERE month <= '2001-08') AS last_processed,
                   (SELECT MIN(month) FROM m WHERE month > '2001-08') AS next_month,
                   CAST((SELECT COUNT(*) FROM m WHERE month > '2001-08') AS INTEGER) AS remaining_months""",
        "months_up_to": f"WITH {_MONTHS} SELECT DISTINCT month FROM table_months WHERE month > '2001-08'",
        "tracker_history": _TRACKED + """
            SELECT * FROM tracked ORDER BY simulation_month DESC LIMIT 50""",
        "tracker_overview": _TRACKED + """
            SELECT COUNT(*) AS months_processed, MIN(simulation_month) AS first_month,
                   MAX(simulation_month) AS latest_month,
                   CAST(SUM(total_files_transferred) AS BIGINT) AS total_files,
                   AVG(tables_with_files) AS avg_tables_with_files,
                   AVG(tables_skipped) AS avg_tables_skipped,
                   CAST(SUM(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successful_runs,
                   CAST(SUM(CASE WHEN status = 'partial' THEN 1 ELSE 0 END) AS BIGINT) AS partial_runs,
                   CAST(SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_runs
            FROM tracked""",
        "released_rows": f"SELECT {plain} FROM orders WHERE {_ORDERS_MONTH} <= '2001-08'",
    }


def replay_sql() -> dict[str, str]:
    # claim lines arrive through the partial-update flow there; without NULLs, merged peers equal the greatest of them
    return {"month_replay_gold": CLAIM_SUMMARY}


def _uuid_text(parts_sql: str) -> str:
    h = f"upper(md5({parts_sql}))"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


_PAYMENT_ID = _uuid_text("concat('pay|', concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey))")
BILLING_REPLAY = _billing(_money("if(o_orderstatus = 'F', " + _money("o_totalprice") + ", 0)"), "o_orderpriority = '1-URGENT'",
                          _uuid_text("concat('pol|', bill.c)"), f"'id': {_PAYMENT_ID}, 'amount': {_CHARGE}, 'state': {_STATE}")


def billing_replay_sql() -> dict[str, str]:
    # the usage replay's silver rows equal the domain mapping, so the view's SQL applies
    return {"month_replay_billing": BILLING_REPLAY, "month_replay_usage": BENEFIT_UTILIZATION}
