"""DuckDB texts that answer the registered queries independently of the Spark plans.

Each text is assembled from the common table expressions below, which spell the test inputs
and the layers out in SQL; a query names the ones it needs in `with_`.
"""

from __future__ import annotations

AS_OF = "DATE '2026-09-21'"

_PAD = "lpad({x}::VARCHAR, greatest({w}, length({x}::VARCHAR))::INT, '{f}')"


def _pad(x: str, w: int, f: str = "0") -> str:
    return _PAD.format(x=f"({x})", w=w, f=f)


CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTE[name] = (sql, needs)


_cte("bc", f"""
SELECT 'C' || {_pad('c_custkey', 6)} AS customer_id,
       'Given' || (c_custkey % 50)::VARCHAR AS first_name,
       'Family' || (c_custkey % 400)::VARCHAR AS last_name,
       CASE WHEN c_custkey % 83 = 0 THEN '' WHEN c_custkey % 89 = 0 THEN '   '
            WHEN c_custkey % 97 = 0 THEN NULL
            ELSE ' Given' || (c_custkey % 50)::VARCHAR || '.' || c_custkey::VARCHAR || '@Mail'
                 || (c_custkey % 4)::VARCHAR || '.example ' END AS email,
       '+1-555-' || {_pad('(c_custkey * 7919) % 10000000', 7)} AS phone,
       CASE WHEN c_custkey % 101 = 0 THEN 'not-a-date'
            ELSE (DATE '1940-01-01' + ((c_custkey * 7919) % 25000)::INT)::DATE::VARCHAR
       END AS date_of_birth,
       {_pad('(c_custkey * 104729) % 1000000000', 9)} AS national_id,
       c_custkey::VARCHAR || ' Main Street' AS street_address,
       'City' || (c_custkey % 120)::VARCHAR AS city,
       {_pad('(c_custkey * 37) % 100000', 5)} AS postcode,
       n_name AS country, r_name AS region, lower(c_mktsegment) AS segment,
       CASE WHEN (c_custkey * 7) % 20 < 11 THEN 'True' ELSE 'False' END AS marketing_consent,
       (DATE '1993-01-01' + (c_custkey % 700)::INT)::DATE::VARCHAR AS created_at,
       CAST(NULL AS VARCHAR) AS _rescued_data
FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""")

_cte("bo", f"""
SELECT 'O' || {_pad('o_orderkey', 8)} AS order_id,
       CASE WHEN o_orderkey % 331 = 0 THEN 'C9' || {_pad('o_orderkey % 100000', 5)}
            ELSE 'C' || {_pad('o_custkey', 6)} END AS customer_id,
       CASE WHEN o_orderkey % 313 = 0 THEN '2099-01-01' WHEN o_orderkey % 509 = 0 THEN 'bad-date'
            ELSE o_orderdate::DATE::VARCHAR END AS order_date,
       CASE WHEN o_orderkey % 307 = 0 THEN '-' || o_totalprice::DECIMAL(12,2)::VARCHAR
            WHEN o_orderkey % 521 = 0 THEN 'n/a'
            ELSE o_totalprice::DECIMAL(12,2)::VARCHAR END AS amount,
       CASE n_regionkey WHEN 0 THEN ' zar' WHEN 1 THEN 'usd' WHEN 2 THEN 'JPY' WHEN 3 THEN 'eur '
            WHEN 4 THEN 'AED' END AS currency,
       {_pad('((o_orderkey % 3000000000) * 2654435761) % 10000000000000000', 16, '4')}
           AS card_number,
       CASE WHEN o_orderkey % 50 < 45 THEN ' Completed' WHEN o_orderkey % 50 < 48 THEN 'refunded'
            ELSE 'CANCELLED' END AS status,
       CAST(NULL AS VARCHAR) AS _rescued_data
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")

_cte("sc", """
SELECT customer_id, first_name, last_name, lower(trim(email)) AS email, phone, national_id,
       street_address, city, postcode, country, lower(trim(region)) AS region, segment,
       TRY_CAST(marketing_consent AS BOOLEAN) AS marketing_consent,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at,
       year(TRY_CAST(date_of_birth AS DATE))::INT AS birth_year
FROM bc WHERE email IS NOT NULL AND trim(email) <> ''""", "bc")

_cte("qc", """
SELECT *, 'missing_email' AS reject_reason FROM bc
WHERE email IS NULL OR trim(email) = ''""", "bc")

_cte("typed", """
SELECT *, TRY_CAST(amount AS DECIMAL(12,2)) AS amt, TRY_CAST(order_date AS DATE) AS dt
FROM bo""", "bo")

_cte("so", f"""
SELECT o.order_id, o.customer_id, o.dt AS order_date, o.amt AS amount,
       upper(trim(o.currency)) AS currency, lower(trim(o.status)) AS status, o.card_number
FROM typed o JOIN sc USING (customer_id)
WHERE o.amt >= 0 AND o.dt <= {AS_OF}""", "typed", "sc")

_cte("qo", f"""
SELECT o.* EXCLUDE (amt, dt),
       CASE WHEN NOT EXISTS (SELECT 1 FROM bc WHERE bc.customer_id = o.customer_id)
                THEN 'orphan_customer'
            WHEN NOT EXISTS (SELECT 1 FROM sc WHERE sc.customer_id = o.customer_id)
                THEN 'customer_quarantined'
            WHEN o.amt IS NULL THEN 'unparseable_amount'
            WHEN o.dt IS NULL THEN 'unparseable_date'
            WHEN o.amt < 0 THEN 'negative_amount'
            WHEN o.dt > {AS_OF} THEN 'future_order_date' END AS reject_reason
FROM typed o
WHERE order_id NOT IN (SELECT order_id FROM so)""", "typed", "so", "bc", "sc")

# money is rounded half up on whole cents, without a detour over floating point
_cte("rev", """
SELECT sc.region, date_trunc('month', so.order_date)::DATE AS order_month, so.currency,
       count(*) AS orders, count(DISTINCT so.customer_id) AS customers_active,
       sum(so.amount)::DECIMAL(22,2) AS revenue,
       (((2 * (sum(so.amount) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DECIMAL(20,0)
         * 0.01)::DECIMAL(18,2) AS avg_order_value
FROM so JOIN sc ON sc.customer_id = so.customer_id
WHERE so.status = 'completed' GROUP BY ALL""", "so", "sc")

_cte("people", """
SELECT *, ((birth_year // 10) * 10)::INT AS decade FROM sc""", "sc")

_cte("anon", """
SELECT decade::VARCHAR || 's' AS age_band, region, segment, marketing_consent,
       count(*) AS people_in_group
FROM people WHERE birth_year IS NOT NULL GROUP BY ALL HAVING count(*) >= 5""", "people")


def _pick(values, index: str) -> str:
    inner = ", ".join(f"'{v}'" for v in values)
    return f"([{inner}])[({index}) + 1]"


_LAYERS = ("bronze", "gold", "governance", "landing", "silver")


def _schema(k: str) -> str:
    return f"{_pick(_LAYERS, f'(({k}) % 25) % 5')} || '_' || (({k}) % 25)::VARCHAR"


def _catalog(k: str) -> str:
    return f"'env' || ((({k}) % 25) % 4)::VARCHAR"


def _table(k: str) -> str:
    return f"'t' || ({k})::VARCHAR"


_cte("ft", f"""
SELECT {_catalog('c_custkey')} AS table_catalog, {_schema('c_custkey')} AS table_schema,
       {_table('c_custkey')} AS table_name,
       CASE WHEN c_custkey % 11 = 0 THEN 'VIEW' WHEN c_custkey % 13 = 0 THEN 'MATERIALIZED_VIEW'
            ELSE 'MANAGED' END AS table_type,
       CASE WHEN c_custkey % 41 = 0 THEN 'user' || (c_custkey % 7)::VARCHAR
            ELSE 'data_owners' END AS table_owner, c_custkey AS k
FROM customer""")

_cte("ft2", """
SELECT table_schema, table_name,
       CASE WHEN k % 37 = 0 THEN 'EXTERNAL' ELSE table_type END AS table_type
FROM ft WHERE k % 29 <> 0
UNION ALL
SELECT table_schema, 'backing_' || table_name, table_type FROM ft WHERE k % 31 = 0""", "ft")

_cte("fc", f"""
SELECT {_schema('o_custkey')} AS table_schema, {_table('o_custkey')} AS table_name,
       CASE WHEN o_orderkey % 37 = 0 THEN 'region_' ELSE 'c' END || o_orderkey::VARCHAR AS column_name,
       {_pick(('STRING', 'DATE', 'DECIMAL(12,2)', 'STRING', 'BOOLEAN'), 'o_orderkey % 5')}
           AS data_type,
       CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN ''
            ELSE 'Column ' || o_orderkey::VARCHAR END AS comment
FROM orders""")

_LEVEL = (f"CASE WHEN o_orderkey % 97 = 0 THEN 'secret' ELSE "
          f"{_pick(('internal', 'confidential', 'restricted'), 'o_orderkey % 3')} END")
_PII = _pick(("name", "email", "phone", "national_id", "address", "dob", "payment_card",
              "dob_date"), "(o_orderkey // 7) % 8")
_COLKEY = (f"{_schema('o_custkey')} AS table_schema, {_table('o_custkey')} AS table_name, "
           "CASE WHEN o_orderkey % 173 = 0 THEN 'gone' WHEN o_orderkey % 37 = 0 THEN 'region_' ELSE 'c' END || o_orderkey::VARCHAR AS column_name")


def _tags(level: str, has_level: str, moved: int = 0) -> str:
    return f"""
SELECT {_COLKEY}, 'classification' AS tag_name, {level} AS tag_value FROM orders WHERE {has_level}
UNION ALL
SELECT {_COLKEY}, 'pii_type', {_PII} FROM orders WHERE o_orderkey % 7 = 0
UNION ALL
SELECT {_COLKEY}, 'filter_key', 'region' FROM orders WHERE o_orderkey % 31 = 0
UNION ALL
SELECT {_COLKEY}, 'cost_center', 'cc' || ((o_orderkey + {moved} * (o_orderkey % 2)) % 5)::VARCHAR
FROM orders WHERE o_orderkey % 61 = 0"""


_cte("fg", _tags(_LEVEL, "o_orderkey % 59 <> 0"))
_cte("fg2", _tags(f"CASE WHEN o_orderkey % 71 = 0 THEN 'restricted' ELSE {_LEVEL} END",
                  "o_orderkey % 59 <> 0 AND o_orderkey % 67 <> 0", 1))

_GRANTEES = ("analyst", "data_engineer", "auditor", "account users", "analyst_eu", "contractor")


def _privileges(where: str = "true") -> str:
    g = "((p_partkey // 10) % 6)"
    c, s, t = f"({g} + (p_partkey // 60) % 2) % 4", f"((p_partkey * 7) % 4) * 6 + {g}", "p_partkey"
    return f"""
SELECT {_pick(_GRANTEES, g)} AS grantee,
       CASE WHEN p_partkey % 30 = 0 THEN 'BROWSE' WHEN p_partkey % 10 = 0 THEN 'USE_CATALOG'
            WHEN p_partkey % 10 IN (1, 2) THEN 'USE_SCHEMA' ELSE 'SELECT' END AS privilege_type,
       CASE WHEN p_partkey % 10 = 0 THEN 'CATALOG' WHEN p_partkey % 10 < 5 THEN 'SCHEMA'
            ELSE 'TABLE' END AS object_type,
       CASE WHEN p_partkey % 10 = 0 THEN 'env' || ({c})::VARCHAR
            WHEN p_partkey % 10 < 5 THEN {_catalog(s)} || '.' || {_schema(s)}
            ELSE {_catalog(t)} || '.' || {_schema(t)} || '.' || {_table(t)} END AS object_key,
       CASE WHEN p_partkey % 9 = 8 THEN 'CATALOG' ELSE 'NONE' END AS inherited_from
FROM part WHERE {where}"""


_cte("fp", _privileges())
_cte("fp2", _privileges("p_partkey % 101 <> 0"))

_cte("fl", f"""
SELECT CASE WHEN event_id % 9 <> 0
            THEN {_schema('(event_id * 31) % 100')} || '.' || {_table('(event_id * 31) % 100')}
       END AS source_table,
       CASE WHEN event_id % 9 = 0 THEN '/landing/file' || (event_id % 5)::VARCHAR END
           AS source_path,
       CASE WHEN event_id % 9 = 0 THEN 'PATH' ELSE 'TABLE' END AS source_type,
       {_schema('user_id')} AS target_schema,
       {_schema('user_id')} || '.' || {_table('user_id')} AS target_table,
       ts AS event_time, event_id
FROM events""")

_NAMES = ("email", "national_id", "date_of_birth", "amount", "status", "region", "city")
_cte("fcl", f"""
SELECT {_schema('l_partkey')} || '.' || {_table('l_partkey')} AS source_table,
       {_pick(_NAMES, 'l_linenumber % 7')} AS source_column,
       {_schema('l_suppkey')} || '.' || {_table('l_suppkey')} AS target_table,
       CASE WHEN l_partkey % 2 = 0 THEN {_pick(_NAMES, 'l_linenumber % 7')}
            ELSE {_pick(_NAMES, 'l_linenumber % 7')} || '_copy' END AS target_column
FROM lineitem""")


def _suffix(index: str) -> str:
    return _pick(("", "_copy", "_hash"), index)


_cte("ff", f"""
SELECT {_schema('l_orderkey')} || '.' || {_table('l_orderkey')} AS source_table,
       {_pick(_NAMES, 'l_linenumber % 7')} || {_suffix('l_partkey % 3')} AS source_column,
       {_schema('k')} || '.' || {_table('k')} AS target_table,
       {_pick(_NAMES, 'l_linenumber % 7')} || {_suffix('(l_partkey + l_suppkey) % 3')} AS target_column
FROM (SELECT *, CASE WHEN l_partkey % 17 = 0 THEN l_orderkey * 16 ELSE l_orderkey // 16 END AS k FROM lineitem)""")

_cte("ftag", f"""
SELECT {_schema('k')} AS table_schema, {_table('k')} AS table_name,
       {_pick(_NAMES, '(k + j) % 7')} || {_suffix('(k // 7) % 3')} AS column_name,
       CASE WHEN k % 97 = 0 THEN 'secret' ELSE {_pick(('internal', 'confidential', 'restricted'), '(k // 5) % 3')} END AS level
FROM (SELECT o_orderkey AS k, 0 AS j FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey, 3 FROM orders WHERE o_orderkey % 10 = 0)""")

_cte("fm", f"""
SELECT 's' || s_suppkey::VARCHAR AS member, 'team' || (s_suppkey % 40)::VARCHAR AS group_name FROM supplier
UNION ALL SELECT 's' || s_suppkey::VARCHAR, {_pick(_GRANTEES, 's_suppkey % 6')} FROM supplier WHERE s_suppkey % 9 = 0
UNION ALL SELECT 's' || s_suppkey::VARCHAR, 'data_owners' FROM supplier WHERE s_suppkey % 50 = 0""")

_cte("fgr", f"""
SELECT DISTINCT 'team' || (s_suppkey % 40)::VARCHAR AS group_name, 'dept' || (s_suppkey % 8)::VARCHAR AS parent FROM supplier
UNION SELECT 'dept' || (s_suppkey % 8)::VARCHAR, {_pick(_GRANTEES, 's_suppkey % 8 % 6')} FROM supplier
UNION SELECT 'dept3', 'team3' FROM supplier WHERE s_suppkey % 40 = 3""")


def with_(sql: str, *names: str) -> str:
    """`sql` behind the named expressions and everything they are built from."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTE[name][1]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = ",\n".join(f"{n} AS ({CTE[n][0]})" for n in order)
    return f"WITH {parts}\n{sql}" if parts else sql
