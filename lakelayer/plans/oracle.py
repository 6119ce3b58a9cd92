"""Reference SQL (DuckDB dialect) for the registered queries.

Each query is written directly over the driver tables: the fixture mapping,
the warehouse steps and the final projection, as plain SQL with window
functions. The CTEs below are shared; ``sql(final)`` prepends the ones the final
statement needs (found by name), in dependency order.
"""

from __future__ import annotations

import re

_CATEGORY3 = (
    "CASE p_type WHEN 'ECONOMY' THEN '1' WHEN 'LARGE' THEN '2' WHEN 'MEDIUM' THEN '3' "
    "WHEN 'PROMO' THEN '4' WHEN 'SMALL' THEN '5' WHEN 'STANDARD' THEN '6' END"
)
_D = "CAST(100 AS DOUBLE)"
_HALF = "CAST(0.5 AS DOUBLE)"

# (name, body) in dependency order.
CTES: list[tuple[str, str]] = [
    ("order_times", """
SELECT o_orderkey AS oid, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ctime FROM orders"""),
    ("order_lines", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS line_no
FROM lineitem"""),
    ("order_detail", """
SELECT l_orderkey * 1000 + line_no AS id, l_orderkey AS order_id, l_partkey AS sku_id,
       CAST(p_retailprice AS DECIMAL(18,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
       p_name AS sku_name, t.ctime + to_seconds((l_partkey + line_no * 5) % 40) AS create_time
FROM order_lines LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN order_times t ON t.oid = l_orderkey"""),
    ("order_totals", """
SELECT order_id AS tid, CAST(SUM(order_price * sku_num) AS DECIMAL(18,2)) AS orig FROM order_detail GROUP BY order_id"""),
    ("order_info", """
SELECT o_orderkey AS id, CAST(CASE WHEN c_nationkey = 24 THEN 124 ELSE c_nationkey END AS BIGINT) AS province_id, o_orderstatus AS order_status,
       o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS final_total_amount,
       CAST(CAST(COALESCE(tt.orig, 0) AS DECIMAL(18,2)) + CAST(10 AS DECIMAL(18,2))
            - CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS benefit_reduce_amount,
       CAST(COALESCE(tt.orig, 0) AS DECIMAL(18,2)) AS original_total_amount,
       CAST(10 AS DECIMAL(18,2)) AS feight_fee,
       t.ctime + INTERVAL 900 SECOND AS expire_time, t.ctime AS create_time,
       t.ctime + INTERVAL 60 SECOND AS operate_time
FROM orders JOIN order_times t ON t.oid = o_orderkey
     LEFT JOIN customer ON c_custkey = o_custkey
     LEFT JOIN order_totals tt ON tt.tid = o_orderkey"""),
    ("sku_info", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS VARCHAR) AS spu_id, CAST(p_retailprice AS VARCHAR) AS price,
       p_name AS sku_name,
       CAST(CAST(replace(p_brand, 'Brand#', '') AS BIGINT)
            + CASE WHEN CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 10 = 0 THEN 900 ELSE 0 END AS VARCHAR) AS tm_id,
       CASE WHEN {_CATEGORY3} = '6' THEN '906' ELSE {_CATEGORY3} END AS category3_id,
       '2024-01-01 00:00:00' AS create_time
FROM part"""),
    ("base_trademark", """
SELECT DISTINCT replace(p_brand, 'Brand#', '') AS id, p_brand AS tm_name FROM part"""),
    ("base_category3", f"""
SELECT DISTINCT {_CATEGORY3} AS id, p_type AS name, '1' AS category2_id FROM part"""),
    ("spu_info", """
SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'SPU_' || CAST(p_size AS VARCHAR) AS spu_name FROM part"""),
    ("province_info", """
SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'A' || CAST(n_regionkey AS VARCHAR) AS area_code,
       'ISO-' || CAST(n_nationkey AS VARCHAR) AS iso_code
FROM nation"""),
    ("user_info", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level,
       strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS birthday,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS gender
FROM customer"""),
    ("user_status", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, '1' AS if_consumed FROM customer WHERE c_custkey % 5 = 0"""),
    ("user_age", """
SELECT *, date_diff('second', CAST(birthday AS TIMESTAMP), TIMESTAMP '2024-01-01 00:00:00') // 31536000 AS age
FROM user_info"""),
    ("user_dim", """
SELECT id, user_level, birthday, gender,
       CASE WHEN age IS NULL THEN NULL WHEN age < 20 THEN '20岁及以下' WHEN age > 30 THEN '30岁以上'
            ELSE '21岁到30岁' END AS age_group,
       CASE WHEN gender = 'M' THEN '男' ELSE '女' END AS gender_name
FROM user_age"""),
    ("sku_dim", """
SELECT s.*, c.name AS category3_name, sp.spu_name, tm.tm_name
FROM sku_info s LEFT JOIN base_trademark tm ON tm.id = s.tm_id
     LEFT JOIN base_category3 c ON c.id = s.category3_id
     LEFT JOIN spu_info sp ON sp.id = s.spu_id"""),
    ("status_keys", """
SELECT DISTINCT TRY_CAST(user_id AS BIGINT) AS uid FROM user_status WHERE TRY_CAST(user_id AS BIGINT) IS NOT NULL"""),
    ("order_status_flag", """
SELECT o.*, CASE WHEN s.uid IS NOT NULL THEN '0' ELSE '1' END AS if_first_order
FROM order_info o LEFT JOIN status_keys s ON s.uid = o.user_id"""),
    ("order_first", """
SELECT o.*, CASE WHEN s.uid IS NULL
                  AND row_number() OVER (PARTITION BY o.user_id ORDER BY o.create_time, o.id) = 1
             THEN '1' ELSE '0' END AS if_first_order
FROM order_info o LEFT JOIN status_keys s ON s.uid = o.user_id"""),
    ("order_dwd", """
SELECT o.*, strftime(o.create_time, '%Y-%m-%d') AS create_date, CAST(hour(o.create_time) AS VARCHAR) AS create_hour,
       p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
       u.age_group AS user_age_group, u.gender_name AS user_gender
FROM order_first o LEFT JOIN province_info p ON p.id = CAST(o.province_id AS VARCHAR)
     LEFT JOIN user_dim u ON u.id = CAST(o.user_id AS VARCHAR)"""),
    ("detail_dwd", """
SELECT d.*, TRY_CAST(s.spu_id AS BIGINT) AS spu_id, TRY_CAST(s.tm_id AS BIGINT) AS tm_id,
       TRY_CAST(s.category3_id AS BIGINT) AS category3_id, s.spu_name, s.tm_name, s.category3_name
FROM order_detail d LEFT JOIN sku_dim s ON s.id = CAST(d.sku_id AS VARCHAR)"""),
    ("wide_all", """
SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
       d.order_price AS sku_price, d.sku_num, d.sku_name, o.benefit_reduce_amount, o.feight_fee,
       o.original_total_amount, o.final_total_amount, o.if_first_order, o.province_name, o.province_area_code,
       o.user_age_group, o.user_gender, o.create_date AS dt, d.spu_id, d.tm_id, d.category3_id, d.spu_name,
       d.tm_name, d.category3_name, d.create_time AS detail_time
FROM order_dwd o JOIN detail_dwd d ON d.order_id = o.id"""),
    ("wide_window", """
SELECT * FROM wide_all
WHERE detail_time BETWEEN create_time - INTERVAL 20 SECOND AND create_time + INTERVAL 20 SECOND
  AND abs((epoch_ms(create_time) // 1000) // 5 - (epoch_ms(detail_time) // 1000) // 5) <= 3"""),
    ("split_staged", f"""
SELECT *, CAST(sku_price * sku_num AS DECIMAL(18,2)) AS amount,
       CASE WHEN original_total_amount <> 0
            THEN CAST(floor(CAST(final_total_amount AS DOUBLE)
                            * (CAST(CAST(sku_price * sku_num AS DECIMAL(18,2)) AS DOUBLE)
                               / CAST(original_total_amount AS DOUBLE)) * {_D} + {_HALF}) / {_D} AS DECIMAL(18,2))
            ELSE CAST(0 AS DECIMAL(18,2)) END AS share0
FROM wide_all"""),
    ("split_sums", """
SELECT *, COALESCE(SUM(amount) OVER w, 0) AS origin_before, COALESCE(SUM(share0) OVER w, 0) AS split_before,
       COUNT(*) OVER w AS n_before
FROM split_staged
WINDOW w AS (PARTITION BY order_id ORDER BY order_detail_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
    ("wide_paid", """
SELECT *, CASE
  WHEN original_total_amount - origin_before = amount AND (n_before = 0 OR origin_before <> original_total_amount)
    THEN CAST(final_total_amount - split_before AS DECIMAL(18,2))
  WHEN original_total_amount - origin_before = amount THEN CAST(0 AS DECIMAL(18,2))
  ELSE share0 END AS final_detail_amount
FROM split_sums"""),
    ("start_log", """
SELECT epoch_us(ts) // 1000 AS ts, event_id, 'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
       'ar_' || CAST(user_id % 10 AS VARCHAR) AS ar, event_type AS ch, 'v1.' || CAST(user_id % 3 AS VARCHAR) AS vc,
       CAST(ts AS DATE) AS dt, hour(ts) AS hr
FROM events"""),
    ("dau_docs", """
SELECT mid, uid, ar, ch, vc, strftime(dt, '%Y-%m-%d') AS dt, CAST(hr AS VARCHAR) AS hr, '00' AS mi, ts
FROM (SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn FROM start_log)
WHERE rn = 1"""),
]

_BODIES = dict(CTES)
_ORDER = [n for n, _ in CTES]


def _refs(text: str) -> set[str]:
    return {n for n in _ORDER if re.search(rf"\b{n}\b", text)}


def sql(final: str) -> str:
    """``WITH`` the CTEs ``final`` needs (transitively), then ``final``."""
    need: set[str] = set()
    todo = list(_refs(final))
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        todo.extend(_refs(_BODIES[n]) - need)
    parts = [f"{n} AS ({_BODIES[n].strip()})" for n in _ORDER if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


def money_out(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def round_cents_sql(expr: str) -> str:
    return f"CAST(floor(CAST({expr} AS DOUBLE) * {_D} + {_HALF}) / {_D} AS DECIMAL(18,2))"
