"""SQL side of the store-shaped views."""

from tidegrain.plans.registry import view

view("v_customer", """
SELECT c_custkey AS customer_id, split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name,
  n_name AS country, CAST(n_regionkey AS BIGINT) AS region_id, nullif(c_mktsegment,'BUILDING') AS state,
  CASE WHEN c_custkey % 6 = 0 THEN c_name END AS company,
  lower(replace(c_name,'#','.')) || '@' || CASE c_custkey % 4 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com'
     ELSE lower(c_mktsegment) || '.com' END AS email,
  '(' || lpad(CAST(c_custkey % 1000 AS VARCHAR),3,'0') || ') 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR),4,'0') AS phone,
  CASE WHEN c_custkey % 3 = 0 THEN 'fax-' || CAST(c_custkey AS VARCHAR) END AS fax,
  c_custkey % 10 AS support_rep_id
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
view("v_invoice", """
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_orderdate AS invoice_date,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders""")
view("v_line", """
SELECT l_orderkey AS invoice_id, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS track_id, l_suppkey AS artist_id,
  CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total FROM lineitem""")
view("v_track", """
SELECT p_partkey AS track_id, p_name AS name, p_type AS genre, p_brand AS media_type,
  p_brand || '/' || CAST(p_size AS VARCHAR) AS album,
  CAST(p_size AS BIGINT) * 12000 + (p_partkey % 60) * 1000 AS milliseconds, CAST(p_size AS BIGINT) * 200000 AS bytes,
  CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS composer
FROM part""")
view("v_employee", """
SELECT s_suppkey AS employee_id, s_name AS name,
  CASE WHEN s_suppkey = 0 THEN NULL ELSE CAST(floor((s_suppkey - 1) / 3) AS BIGINT) END AS reports_to,
  make_date(CAST(1992 + s_suppkey % 30 AS BIGINT), CAST(1 + s_suppkey % 12 AS BIGINT), 1) AS hire_date,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name || '@x.com' END AS email, CAST(s_nationkey AS BIGINT) AS nation_id
FROM supplier""")
view("v_artist", """
SELECT employee_id, name FROM v_employee UNION ALL
SELECT -employee_id - 1, CASE WHEN employee_id % 2 = 1 THEN name || ' (new)' END FROM v_employee WHERE employee_id % 3 = 0""")
view("v_inv_country", """
SELECT i.*, c.country FROM v_invoice i JOIN v_customer c ON i.customer_id = c.customer_id""")
