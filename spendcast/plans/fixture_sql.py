"""DuckDB text of the ``transactions`` fixture view, used by the oracle SQL.

Same rows as :func:`spendcast.sources.transactions.fixture_transactions`.
"""

from __future__ import annotations

_COUNTRY_CASE = """CASE n_nationkey WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'Germany' WHEN 2 THEN 'France' WHEN 3 THEN 'EIRE' WHEN 4 THEN 'Spain'
    WHEN 5 THEN 'Netherlands' WHEN 6 THEN 'Belgium' WHEN 7 THEN 'Switzerland' WHEN 8 THEN 'Portugal' WHEN 9 THEN 'Australia'
    WHEN 10 THEN 'Norway' WHEN 11 THEN 'Italy' WHEN 12 THEN 'Channel Islands' WHEN 13 THEN 'Finland' WHEN 14 THEN 'Cyprus'
    WHEN 15 THEN 'Sweden' WHEN 16 THEN 'Austria' WHEN 17 THEN 'Denmark' WHEN 18 THEN 'Japan' WHEN 19 THEN 'Poland'
    WHEN 20 THEN 'USA' WHEN 21 THEN 'Israel' WHEN 22 THEN 'Unspecified' WHEN 23 THEN 'Singapore' ELSE n_name END"""


def transactions_sql(date_col: str = "o_orderdate") -> str:
    return f"""SELECT CONCAT(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, CAST(500000 + l_orderkey AS VARCHAR)) AS order_id,
  CASE WHEN o_custkey % 40 = 7 THEN CASE WHEN l_linenumber % 2 = 1 THEN 'ADJUST' ELSE 'M' END
       WHEN p_partkey % 31 = 0 THEN 'POST'
       WHEN p_partkey % 37 = 0 THEN 'C2'
       WHEN p_partkey % 41 = 0 THEN 'BANK CHARGES'
       WHEN p_partkey % 43 = 0 THEN 'TEST001'
       ELSE CONCAT(CAST(10000 + p_partkey AS VARCHAR), CASE WHEN p_size % 3 = 0 THEN 'A' WHEN p_size % 7 = 0 THEN 'BL' ELSE '' END) END AS product_id,
  p_name AS description,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
  CAST({date_col} AS TIMESTAMP) AS order_date,
  CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  o_custkey AS customer_id,
  {_COUNTRY_CASE} AS country,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS DECIMAL(18,2)) AS total,
  CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_discount, l_tax, l_quantity, l_returnflag, l_linestatus) AS INTEGER) AS line_seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""


def with_tx(body: str, ctes: str = "", date_col: str = "o_orderdate") -> str:
    """Prefix a query with the ``transactions`` CTE (and optional extra CTEs)."""
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH transactions AS (\n{transactions_sql(date_col)}\n){extra}\n{body}"
