"""SQL equivalents of the registered queries, for DuckDB over the given tables.

``VIEWS`` holds the sample source and its warehouse as SQL; a query's text gets the views it
uses, directly or not, as CTEs in front.
"""

from __future__ import annotations

import re

VIEWS = {
    "sectors": "SELECT CAST(n_nationkey AS BIGINT) AS sectorid, n_name AS sectorname FROM nation WHERE n_nationkey < 20",
    "accounts": """
SELECT c_custkey AS accountid, c_name AS accountname, CAST(c_nationkey AS BIGINT) AS sectorid,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST((CAST(c_acctbal AS DECIMAL(12,2)) + 1000) * 1200 AS DECIMAL(18,2)) END AS revenue,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey - c_custkey % 7 END AS parentaccountid,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INT) AS TIMESTAMP) AS updated_at FROM customer""",
    "productseries": """
SELECT DISTINCT CAST(p_size AS BIGINT) AS seriesid, concat('Series ', CAST(p_size AS STRING)) AS seriesname FROM part WHERE p_size <= 45""",
    "products": """
SELECT p_partkey AS productid, p_name AS productname, CAST(p_size AS BIGINT) AS seriesid,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) * p_size * 0.04 AS DECIMAL(18,2)) END AS salesprice,
  CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS INT) AS TIMESTAMP) AS updated_at FROM part""",
    "salesmanagers": "SELECT CAST(n_nationkey AS BIGINT) AS managerid, n_name AS managername FROM nation WHERE n_nationkey <> 3",
    "locations": "SELECT CAST(r_regionkey AS BIGINT) AS locationid, r_name AS locationname FROM region",
    "salesagents": """
SELECT s_suppkey AS salesagentid, s_name AS salesagentname, CAST(s_nationkey AS BIGINT) AS managerid, CAST(s_nationkey % 6 AS BIGINT) AS regionalofficeid,
  CAST(DATE '2024-01-01' + CAST(s_suppkey % 30 AS INT) AS TIMESTAMP) AS updated_at FROM supplier""",
    "dealstages": """
SELECT CAST(dealstageid AS BIGINT) AS dealstageid, stagename
FROM (VALUES (1,'Prospecting'),(2,'Engaging'),(3,'Lost'),(4,'Won'),(5,'On Hold')) AS t(dealstageid, stagename)""",
    "stagelines": """
SELECT l.*, CAST(CASE WHEN l_quantity = 50 THEN 9 WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 4 WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 3
       WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 5 END AS BIGINT) AS dealstageid FROM lineitem l""",
    "salespipeline": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS opportunityid,
  CASE WHEN l_partkey % 101 = 5 THEN NULL ELSE l_suppkey END AS salesagentid,
  CASE WHEN l_partkey % 103 = 5 THEN l_partkey + 1000000 ELSE l_partkey END AS productid,
  o_custkey AS accountid, dealstageid,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN NULL ELSE CAST(LEAST(o_orderdate, l_shipdate) AS DATE) END AS engagedate,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(GREATEST(o_orderdate, l_shipdate) AS DATE) END AS closedate,
  CASE WHEN l_linestatus = 'O' AND l_quantity < 10 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS closevalue,
  CAST(l_shipdate AS TIMESTAMP) AS updated_at
FROM stagelines JOIN orders ON l_orderkey = o_orderkey""",
    # Edges of the bands, to the cent, and rates of the stages; a stage without one has 10.
    "revenuebands": """
SELECT * FROM (VALUES ('Under 1M', -1e15, 999999.99), ('1M-10M', 1000000, 10000000), ('Over 10M', 10000000.01, 1e15)) AS t(label, low, high)""",
    "pricebands": """
SELECT * FROM (VALUES ('Low', -1e15, 99.99), ('Medium', 100, 1000), ('High', 1000.01, 1e15)) AS t(label, low, high)""",
    "stagerates": "SELECT * FROM (VALUES ('Won', 100), ('Lost', 0), ('Engaging', 75), ('Prospecting', 25)) AS t(stagename, rate)",
    "dimaccount": """
SELECT accountid, accountname, (SELECT max(sectorname) FROM sectors x WHERE x.sectorid = accounts.sectorid) AS sector,
  coalesce((SELECT max(label) FROM revenuebands b WHERE accounts.revenue BETWEEN b.low AND b.high), 'Unknown') AS revenuerange, parentaccountid FROM accounts""",
    "productrows": """
SELECT productid, productname, (SELECT max(seriesname) FROM productseries x WHERE x.seriesid = products.seriesid) AS seriesname, salesprice AS price,
  coalesce((SELECT max(label) FROM pricebands b WHERE products.salesprice BETWEEN b.low AND b.high), 'Unknown') AS pricerange, updated_at FROM products""",
    "dimproduct": """
SELECT CAST(row_number() OVER (ORDER BY productid) AS BIGINT) AS productsk, productid, productname, seriesname, price, pricerange,
  DATE '1900-01-01' AS validfrom, CAST(NULL AS DATE) AS validto, TRUE AS iscurrent FROM productrows""",
    "dimsalesagent": """
SELECT salesagentid, salesagentname, (SELECT max(managername) FROM salesmanagers x WHERE x.managerid = salesagents.managerid) AS managername,
  (SELECT max(locationname) FROM locations x WHERE x.locationid = salesagents.regionalofficeid) AS region FROM salesagents""",
    "dimdealstage": "SELECT dealstageid AS stageid, stagename FROM dealstages",
    "dimdate": """
SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS datekey, CAST(d AS DATE) AS date, CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year
 FROM (SELECT unnest(generate_series(make_date(year(lo),1,1), make_date(year(hi),12,31), INTERVAL 1 DAY)) d FROM (SELECT min(least(engagedate, closedate)) lo, max(coalesce(closedate, engagedate)) hi FROM salespipeline))""",
    "factsource": """
SELECT dated.* EXCLUDE (known), CAST(CASE WHEN known = 2 THEN datediff('day', engagedate, closedate) END AS INT) AS durationdays,
  CAST(coalesce((SELECT max(rate) FROM stagerates r JOIN dealstages x USING (stagename) WHERE x.dealstageid = dated.dealstageid), 10) AS DOUBLE) AS expectedsuccessrate,
  greatest(closedate, CASE WHEN closedate IS NULL THEN engagedate END) AS eventdate
FROM (SELECT *, CAST(closedate IS NOT NULL AS INT) + CAST(engagedate IS NOT NULL AS INT) AS known FROM salespipeline) dated
WHERE known > 0 AND NOT (accountid IS NULL OR productid IS NULL OR salesagentid IS NULL OR dealstageid IS NULL)""",
    "factresolved": """
SELECT f.opportunityid, d.datekey, a.accountid AS accountkey, p.productsk AS productkey, g.salesagentid AS salesagentkey, st.stageid AS dealstagekey,
  f.closevalue, f.durationdays, f.expectedsuccessrate, f.updated_at, f.productid
  FROM factsource f JOIN dimdate d ON f.eventdate = d.date JOIN dimaccount a ON f.accountid = a.accountid
  JOIN dimproduct p ON f.productid = p.productid AND p.iscurrent JOIN dimsalesagent g ON f.salesagentid = g.salesagentid JOIN dimdealstage st ON f.dealstageid = st.stageid""",
    "factrejects": """
SELECT f.opportunityid, f.productid, f.dealstageid, d.datekey IS NULL AS missing_date, a.accountid IS NULL AS missing_account, p.productsk IS NULL AS missing_product,
  g.salesagentid IS NULL AS missing_agent, st.stageid IS NULL AS missing_stage
  FROM factsource f LEFT JOIN dimdate d ON f.eventdate = d.date LEFT JOIN dimaccount a ON f.accountid = a.accountid LEFT JOIN dimproduct p ON f.productid = p.productid AND p.iscurrent
  LEFT JOIN dimsalesagent g ON f.salesagentid = g.salesagentid LEFT JOIN dimdealstage st ON f.dealstageid = st.stageid
  WHERE d.datekey IS NULL OR a.accountid IS NULL OR p.productsk IS NULL OR g.salesagentid IS NULL OR st.stageid IS NULL""",
    "factsalesperformance": """
SELECT opportunityid, datekey, accountkey, productkey, salesagentkey, dealstagekey, closevalue, durationdays, expectedsuccessrate FROM (
  SELECT r.*, row_number() OVER (PARTITION BY opportunityid ORDER BY {first}) rn FROM factresolved r) WHERE rn = 1""",
    "monthly": """
SELECT CAST(datekey // 10000 AS INT) AS year, CAST(datekey // 100 % 100 AS INT) AS month, region, dealstagekey, {measures}
  FROM (SELECT *, coalesce((SELECT max(x.region) FROM dimsalesagent x WHERE x.salesagentid = salesagentkey), 'Unknown') AS region FROM factsalesperformance) f
  GROUP BY ALL""",
    "productchanges": """
SELECT productid, CASE WHEN productid % 10 = 0 THEN concat(productname,' (v2)') ELSE productname END AS productname, seriesname,
  price, pricerange FROM dimproduct WHERE productid % 10 IN (0,1)
  UNION ALL SELECT productid + 5000000, productname, seriesname, price, pricerange FROM dimproduct WHERE productid % 100 = 2""",
    "scd2_changes": """
SELECT c.*, t.productid IS NOT NULL AS had_current FROM productchanges c LEFT JOIN dimproduct t ON c.productid = t.productid AND t.iscurrent
  WHERE t.productid IS NULL OR c.productname IS DISTINCT FROM t.productname OR c.seriesname IS DISTINCT FROM t.seriesname OR c.price IS DISTINCT FROM t.price OR c.pricerange IS DISTINCT FROM t.pricerange""",
    "scd2_applied": """
SELECT t.productsk, t.productid, t.productname, t.seriesname, t.price, t.pricerange, t.validfrom,
  CASE WHEN t.iscurrent AND c.productid IS NOT NULL THEN DATE '1998-12-21' ELSE t.validto END AS validto, t.iscurrent AND c.productid IS NULL AS iscurrent
  FROM dimproduct t LEFT JOIN scd2_changes c ON t.productid = c.productid
  UNION ALL SELECT CAST((SELECT max(productsk) FROM dimproduct) + row_number() OVER (ORDER BY productid) AS BIGINT), productid, productname, seriesname, price, pricerange,
    DATE '1998-12-22', CAST(NULL AS DATE), TRUE FROM scd2_changes""",
    "accountchanges": """
SELECT accountid, concat(accountname, ' (renamed)') AS accountname, CAST(NULL AS STRING) AS sector, revenuerange, parentaccountid FROM dimaccount WHERE accountid % 9 = 0
  UNION ALL SELECT accountid + 900000, accountname, sector, revenuerange, parentaccountid FROM dimaccount WHERE accountid % 50 = 3""",
    "window_resolved": """
SELECT * FROM factresolved WHERE updated_at > TIMESTAMP '1999-01-01 00:00:00' OR updated_at IS NULL""",
    "earlier_facts": """
SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY opportunityid ORDER BY {first}) rn FROM factresolved r
  WHERE updated_at <= TIMESTAMP '1999-01-01 00:00:00') WHERE rn = 1""",
    "changelog": """
SELECT user_id AS accountid, event_id AS seq, ts AS changed_at,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, CAST(value AS DECIMAL(18,2)) AS balance FROM events""",
    "latest_change": """
SELECT accountid, op, balance FROM (SELECT l.*, row_number() OVER (PARTITION BY accountid ORDER BY changed_at DESC, seq DESC) AS rn FROM changelog l) x WHERE rn = 1""",
    "balances": "SELECT c_custkey AS accountid, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer",
    # The pipeline as a change log: stage 3 deletes, everything else is set to stage 4.
    "last_rows": """
SELECT * FROM (SELECT s.*, CASE WHEN dealstageid = 3 THEN 'D' ELSE 'U' END AS op, row_number() OVER (PARTITION BY opportunityid ORDER BY updated_at DESC NULLS LAST,
  productid DESC NULLS LAST, salesagentid DESC NULLS LAST, accountid DESC NULLS LAST, closevalue DESC NULLS LAST, engagedate DESC NULLS LAST, closedate DESC NULLS LAST,
  CASE WHEN dealstageid = 3 THEN 'D' ELSE 'U' END DESC) AS rn FROM salespipeline s) WHERE rn = 1""",
    "won_rows": """
SELECT f.opportunityid, d.datekey, a.accountid AS accountkey, p.productsk AS productkey, g.salesagentid AS salesagentkey, CAST(4 AS BIGINT) AS dealstagekey, f.closevalue,
  CAST(date_diff('day', engagedate, closedate) AS INT) AS durationdays, CAST(100.0 AS DOUBLE) AS expectedsuccessrate
  FROM last_rows f JOIN dimdate d ON coalesce(f.closedate, f.engagedate) = d.date JOIN dimaccount a ON f.accountid = a.accountid
  JOIN dimproduct p ON f.productid = p.productid JOIN dimsalesagent g ON f.salesagentid = g.salesagentid WHERE f.op = 'U'""",
    # Two-run warehouse: a snapshot, then everything.
    "products1": "SELECT row_number() OVER (ORDER BY productid) AS productsk, productid FROM products WHERE updated_at <= TIMESTAMP '2024-01-15 00:00:00'",
    "changed2": """
SELECT (SELECT count(*) FROM products1) + row_number() OVER (ORDER BY p.productid) AS productsk, p.productid, q.productid IS NULL AS is_new
  FROM products p LEFT JOIN products1 q ON p.productid = q.productid WHERE q.productid IS NULL OR p.productid % 10 = 0""",
    "version_at_event": "SELECT productsk, productid FROM products1 UNION ALL SELECT productsk, productid FROM changed2 WHERE is_new",
    "resolved2": """
SELECT f.opportunityid, f.datekey, f.accountkey, CAST(v.productsk AS BIGINT) AS productkey, f.salesagentkey, f.dealstagekey, f.closevalue, f.durationdays,
  f.expectedsuccessrate, f.updated_at, f.productid FROM factresolved f JOIN version_at_event v ON f.productid = v.productid""",
    "run1": """
SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY opportunityid ORDER BY {first}) rn FROM resolved2 r
  WHERE r.updated_at <= TIMESTAMP '1999-01-01 00:00:00' AND r.productid IN (SELECT productid FROM products1)
    AND r.accountkey IN (SELECT accountid FROM accounts WHERE updated_at <= TIMESTAMP '2024-01-15 00:00:00')) WHERE rn = 1""",
    "run2": """
SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY opportunityid ORDER BY {first}) rn FROM resolved2 r
  WHERE r.opportunityid NOT IN (SELECT opportunityid FROM run1)) WHERE rn = 1""",
    # A snapshot, then a run that brings only late accounts and products.
    "late_versions": """
SELECT productsk, productid FROM products1 UNION ALL
SELECT (SELECT count(*) FROM products1) + row_number() OVER (ORDER BY productid), productid FROM products WHERE productid NOT IN (SELECT productid FROM products1)""",
    "snapshot_rows": """
SELECT f.opportunityid, f.datekey, f.accountkey, CAST(v.productsk AS BIGINT) AS productkey, f.salesagentkey, f.dealstagekey, f.closevalue, f.durationdays, f.expectedsuccessrate, f.updated_at,
  f.productid IN (SELECT productid FROM products1) AND f.accountkey IN (SELECT accountid FROM accounts WHERE updated_at <= TIMESTAMP '2024-01-15 00:00:00') AS early
  FROM factresolved f JOIN late_versions v ON f.productid = v.productid WHERE f.updated_at <= TIMESTAMP '1999-01-01 00:00:00'""",
    "incremental_facts": "SELECT {fact} FROM run1 UNION ALL SELECT {fact} FROM run2",
}

FRAGMENTS = {
    "{first}": "updated_at, productkey, salesagentkey, datekey, closevalue NULLS LAST, dealstagekey, durationdays NULLS LAST, accountkey, expectedsuccessrate",
    "{fact}": "opportunityid, datekey, accountkey, productkey, salesagentkey, dealstagekey, closevalue, durationdays, expectedsuccessrate",
    "{measures}": """count(*) AS totaldealcount,
  CAST(sum(f.closevalue) AS DOUBLE) AS totalclosevalue, CAST(sum(f.closevalue) AS DOUBLE)/nullif(count(f.closevalue),0) AS avgdealvalue,
  CAST(sum(f.durationdays) AS DOUBLE)/nullif(count(f.durationdays),0) AS avgdurationdays, avg(f.expectedsuccessrate) AS expectedsuccessrate""",
}


def _count(table: str, check: str, source: str, test: str) -> str:
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS violations FROM {source}")


_VERSION_TESTS = (
    ("newest_is_current", "rnk = 1 AND NOT cur"),
    ("older_is_closed", "rnk > 1 AND cur"),
    ("older_has_end", "rnk > 1 AND vt IS NULL"),
    ("versions_overlap", "nf IS NOT NULL AND vt >= nf"),
    ("versions_gap", "nf IS NOT NULL AND vt + 1 < nf"),
    ("ends_before_start", "vt < vf"),
)
_ORDER_VERSIONS = """(SELECT x.*, row_number() OVER (PARTITION BY k ORDER BY vf DESC, cur DESC) AS rnk, lead(vf) OVER (PARTITION BY k ORDER BY vf, cur) AS nf FROM (
  SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS vf, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS vt, o_orderstatus = 'O' AS cur FROM orders) x)"""

QUERIES = {
    "dim_account": "SELECT * FROM dimaccount",
    "dim_product_initial": "SELECT * FROM dimproduct",
    "dim_sales_agent": "SELECT * FROM dimsalesagent",
    "dim_deal_stage": """
SELECT s.dealstageid AS stageid, CASE WHEN m.last_seen < TIMESTAMP '1998-01-01 00:00:00' THEN upper(s.stagename) ELSE s.stagename END AS stagename
  FROM dealstages s JOIN (SELECT dealstageid, max(l_shipdate) AS last_seen FROM stagelines GROUP BY dealstageid) m ON s.dealstageid = m.dealstageid""",
    "dim_date": "SELECT * FROM dimdate",
    "fact_source": "SELECT * FROM factsource",
    "fact_resolved": "SELECT {fact} FROM factresolved",
    "fact_rejects": "SELECT * FROM factrejects",
    "fact_initial": "SELECT {fact} FROM factsalesperformance",
    "monthly_aggregate": "SELECT * FROM monthly",
    "scd2_changes": "SELECT * FROM scd2_changes",
    "scd2_apply": "SELECT * FROM scd2_applied",
    "asof_half_open": """
SELECT f.opportunityid, f.productid, f.eventdate, p.productsk AS productkey FROM factsource f JOIN scd2_applied p
  ON p.productid = f.productid AND f.eventdate >= p.validfrom AND (f.eventdate < p.validto OR p.validto IS NULL)""",
    "asof_closed": """
SELECT f.opportunityid, f.productid, f.eventdate, p.productsk AS productkey FROM factsource f JOIN scd2_applied p
  ON p.productid = f.productid AND f.eventdate >= p.validfrom AND (f.eventdate <= p.validto OR p.validto IS NULL)""",
    "fact_resolved_as_of": """
SELECT f.opportunityid, d.datekey, a.accountid AS accountkey, p.productid AS productkey, g.salesagentid AS salesagentkey, st.stageid AS dealstagekey,
  f.closevalue, f.durationdays, f.expectedsuccessrate
  FROM factsource f JOIN dimdate d ON f.eventdate = d.date JOIN dimaccount a ON f.accountid = a.accountid
  JOIN scd2_applied p ON f.productid = p.productid AND f.eventdate >= p.validfrom AND (f.eventdate < p.validto OR p.validto IS NULL)
  JOIN dimsalesagent g ON f.salesagentid = g.salesagentid JOIN dimdealstage st ON f.dealstageid = st.stageid""",
    "change_window": """
SELECT * FROM salespipeline WHERE updated_at > TIMESTAMP '1999-01-01 00:00:00' AND updated_at <= TIMESTAMP '2000-01-01 00:00:00'""",
    "scd1_upsert_account": """
SELECT t.accountid, t.accountname, t.sector, t.revenuerange, t.parentaccountid FROM dimaccount t WHERE NOT EXISTS (SELECT 1 FROM accountchanges c WHERE c.accountid = t.accountid)
  UNION ALL SELECT accountid, accountname, sector, revenuerange, parentaccountid FROM accountchanges""",
    "insert_if_absent_account": """
SELECT accountid, accountname, sector, revenuerange, parentaccountid FROM accountchanges c WHERE NOT EXISTS (SELECT 1 FROM dimaccount t WHERE t.accountid = c.accountid)""",
    "fact_insert_only": "SELECT {fact} FROM earlier_facts UNION ALL SELECT {fact} FROM window_resolved",
    "fact_insert_if_absent": """
SELECT {fact} FROM earlier_facts UNION ALL SELECT {fact} FROM (
  SELECT w.*, row_number() OVER (PARTITION BY opportunityid ORDER BY {first}) rn FROM window_resolved w
  WHERE NOT EXISTS (SELECT 1 FROM earlier_facts e WHERE e.opportunityid = w.opportunityid)) WHERE rn = 1""",
    "fact_upsert": """
SELECT {fact} FROM earlier_facts e WHERE NOT EXISTS (SELECT 1 FROM window_resolved w WHERE w.opportunityid = e.opportunityid)
  UNION ALL SELECT {fact} FROM (SELECT w.*, row_number() OVER (PARTITION BY opportunityid ORDER BY updated_at DESC NULLS LAST, productkey, salesagentkey, datekey,
    closevalue NULLS LAST, dealstagekey, durationdays NULLS LAST, accountkey, expectedsuccessrate) rn FROM window_resolved w) WHERE rn = 1""",
    "apply_changes": """
SELECT b.accountid, b.balance FROM balances b WHERE NOT EXISTS (SELECT 1 FROM latest_change l WHERE l.accountid = b.accountid)
  UNION ALL SELECT accountid, balance FROM latest_change WHERE op <> 'D'""",
    "update_by_key": """
SELECT b.accountid, CASE WHEN l.accountid IS NOT NULL THEN l.balance ELSE b.balance END AS balance FROM balances b LEFT JOIN latest_change l ON b.accountid = l.accountid""",
    "delete_by_key": """
SELECT b.accountid, b.balance FROM balances b WHERE b.accountid NOT IN (SELECT accountid FROM changelog WHERE op = 'D')""",
    "last_processed": "SELECT max(changed_at) AS changed_at, max_by(seq, (changed_at, seq)) AS seq FROM changelog",
    "validate": """
SELECT 'one_current_version' AS check_name, 'dimproduct' AS table_name, count(*) AS violations FROM (SELECT productid FROM scd2_applied GROUP BY productid HAVING sum(CASE WHEN iscurrent THEN 1 ELSE 0 END) <> 1) x
  UNION ALL SELECT 'fact_key_unique', 'factresolved', count(*) FROM (SELECT opportunityid FROM factresolved GROUP BY opportunityid HAVING count(*) > 1) y
  UNION ALL SELECT 'orphan_parent', 'dimaccount', count(*) FROM dimaccount c LEFT JOIN dimaccount p ON c.parentaccountid = p.accountid WHERE c.parentaccountid IS NOT NULL AND p.accountid IS NULL
  UNION ALL SELECT 'orphan_product', 'salespipeline', count(*) FROM salespipeline s WHERE s.productid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM products p WHERE p.productid = s.productid)
  UNION ALL SELECT 'null_key', 'salespipeline', count(*) FROM salespipeline WHERE salesagentid IS NULL OR productid IS NULL
  UNION ALL SELECT 'aggregate_total', 'factsalesmonthlyaggregate', CAST(abs((SELECT sum(totaldealcount) FROM monthly) - (SELECT count(*) FROM factsalesperformance)) AS BIGINT)""",
    "version_checks": " UNION ALL ".join(
        _count("orders", check, _ORDER_VERSIONS, test)
        for check, test in _VERSION_TESTS
    ),
    "source_checks": " UNION ALL ".join(
        _count(table, check, table, test)
        for table, check, test in (
            ("accounts", "account_without_revenue", "revenue IS NULL"),
            ("accounts", "negative_revenue", "revenue < 0"),
            ("products", "product_without_price", "salesprice IS NULL"),
            ("products", "negative_price", "salesprice < 0"),
            ("salespipeline", "missing_key", "accountid IS NULL OR productid IS NULL OR salesagentid IS NULL OR dealstageid IS NULL"),
            ("salespipeline", "missing_event_date", "closedate IS NULL AND engagedate IS NULL"),
            ("salespipeline", "closed_before_engaged", "closedate < engagedate"),
            ("salespipeline", "missing_value", "closevalue IS NULL"),
        )
    ),
    "aggregate_by_quarter": """
SELECT d.year, d.quarter, f.dealstagekey, {measures} FROM factsalesperformance f JOIN dimdate d ON f.datekey = d.datekey GROUP BY d.year, d.quarter, f.dealstagekey""",
    "aggregate_by_product": """
SELECT p.seriesname, p.pricerange, d.year, {measures} FROM factsalesperformance f JOIN dimproduct p ON f.productkey = p.productsk JOIN dimdate d ON f.datekey = d.datekey
  GROUP BY p.seriesname, p.pricerange, d.year""",
    "aggregate_by_account": """
SELECT a.sector, a.revenuerange, {measures} FROM factsalesperformance f JOIN dimaccount a ON f.accountkey = a.accountid GROUP BY a.sector, a.revenuerange""",
    "page": "SELECT * FROM dimaccount ORDER BY accountid LIMIT 100 OFFSET 200",
    "key_ranges": "SELECT * FROM accounts",
    "product_history_json": """
SELECT productid, CAST(row_number() OVER (PARTITION BY productid ORDER BY validfrom DESC, iscurrent DESC) AS INT) AS version_rank,
  concat('{"productid":', CAST(productid AS STRING), ',"productname":"', productname, '","price":', CASE WHEN price IS NULL THEN 'null' ELSE concat('"', CAST(price AS STRING), '"') END,
    ',"validfrom":"', CAST(validfrom AS STRING), '","validto":', CASE WHEN validto IS NULL THEN 'null' ELSE concat('"', CAST(validto AS STRING), '"') END,
    ',"iscurrent":', CASE WHEN iscurrent THEN 'true' ELSE 'false' END, '}') AS version_json
  FROM scd2_applied""",
    "text_suffix": """
SELECT productid, concat(replace(CASE WHEN productid % 3 = 0 THEN concat(productname, ' (Updated Scenario 2)') ELSE productname END, ' (Updated Scenario 2)', ''), ' (Updated Scenario 2)') AS productname,
  CAST(salesprice * 1.1 AS DECIMAL(18,2)) AS salesprice, concat('TEST_S1_', right(productname, 8)) AS opportunityid FROM products""",
    "archive_split": "SELECT opportunityid, datekey, CASE WHEN datekey < 19980101 THEN 'archived' ELSE 'kept' END AS part FROM factsalesperformance",
    "load_counters": """
SELECT (SELECT count(*) FROM salespipeline) AS rows_read, (SELECT count(*) FROM factsource) AS rows_shaped, (SELECT count(*) FROM factresolved) AS rows_resolved,
  (SELECT count(*) FROM factrejects) AS rows_skipped""",
    "high_water_marks": """
SELECT user_id, max(CASE event_type WHEN 'error' THEN TIMESTAMP '1970-01-01 00:00:00' WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
  ELSE date_trunc('second', ts) END) AS mark FROM events GROUP BY user_id""",
    "parse_event_date": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS eventdate, o_orderstatus = 'P' AS missing_date FROM orders""",
    "fact_probe": """
SELECT count(*) AS matches FROM factsalesperformance f WHERE f.productkey = (SELECT productsk FROM dimproduct WHERE productid = 3 AND iscurrent) AND f.dealstagekey = 4""",
    "replay_rejects": """
SELECT {fact} FROM factresolved WHERE productid IN (SELECT productid FROM products WHERE updated_at > TIMESTAMP '2024-01-15 00:00:00')""",
    "initial_load": """
SELECT f.opportunityid, f.datekey, f.accountkey, f.productkey, f.salesagentkey, f.dealstagekey, f.closevalue, f.durationdays, f.expectedsuccessrate, d.year, d.month
  FROM factsalesperformance f JOIN dimdate d ON f.datekey = d.datekey""",
    "refresh_monthly": "SELECT * FROM monthly",
    "load_metadata": """
SELECT t AS table_name, CASE WHEN t = 'factsalesperformance' THEN (SELECT count(*) FROM salespipeline) END AS rows_read, n AS rows_written,
  CASE WHEN t = 'factsalesperformance' THEN (SELECT count(*) FROM factrejects) END AS rows_rejected,
  CASE WHEN t = 'factsalesperformance' THEN (SELECT count(*) FROM salespipeline) - (SELECT count(*) FROM factsource) || ' rows without a key or date' END AS message
FROM (SELECT 'dimdate' AS t, (SELECT count(*) FROM dimdate) AS n UNION ALL SELECT 'dimaccount', (SELECT count(*) FROM dimaccount)
  UNION ALL SELECT 'dimproduct', (SELECT count(*) FROM dimproduct) UNION ALL SELECT 'dimsalesagent', (SELECT count(*) FROM dimsalesagent)
  UNION ALL SELECT 'dimdealstage', (SELECT count(*) FROM dimdealstage) UNION ALL SELECT 'factsalesperformance', (SELECT count(*) FROM factsalesperformance)
  UNION ALL SELECT 'factrejects', (SELECT count(*) FROM factrejects)
  UNION ALL SELECT 'factsarchive', 0
  UNION ALL SELECT 'factsalesmonthlyaggregate', (SELECT count(*) FROM monthly))""",
    "incremental_load": "SELECT {fact} FROM incremental_facts",
    "monthly_touched": """
SELECT d.year, d.month, coalesce(sa.region,'Unknown') AS region, f.dealstagekey, {measures}
  FROM incremental_facts f JOIN dimdate d ON f.datekey = d.datekey JOIN dimsalesagent sa ON f.salesagentkey = sa.salesagentid
  GROUP BY d.year, d.month, coalesce(sa.region,'Unknown'), f.dealstagekey""",
    "incremental_products": """
SELECT CAST(q.productsk AS BIGINT) AS productsk, r.productid, r.productname, r.seriesname, r.price, r.pricerange, DATE '1900-01-01' AS validfrom,
    CASE WHEN r.productid % 10 = 0 THEN DATE '2024-01-31' END AS validto, r.productid % 10 <> 0 AS iscurrent FROM products1 q JOIN productrows r ON q.productid = r.productid
  UNION ALL SELECT CAST(c.productsk AS BIGINT), r.productid, CASE WHEN r.productid % 10 = 0 THEN concat(r.productname, ' (v2)') ELSE r.productname END, r.seriesname, r.price, r.pricerange,
    CASE WHEN c.is_new THEN DATE '1900-01-01' ELSE DATE '2024-02-01' END, CAST(NULL AS DATE), TRUE FROM changed2 c JOIN productrows r ON c.productid = r.productid""",
    "stream_incremental": "SELECT {fact} FROM factsalesperformance",
    "stream_second_checkpoint": "SELECT {fact} FROM factsalesperformance",
    "offset_run_ts": "SELECT {fact} FROM incremental_facts",
    "compacted_facts": "SELECT {fact} FROM incremental_facts",
    "archive_then_incremental": "SELECT opportunityid, datekey, CASE WHEN datekey < 19980101 THEN 'archived' ELSE 'kept' END AS part FROM factsalesperformance",
    "changelog_dimensions": """
SELECT salesagentid, CASE WHEN salesagentid % 5 = 1 THEN salesagentname ELSE concat(salesagentname, ' (log)') END AS salesagentname, managername, region
  FROM dimsalesagent WHERE salesagentid % 5 <> 0""",
    "dim_date_default": """
SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS datekey, CAST(d AS DATE) AS date, CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
  (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = CAST(d AS DATE)) AS events
 FROM (SELECT unnest(generate_series(DATE '2015-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) d)""",
    "load_checks": """
SELECT 'fact_key_unique' AS check_name, 'factsalesperformance' AS table_name, count(*) AS violations FROM (SELECT 1 FROM factsalesperformance GROUP BY opportunityid HAVING count(*) > 1) x
  UNION ALL SELECT 'fact_null_key', 'factsalesperformance', count(*) FROM factsalesperformance WHERE opportunityid IS NULL OR datekey IS NULL OR accountkey IS NULL OR productkey IS NULL OR salesagentkey IS NULL OR dealstagekey IS NULL
  UNION ALL SELECT 'orphan_date', 'factsalesperformance', count(*) FROM factsalesperformance WHERE datekey NOT IN (SELECT datekey FROM dimdate)
  UNION ALL SELECT 'orphan_account', 'factsalesperformance', count(*) FROM factsalesperformance WHERE accountkey NOT IN (SELECT accountid FROM accounts)
  UNION ALL SELECT 'orphan_product', 'factsalesperformance', count(*) FROM factsalesperformance WHERE productkey NOT IN (SELECT productsk FROM dimproduct)
  UNION ALL SELECT 'orphan_agent', 'factsalesperformance', count(*) FROM factsalesperformance WHERE salesagentkey NOT IN (SELECT salesagentid FROM salesagents)
  UNION ALL SELECT 'orphan_stage', 'factsalesperformance', count(*) FROM factsalesperformance WHERE dealstagekey NOT IN (SELECT dealstageid FROM dealstages)
  UNION ALL SELECT 'aggregate_total', 'factsalesmonthlyaggregate', CAST(abs((SELECT sum(totaldealcount) FROM monthly) - (SELECT count(*) FROM factsalesperformance)) AS BIGINT)
  UNION ALL SELECT 'account_key_unique', 'dimaccount', count(*) FROM (SELECT 1 FROM accounts GROUP BY accountid HAVING count(*) > 1) x
  UNION ALL SELECT 'agent_key_unique', 'dimsalesagent', count(*) FROM (SELECT 1 FROM salesagents GROUP BY salesagentid HAVING count(*) > 1) x
  UNION ALL SELECT 'stage_key_unique', 'dimdealstage', count(*) FROM (SELECT 1 FROM dealstages GROUP BY dealstageid HAVING count(*) > 1) x
  UNION ALL SELECT 'orphan_parent', 'dimaccount', count(*) FROM accounts WHERE parentaccountid NOT IN (SELECT accountid FROM accounts)""",
    "changelog_rejects": """
SELECT f.opportunityid, f.productid, CAST(4 AS BIGINT) AS dealstageid, d.datekey IS NULL AS missing_date, a.accountid IS NULL AS missing_account,
  p.productsk IS NULL OR coalesce(f.closedate, f.engagedate) IS NULL AS missing_product, g.salesagentid IS NULL AS missing_agent, false AS missing_stage
  FROM last_rows f LEFT JOIN dimdate d ON coalesce(f.closedate, f.engagedate) = d.date LEFT JOIN dimaccount a ON f.accountid = a.accountid
  LEFT JOIN dimproduct p ON f.productid = p.productid LEFT JOIN dimsalesagent g ON f.salesagentid = g.salesagentid
  WHERE f.op = 'U' AND (d.datekey IS NULL OR a.accountid IS NULL OR p.productsk IS NULL OR g.salesagentid IS NULL)""",
    "changelog_monthly": """
SELECT CAST(datekey // 10000 AS INT) AS year, CAST(datekey // 100 % 100 AS INT) AS month, coalesce(g.region, 'Unknown') AS region, f.dealstagekey, {measures}
  FROM won_rows f JOIN dimsalesagent g ON f.salesagentkey = g.salesagentid GROUP BY ALL""",
    "scd2_reinsert": """
SELECT f.opportunityid, f.productid, f.eventdate, CAST(v.productsk AS BIGINT) AS productkey FROM factsource f JOIN (
  SELECT productsk, productid, DATE '1900-01-01' AS lo, CASE WHEN productid % 7 = 0 THEN DATE '1996-12-31' ELSE DATE '9999-12-31' END AS hi FROM dimproduct
  UNION ALL SELECT (SELECT max(productsk) FROM dimproduct) + row_number() OVER (ORDER BY productid), productid, DATE '1999-01-01', DATE '9999-12-31' FROM dimproduct WHERE productid % 7 = 0) v
  ON v.productid = f.productid AND f.eventdate BETWEEN v.lo AND v.hi""",
    "rejects_replayed": """
SELECT {fact} FROM (SELECT r.*, row_number() OVER (PARTITION BY opportunityid ORDER BY early DESC, {first}) rn FROM snapshot_rows r) WHERE rn = 1""",
    "lineage": "SELECT opportunityid, 'full20240115T000000' AS batch FROM run1 UNION ALL SELECT opportunityid, '20240201T000000' FROM run2",
    "truncated": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'before' AS at, (SELECT count(*) FROM {t}) AS n UNION ALL SELECT '{t}', 'after', 0" for t in ("dimaccount", "dimproduct", "dimsalesagent", "dimdate")),
    "error_log": """
SELECT '20240201T000000' AS batch_id, concat('ValueError: bounds must be ', chr(39), 'closed', chr(39), ' or ', chr(39), 'half_open', chr(39), ', not ', chr(39), 'open', chr(39)) AS message,
  CAST(0 AS BIGINT) AS facts, CAST(0 AS BIGINT) AS accounts""",
    "stream_batches": "SELECT count(*) AS rows_read FROM salespipeline GROUP BY accountid % 2",
    "stream_dedup": """
SELECT DISTINCT {fact} FROM factresolved WHERE updated_at < TIMESTAMP '1999-01-01 00:00:00'
  UNION ALL SELECT * FROM (SELECT DISTINCT {fact} FROM factresolved WHERE updated_at >= TIMESTAMP '1998-01-01 00:00:00' AND updated_at < TIMESTAMP '1998-06-01 00:00:00')""",
    "archive_load": "SELECT opportunityid, datekey, CASE WHEN datekey < 19980101 THEN 'archived' ELSE 'kept' END AS part FROM factsalesperformance",
    "ranged_load": "SELECT * FROM dimaccount",
    "changelog_load": """
SELECT {fact} FROM factsalesperformance f WHERE opportunityid NOT IN (SELECT opportunityid FROM last_rows)
  UNION ALL SELECT {fact} FROM won_rows""",
}
#: However a change log is cut into runs, they end as one; so do both ways of trying rejects again.
QUERIES |= {name: QUERIES["changelog_load"] for name in ("changelog_ties", "changelog_cuts", "stream_changelog")}
QUERIES |= {"asof_merge_half_open": QUERIES["asof_half_open"], "asof_merge_closed": QUERIES["asof_closed"], "ranged_facts": QUERIES["initial_load"]}
QUERIES["asof_many_versions"] = """
SELECT f.opportunityid, f.productid % 7 AS productid, f.eventdate, v.productsk AS productkey FROM factsource f LEFT JOIN (
  SELECT *, lead(lo) OVER (PARTITION BY k ORDER BY lo) AS nxt, CASE WHEN productsk % 3 = 0 THEN lo + 4 END AS hi
  FROM (SELECT o_custkey % 5 AS k, CAST(o_orderdate AS DATE) AS lo, min(o_orderkey) AS productsk FROM orders GROUP BY ALL)) v
  ON v.k = f.productid % 7 AND f.eventdate >= v.lo AND (v.nxt IS NULL OR f.eventdate < v.nxt) AND (v.hi IS NULL OR f.eventdate <= v.hi)"""
QUERIES["rejects_replayed_all"] = QUERIES["rejects_replayed"]
QUERIES["load_checks"] += "".join(f"""
  UNION ALL SELECT '{check}', '{table}', count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING {test}) x""" for check, table, key, test in (
    ("date_key_unique", "dimdate", "datekey", "count(*) > 1"), ("product_key_unique", "dimproduct", "productsk", "count(*) > 1"),
    ("one_current_version", "dimproduct", "productid", "count(*) FILTER (WHERE iscurrent) <> 1")))
_DIM_VERSIONS = """(SELECT iscurrent AS cur, validfrom AS vf, validto AS vt, row_number() OVER (PARTITION BY productid ORDER BY validfrom DESC, iscurrent DESC) AS rnk,
  lead(validfrom) OVER (PARTITION BY productid ORDER BY validfrom, iscurrent) AS nf FROM dimproduct)"""
QUERIES["load_checks"] += "".join(f"""
  UNION ALL {_count('dimproduct', check, _DIM_VERSIONS, test)}""" for check, test in _VERSION_TESTS)

QUERIES["monthly_moved"] = QUERIES["monthly_touched"].replace("sa.region", "CASE WHEN sa.salesagentid % 3 = 0 THEN sa.region || ' (moved)' ELSE sa.region END")
QUERIES["incremental_checks"] = QUERIES["load_checks"]
for _table, _after in (("factsalesperformance", "incremental_facts"), ("monthly", f"({QUERIES['monthly_touched']}) monthly"), ("dimproduct", f"({QUERIES['incremental_products']}) dimproduct")):
    QUERIES["incremental_checks"] = QUERIES["incremental_checks"].replace(f"FROM {_table}", f"FROM {_after}")


def _fill(text: str) -> str:
    for name, value in FRAGMENTS.items():
        text = text.replace(name, value)
    return text


def _uses(text: str, seen: list[str]) -> list[str]:
    """Views a text needs, each after those it needs itself."""
    for name in VIEWS:
        if name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            _uses(VIEWS[name], seen)
            seen.append(name)
    return seen


def oracle(name: str) -> str:
    body = _fill(QUERIES[name]).strip()
    views = [f"{v} AS ({_fill(VIEWS[v]).strip()})" for v in _uses(QUERIES[name], [])]
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + body
