"""Rules, suites, profiles and gates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit import functions as fn
from etlkit import operators as op
from etlkit.operators import rules as r
from etlkit.plans import post_load_gate as gate
from workload.inputs import claims, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return keep


def _shown(result):
    return result.select("rule_id", "rule_type", "column", "category", "success", F.round("observed", 6).alias("observed"),
                         "element_count", "unexpected_count", F.round("unexpected_pct", 4).alias("unexpected_pct"))


def _sql_row(rule_id, rule_type, column, category, n, bad, source="t", mostly="1.0"):
    """A result row for a rule that counts elements; `n` and `bad` are SQL conditions."""
    column = f"'{column}'" if column else "NULL"
    return f"""SELECT '{rule_id}' AS rule_id, '{rule_type}' AS rule_type, {column} AS "column", '{category}' AS category,
 CAST(n - bad AS DOUBLE) >= n * CAST({mostly} AS DOUBLE) AS success, round(CAST(n - bad AS DOUBLE) / n, 6) AS observed,
 n AS element_count, bad AS unexpected_count, round(100 * CAST(bad AS DOUBLE) / n, 4) AS unexpected_pct
 FROM (SELECT count(*) FILTER ({n}) AS n, count(*) FILTER (({n}) AND ({bad})) AS bad FROM {source})"""


def _sql_total(rule_id, rule_type, column, category, value, test, source="t"):
    column = f"'{column}'" if column else "NULL"
    return f"""SELECT '{rule_id}', '{rule_type}', {column}, '{category}', {test.replace('value', 'v')}, round(v, 6), n, NULL, NULL
 FROM (SELECT CAST({value} AS DOUBLE) AS v, count(*) AS n FROM {source})"""


def _sql_schema(rule_id, rule_type, column, category, success="true"):
    return f"SELECT '{rule_id}', '{rule_type}', '{column}', '{category}', {success}, NULL, NULL, NULL, NULL"


def _suite_table(spark, folder):
    """Orders with a nullable priority and three shares that add up to one unless the priority is urgent."""
    orders = load(spark, folder, "orders")
    third = F.when(F.col("o_orderpriority") == "1-URGENT", 0.5).otherwise(0.25)
    return orders.select("*", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
                         F.lit(0.5).alias("share_a"), F.lit(0.25).alias("share_b"), third.alias("share_c"))


SEVEN = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "priority"]


@query(f"""WITH t AS (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
  0.5 + 0.25 + CASE WHEN o_orderpriority = '1-URGENT' THEN 0.5 ELSE 0.25 END AS shares FROM orders),
dup AS (SELECT o_orderkey, count(*) AS c FROM orders GROUP BY 1),
keyed AS (SELECT o.*, d.c FROM orders o JOIN dup d ON o.o_orderkey = d.o_orderkey),
lagged AS (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderkey, o_orderdate) AS before FROM orders)
""" + "\nUNION ALL\n".join([
    _sql_row("not_null:o_orderkey", "not_null", "o_orderkey", "completeness", "true", "o_orderkey IS NULL"),
    _sql_total("row_count", "row_count", None, "volume", "count(*)", "value BETWEEN 1000 AND 10000000"),
    *[_sql_schema(f"has_column:{c}", "has_column", c, "schema") for c in ("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")],
    _sql_row("not_null:priority", "not_null", "priority", "completeness", "true", "priority IS NULL", mostly="0.99"),
    _sql_row("unique:o_orderkey", "unique", "o_orderkey", "uniqueness", "true", "c > 1", source="keyed"),
    _sql_row("matches:o_orderpriority", "matches", "o_orderpriority", "format", "o_orderpriority IS NOT NULL",
             "NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+')"),
    _sql_row("matches:priority", "matches", "priority", "validity", "priority IS NOT NULL",
             "NOT regexp_matches(priority, '^[1-3]-')", mostly="0.95"),
    _sql_row("between:o_totalprice", "between", "o_totalprice", "range", "o_totalprice IS NOT NULL",
             "o_totalprice NOT BETWEEN 0 AND 1000000"),
    _sql_row("between:o_orderdate", "between", "o_orderdate", "timeliness", "o_orderdate IS NOT NULL",
             "o_orderdate NOT BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2000-12-31'"),
    _sql_total("mean_between:o_totalprice", "mean_between", "o_totalprice", "statistical", "avg(o_totalprice)",
               "value BETWEEN 100 AND 50000"),
    _sql_row("in_set:o_orderstatus", "in_set", "o_orderstatus", "validity", "o_orderstatus IS NOT NULL",
             "o_orderstatus NOT IN ('F', 'O')"),
    _sql_row("pair_compare:o_custkey<=o_orderkey", "pair_compare", "o_custkey,o_orderkey", "consistency",
             "o_custkey IS NOT NULL AND o_orderkey IS NOT NULL", "o_custkey > o_orderkey"),
    _sql_row("sum_equals:share_a+share_b+share_c", "sum_equals", "share_a,share_b,share_c", "consistency", "true",
             "abs(shares - 1) > 0.01"),
    _sql_schema("columns_match", "columns_match", ",".join(sorted(SEVEN)), "schema"),
    _sql_schema("has_type:o_totalprice", "has_type", "o_totalprice", "type"),
    _sql_row("increasing:o_orderdate", "increasing", "o_orderdate,o_orderkey", "timeliness", "true",
             "coalesce(o_orderdate < before, false)", source="lagged"),
]))
def quality_suite(spark, folder):
    """The 19 published rules, adapted to orders; some fail on purpose."""
    return _shown(op.run_suite(_suite_table(spark, folder), [
        r.row_count(1_000, 10_000_000),
        *[r.has_column(c) for c in ("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")],
        r.not_null("o_orderkey"), r.not_null("priority", mostly=0.99), r.unique("o_orderkey"),
        r.matches("o_orderpriority", "^[1-5]-[A-Z ]+"), r.matches("priority", "^[1-3]-", mostly=0.95, category="validity"),
        r.between("o_totalprice", 0, 1_000_000), r.between("o_orderdate", "1995-01-01", "2000-12-31", category="timeliness"),
        r.mean_between("o_totalprice", 100, 50_000), r.in_set("o_orderstatus", ["F", "O"]),
        r.pair_compare("o_custkey", "<=", "o_orderkey"), r.sum_equals(["share_a", "share_b", "share_c"], 1, 0.01),
        r.columns_match(SEVEN), r.has_type("o_totalprice", "float"), r.increasing("o_orderdate", order_by="o_orderkey")]))


@query("WITH t AS (SELECT *, regexp_replace(o_orderpriority, '[0-9]-LOW', ' ') AS p FROM orders), o AS (SELECT *, c_custkey FROM orders"
       " LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey)\n"
       + "\nUNION ALL\n".join([
    _sql_row("not_blank:p", "not_blank", "p", "completeness", "p IS NOT NULL", "trim(p) = ''", mostly="0.9"),
    _sql_row("not_future:o_orderdate", "not_future", "o_orderdate", "timeliness", "o_orderdate IS NOT NULL",
             "o_orderdate > TIMESTAMP '2001-06-30'"),
    _sql_row("urgent_is_dear", "expr_rule", "", "custom", "true", "o_orderpriority = '1-URGENT' AND o_totalprice <= 1000"),
    _sql_row("references:o_custkey", "references", "o_custkey", "referential", "o_custkey IS NOT NULL", "c_custkey IS NULL", source="o"),
    _sql_total("complete:o_custkey+p", "complete", "o_custkey,p", "completeness", "(count(o_custkey) + count(p)) / (2.0 * count(*))", "value >= 1"),
    _sql_total("fresh:o_orderdate", "fresh", "o_orderdate", "timeliness", "epoch(TIMESTAMP '2001-08-02') - epoch(max(o_orderdate))", "value <= 86400"),
    _sql_total("quantile_between:o_totalprice:0.5", "quantile_between", "o_totalprice", "statistical", "quantile_disc(o_totalprice, 0.5)",
               "value BETWEEN 100000 AND 400000"),
    "SELECT 'has_column:email', 'has_column', 'email', 'schema', false, NULL, NULL, NULL, NULL",
    "SELECT 'not_null:email', 'not_null', 'email', 'completeness', false, NULL, NULL, NULL, NULL",
    "SELECT 'schema_matches', 'schema_matches', 'o_orderkey,o_totalprice', 'schema', true, NULL, NULL, NULL, NULL",
]))
def further_rules(spark, folder):
    """The checks outside the published suite, and rules on a column the table lacks."""
    orders = load(spark, folder, "orders")
    table = orders.withColumn("p", F.regexp_replace("o_orderpriority", "[0-9]-LOW", " "))
    parents = load(spark, folder, "customer").where("c_acctbal > 0")
    expected = orders.select("o_orderkey", "o_totalprice").schema
    return _shown(op.run_suite(table, [
        r.not_blank("p", mostly=0.9), r.not_future("o_orderdate", as_of="2001-06-30"),
        r.expr_rule("urgent_is_dear", "o_orderpriority <> '1-URGENT' OR o_totalprice > 1000"),
        r.references("o_custkey", parents, "c_custkey"), r.complete(["o_custkey", "p"]),
        r.fresh("o_orderdate", as_of="2001-08-02", max_lag_seconds=86_400),
        r.quantile_between("o_totalprice", 0.5, 100_000, 400_000),
        r.has_column("email"), r.not_null("email"), r.schema_matches(expected)]))


@query("""SELECT o_custkey, count(*) AS orphans FROM orders o WHERE NOT EXISTS
  (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_acctbal > 0) GROUP BY 1""")
def orphan_keys(spark, folder):
    """Keys without a parent, with the rows that use them."""
    parents = load(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")).distinct()
    used = load(spark, folder, "orders").where("o_custkey IS NOT NULL").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orphans"))
    return used.join(parents, "o_custkey", "left_anti")


@query("""SELECT 'event time' AS checked, count(*) AS element_count, count(*) FILTER (ts < before) AS unexpected_count
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id, ts) AS before FROM events)
UNION ALL SELECT 'order date', count(*), count(*) FILTER (d < before)
FROM (SELECT o_orderdate AS d, lag(o_orderdate) OVER (ORDER BY o_orderkey, o_orderdate) AS before FROM orders)
UNION ALL SELECT 'ship date by order, strictly', count(*), count(*) FILTER (d <= before)
FROM (SELECT l_shipdate AS d, lag(l_shipdate) OVER (ORDER BY l_orderkey, l_shipdate) AS before FROM lineitem)""")
def increasing_global(spark, folder):
    """Order checks over whole tables; in the last one most order keys repeat."""
    checks = [("event time", "events", "ts", "event_id", False), ("order date", "orders", "o_orderdate", "o_orderkey", False),
              ("ship date by order, strictly", "lineitem", "l_shipdate", "l_orderkey", True)]
    parts = [op.order_violations(load(spark, folder, table), value, [order], strictly=strictly).select(
        F.lit(label).alias("checked"), "element_count", "unexpected_count") for label, table, value, order, strictly in checks]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT user_id, count(*) AS element_count, count(*) FILTER (value < before) AS unexpected_count
FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, value) AS before FROM events) GROUP BY 1""")
def increasing_within(spark, folder):
    return op.order_violations(load(spark, folder, "events"), "value", ["ts"], within=["user_id"])


# ---- profiles ----------------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT nullif(o_orderstatus, 'P') AS patient_id, nullif(o_orderpriority, '5-LOW') AS claim_amount FROM orders)
SELECT 'patient_id' AS column_name, count(*) - count(patient_id) AS null_count,
  round(100.0 * CAST(count(*) - count(patient_id) AS DOUBLE) / count(*), 2) AS null_percentage FROM t
UNION ALL SELECT 'claim_amount', count(*) - count(claim_amount), round(100.0 * CAST(count(*) - count(claim_amount) AS DOUBLE) / count(*), 2) FROM t""")
def null_profile(spark, folder):
    table = load(spark, folder, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("patient_id"),
                                                 F.nullif("o_orderpriority", F.lit("5-LOW")).alias("claim_amount"))
    return op.null_profile(table, ["patient_id", "claim_amount"])


@query("""SELECT 3 * count(*) AS cells, count(nullif(o_orderstatus, 'P')) + 2 * count(*) AS filled_cells,
  round((count(nullif(o_orderstatus, 'P')) + 2 * count(*)) / (3.0 * count(*)), 6) AS completeness FROM orders""")
def completeness(spark, folder):
    table = claims(spark, folder).withColumn("claim_status", F.nullif("claim_status", F.lit("P")))
    return op.completeness(table, ["claim_id", "patient_id", "claim_status"]).withColumn("completeness", F.round("completeness", 6))


@query("""SELECT max(ts) AS latest, round(epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)), 3) AS lag_seconds,
  epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)) <= 86400 AS is_fresh FROM events""")
def freshness(spark, folder):
    return op.freshness(load(spark, folder, "events"), "ts", "2024-01-31", 86_400).select(
        "latest", F.round("lag_seconds", 3).alias("lag_seconds"), "is_fresh")


@query("""SELECT CAST(quantile_disc(lag, 0.5) AS DOUBLE) AS lag_p50, CAST(quantile_disc(lag, 0.95) AS DOUBLE) AS lag_p95
FROM (SELECT epoch(TIMESTAMP '2001-12-31') - epoch(o_orderdate) AS lag FROM orders)""")
def lag_percentiles(spark, folder):
    return op.lag_percentiles(load(spark, folder, "orders"), "o_orderdate", "2001-12-31")


NUMERIC_SQL = """SELECT '{c}' AS column_name, count({c}) AS filled, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
 round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25,
 CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75 FROM lineitem"""


@query("\nUNION ALL\n".join(NUMERIC_SQL.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def profile_numeric(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    profile = op.profile_numeric(lines, lines.columns)
    return profile.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
f AS (SELECT cal.day, coalesce(n, 0) AS n FROM cal LEFT JOIN d ON cal.day = d.day),
s AS (SELECT day, n, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS stddev FROM f WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT day, n, round(mean, 4) AS mean, round(stddev, 4) AS stddev, round((n - mean) / nullif(stddev, 0), 4) AS z_score,
  coalesce(abs((n - mean) / nullif(stddev, 0)) > 1.5, false) AS is_anomaly FROM s""")
def volume_anomalies(spark, folder):
    return op.volume_anomalies(load(spark, folder, "events"), "ts", trailing=7, z=1.5).withColumns(
        {c: F.round(c, 4) for c in ("mean", "stddev", "z_score")})


# ---- gates -------------------------------------------------------------------------------------------------

@query("""SELECT count(*) AS total_rows, count(*) FILTER (nullif(event_type, 'error') IS NULL) AS null_ids,
  count(*) FILTER (CAST(o.o_orderdate AS DATE) + 8500 > DATE '2024-01-15') AS future_dates,
  count(*) > 0 AND count(*) FILTER (nullif(event_type, 'error') IS NULL) = 0
  AND count(*) FILTER (CAST(o.o_orderdate AS DATE) + 8500 > DATE '2024-01-15') = 0 AS passed
FROM events JOIN orders o ON event_id = o_orderkey WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def post_load_gate(spark, folder):
    """Rows loaded on one day: events, with an admission date from the order of the same number."""
    dates = load(spark, folder, "orders").select(F.col("o_orderkey").alias("event_id"), F.date_add(F.to_date("o_orderdate"), 8500).alias("admission_date"))
    loaded = load(spark, folder, "events").join(dates, "event_id").select(
        F.nullif("event_type", F.lit("error")).alias("patient_id"), "admission_date", F.col("ts").alias("load_timestamp"))
    return gate(loaded, "2024-01-15")


@query("""SELECT * FROM (VALUES ('customer_id', 'bigint'), ('email', 'string'), ('created_at', 'date')) v(column_name, data_type),
 (SELECT count(*) AS filled FROM customer)""")
def required_columns(spark, folder):
    """The columns a migrated table must have, in any case, with their types and filled cells."""
    table = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("CUSTOMER_ID"), F.concat(F.lower("c_name"), F.lit("@example.org")).alias("Email"),
        F.lit("2024-01-01").cast("date").alias("created_at"))
    checked = op.require_columns(table, ["customer_id", "email", "created_at"])
    counts = checked.agg(*[F.count(c).alias(c.lower()) for c in checked.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name.lower()).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f.name.lower()).alias("filled")) for f in checked.schema.fields])))


@query("""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '31/12/1999' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
  CAST(o_custkey AS VARCHAR) AS cust, rpad(o_orderstatus, 4, ' ') AS status FROM orders)
SELECT o_orderkey, TRY_CAST(day AS DATE) AS day, CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  TRY_CAST(cust AS BIGINT) AS cust, rtrim(status) AS status,
  concat_ws(',', CASE WHEN TRY_CAST(day AS DATE) IS NULL THEN 'day' END, CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL THEN 'amount' END) AS failed_casts FROM t""")
def convert_types(spark, folder):
    orders = load(spark, folder, "orders")
    text = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "31/12/1999").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.col("o_custkey").cast("string").alias("cust"), F.rpad("o_orderstatus", 4, " ").alias("status"))
    typed = fn.convert_types(text, {"day": "DATE", "amount": "DECIMAL(18,2)", "cust": "INTEGER", "status": "CHAR(4)"})
    return typed.withColumns({"amount": F.col("amount").cast("double"), "failed_casts": F.array_join("failed_casts", ",")})
