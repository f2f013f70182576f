"""Star schema over the given tables, and whole runs from source to published table."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit import operators as op
from etlkit import plans
from etlkit.operators.rules import between, in_set, matches, not_null, row_count, unique
from etlkit.operators.suite import SuiteFailed
from etlkit.session import scratch_path, staged
from etlkit.sinks import REJECTED, VALID, publish_if_valid, read_outcome, replace_table
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


# ---- dimensions --------------------------------------------------------------------------------------------

@query("""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM b),
h AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '12-25'))
SELECT CAST(strftime(d.full_date, '%Y%m%d') AS BIGINT) AS date_key, d.full_date, CAST(dayofweek(d.full_date) + 1 AS BIGINT) AS day_of_week,
  dayname(d.full_date) AS day_name, CAST(month(d.full_date) AS BIGINT) AS month, monthname(d.full_date) AS month_name,
  CAST(quarter(d.full_date) AS BIGINT) AS quarter, CAST(year(d.full_date) AS BIGINT) AS year,
  dayofweek(d.full_date) IN (0, 6) AS is_weekend, h.full_date IS NOT NULL AS is_holiday
FROM d LEFT JOIN h ON d.full_date = h.full_date""")
def dim_date(spark, folder):
    orders = load(spark, folder, "orders")
    holidays = orders.where(F.date_format("o_orderdate", "MM-dd").isin("01-01", "12-25")).select(F.to_date("o_orderdate").alias("day"))
    return op.build_dim_date(op.span_of(orders, "o_orderdate"), holidays)


def _patients(spark, folder):
    """A dimension as it was first loaded: one open row per customer."""
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("patient_key"), F.concat(F.lit("C"), F.col("c_custkey")).alias("patient_id"),
        F.col("c_mktsegment").alias("insurance_type"), F.col("c_nationkey").alias("region"),
        F.lit("2020-01-01").cast("date").alias("effective_date"), F.lit(None).cast("date").alias("expiration_date"))


def _patient_snapshot(spark, folder):
    """Customers in debt changed their insurance, those of nation 0 are gone, suppliers are new patients."""
    insurance = F.when(F.col("c_acctbal") < 0, "NONE").otherwise(F.col("c_mktsegment"))
    stay = load(spark, folder, "customer").where("c_nationkey <> 0").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("patient_id"), insurance.alias("insurance_type"), F.col("c_nationkey").alias("region"))
    new = load(spark, folder, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("patient_id"), F.lit("NEW").alias("insurance_type"), F.col("s_nationkey").alias("region"))
    return stay.unionByName(new)


SCD2_SQL = """SELECT 'C' || c_custkey AS patient_id, c_mktsegment AS insurance_type, c_nationkey AS region, DATE '2020-01-01' AS effective_date,
  CASE WHEN c_nationkey = 0 OR c_acctbal < 0 THEN DATE '2024-01-01' END AS expiration_date FROM customer
UNION ALL SELECT 'C' || c_custkey, 'NONE', c_nationkey, DATE '2024-01-01', NULL FROM customer WHERE c_nationkey <> 0 AND c_acctbal < 0
UNION ALL SELECT 'S' || s_suppkey, 'NEW', s_nationkey, DATE '2024-01-01', NULL FROM supplier"""


@query(SCD2_SQL)
def scd2_merge(spark, folder):
    return op.scd2_merge(_patients(spark, folder), _patient_snapshot(spark, folder), "patient_id", "2024-01-01",
                         surrogate="patient_key", close_missing=True).drop("patient_key")


@query(f"""SELECT count(*) AS n, count(*) AS distinct_keys, (SELECT min(c_custkey) FROM customer) AS first_key,
  (SELECT max(c_custkey) FROM customer) + count(*) FILTER (effective_date = DATE '2024-01-01') AS last_key FROM ({SCD2_SQL})""")
def surrogate_keys(spark, folder):
    """New versions of a dimension get the numbers that follow the keys in use, without a gap."""
    keyed = op.refresh_patients(_patients(spark, folder), _patient_snapshot(spark, folder), "2024-01-01", close_missing=True)
    per_key = keyed.groupBy("patient_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.min("patient_key").alias("first_key"), F.max("patient_key").alias("last_key"))


# ---- facts -------------------------------------------------------------------------------------------------

def _versions(spark, folder):
    """Two versions of each customer in debt, one of the others; those of nation 0 are unknown."""
    base = load(spark, folder, "customer").where("c_nationkey <> 0")
    debt, cut = F.col("c_acctbal") < 0, F.lit("1998-01-01").cast("date")
    first = base.select((F.col("c_custkey") * 10 + 1).alias("patient_key"), F.col("c_custkey").alias("patient_id"),
                        F.lit("1990-01-01").cast("date").alias("effective_date"), F.when(debt, cut).alias("expiration_date"))
    second = base.where(debt).select((F.col("c_custkey") * 10 + 2).alias("patient_key"), F.col("c_custkey").alias("patient_id"),
                                     cut.alias("effective_date"), F.lit(None).cast("date").alias("expiration_date"))
    return first.unionByName(second)


def _provided(spark, folder):
    """Claims with the smallest supplier among their lines as provider."""
    providers = load(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("claim_id")).agg(F.min("l_suppkey").alias("provider_id"))
    return claims(spark, folder).drop("priority").join(providers, "claim_id", "left")


def _providers(spark, folder):
    return load(spark, folder, "supplier").where("s_acctbal > 0").select(
        (F.col("s_suppkey") + 1000).alias("provider_key"), F.col("s_suppkey").alias("provider_id"))


VERSIONS_SQL = """p AS (SELECT c_custkey * 10 + 1 AS patient_key, c_custkey AS patient_id, DATE '1990-01-01' AS f,
   CASE WHEN c_acctbal < 0 THEN DATE '1998-01-01' END AS u FROM customer WHERE c_nationkey <> 0
 UNION ALL SELECT c_custkey * 10 + 2, c_custkey, DATE '1998-01-01', NULL FROM customer WHERE c_nationkey <> 0 AND c_acctbal < 0)"""
FACT_SQL = f"""WITH {VERSIONS_SQL},
l AS (SELECT l_orderkey, min(l_suppkey) AS provider_id FROM lineitem GROUP BY 1)
SELECT o_orderkey AS claim_id, coalesce(patient_key, -1) AS patient_key, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
  coalesce(s_suppkey + 1000, -1) AS provider_key, o_totalprice AS claim_amount, CAST(NULL AS DOUBLE) AS paid_amount, o_orderstatus AS claim_status
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey
LEFT JOIN p ON p.patient_id = o_custkey AND CAST(o_orderdate AS DATE) >= f AND (u IS NULL OR CAST(o_orderdate AS DATE) < u)
LEFT JOIN supplier ON s_suppkey = provider_id AND s_acctbal > 0"""


def _facts(spark, folder):
    dates = op.build_dim_date(op.span_of(load(spark, folder, "orders"), "o_orderdate"))
    return op.load_fact(_provided(spark, folder), _versions(spark, folder), dates, _providers(spark, folder))


@query(FACT_SQL)
def load_fact(spark, folder):
    return _facts(spark, folder).withColumn("paid_amount", F.col("paid_amount").cast("double"))


@query(f"""WITH f AS ({FACT_SQL}) SELECT count(*) AS n, count(*) AS distinct_keys, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key FROM f""")
def numbered_facts(spark, folder):
    """The fact table with its own surrogate key."""
    facts = op.assign_keys(staged(_facts(spark, folder)), "claim_key", ["claim_id"])
    per_key = facts.groupBy("claim_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.min("claim_key").alias("first_key"), F.max("claim_key").alias("last_key"))


@query(f"""WITH {VERSIONS_SQL} SELECT o_orderkey AS claim_id, patient_key FROM orders LEFT JOIN p
ON p.patient_id = o_custkey AND CAST(o_orderdate AS DATE) >= f AND (u IS NULL OR CAST(o_orderdate AS DATE) < u)""")
def as_of_join(spark, folder):
    return op.as_of_join(claims(spark, folder), _versions(spark, folder), "patient_id", "claim_date", ["patient_key"]).select("claim_id", "patient_key")


@query("""SELECT count(DISTINCT l_suppkey) AS providers, count(DISTINCT l_suppkey) AS distinct_keys, CAST(1 AS BIGINT) AS first_key,
  count(DISTINCT l_suppkey) AS last_key FROM lineitem""")
def dim_provider(spark, folder):
    dim = op.build_dim_provider(load(spark, folder, "lineitem"), "l_suppkey")
    per_key = dim.groupBy("provider_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("providers"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.min("provider_key").alias("first_key"), F.max("provider_key").alias("last_key"))


# ---- whole runs --------------------------------------------------------------------------------------------

def _clinical_input(spark, folder) -> str:
    """Orders as clinical records, written where the run reads them."""
    path = scratch_path(spark, "clinical")
    load(spark, folder, "orders").select(
        F.concat(F.lit("P"), F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("-"), F.col("o_orderkey")).alias("patient_id"),
        F.concat(F.lit("name "), F.col("o_custkey")).alias("name"), F.to_date("o_orderdate").alias("dob"),
        F.concat(F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1), F.lit("0")).alias("diagnosis_code"),
        F.col("o_orderpriority").alias("medication"), F.trunc("o_orderdate", "year").alias("visit_date"),
        F.col("o_custkey").cast("string").alias("provider_id")).write.parquet(path)
    return path


@query("""SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS visit_date,
  CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'rejected' ELSE 'valid' END AS outcome,
  count(*) AS n, min(sha256('name ' || o_custkey)) AS first_name, min(sha256(strftime(o_orderdate, '%Y-%m-%d'))) AS first_dob FROM orders GROUP BY 1, 2""")
def batch_etl(spark, folder):
    """The published batch load from end to end; both sides are read back from the one folder it wrote."""
    out = scratch_path(spark, "processed")
    rules = op.clinical_rules(pattern="^[FO][1-9]0$")
    plans.run_batch_etl(spark, _clinical_input(spark, folder), out, rules=rules, as_of="2024-01-31")
    sides = [read_outcome(spark, out, side).select("visit_date", F.lit(side).alias("outcome"), "name_masked", "dob_masked") for side in (VALID, REJECTED)]
    return sides[0].unionByName(sides[1]).groupBy("visit_date", "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.min("name_masked").alias("first_name"), F.min("dob_masked").alias("first_dob"))


@query("""SELECT m AS metric, CAST(v AS DOUBLE) AS value FROM (
 SELECT 'loaded' AS m, count(*) AS v FROM orders
 UNION ALL SELECT 'valid', count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P') FROM orders
 UNION ALL SELECT 'rejected', count(*) FILTER (NOT (o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P')) FROM orders)""")
def run_log(spark, folder):
    """The counts a batch load leaves in its run log."""
    log, out = scratch_path(spark, "run-log"), scratch_path(spark, "processed")
    plans.run_batch_etl(spark, _clinical_input(spark, folder), out, rules=op.clinical_rules(pattern="^[FO][1-9]0$"),
                        as_of="2024-01-31", run_log_path=log)
    return spark.read.parquet(log).where("metric <> 'seconds'").select("metric", "value")


@query("""SELECT c_custkey AS customer_id, lower(c_name) AS email, count(*) OVER () AS extracted,
  c_mktsegment AS created_at FROM customer WHERE c_acctbal > 0 QUALIFY true""".replace("count(*) OVER ()", "(SELECT count(*) FROM customer)").replace(" QUALIFY true", ""))
def migration(spark, folder):
    """Extract, check, transform, publish; with the count that was extracted."""
    source = load(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("email"),
                                                    F.col("c_mktsegment").alias("created_at"), "c_acctbal")
    target = scratch_path(spark, "customers")
    run = plans.run_migration(spark, lambda _: source, target,
                              transform=lambda df: df.where("c_acctbal > 0").withColumn("email", F.lower("email")),
                              rules=[not_null("customer_id"), unique("customer_id"), row_count(low=1)], keeps_rows=False)
    return spark.read.parquet(target).select("customer_id", "email", F.lit(run.extracted).alias("extracted"), "created_at")


@query("""SELECT 'published' AS step, count(*) AS n FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'after a failed check', count(*) FROM customer WHERE c_acctbal > 0""")
def publish_if_valid_twice(spark, folder):
    """A publication that passes, then one that fails and leaves the target as it was."""
    target = scratch_path(spark, "published")
    customers = load(spark, folder, "customer")
    rules = [between("c_acctbal", 0, None), matches("c_name", "^Customer#"), in_set("c_mktsegment", ["HOUSEHOLD", "FURNITURE", "MACHINERY", "BUILDING", "AUTOMOBILE"])]
    publish_if_valid(customers.where("c_acctbal > 0"), rules, target)
    first = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n")).select(F.lit("published").alias("step"), "n")
    first = staged(first)
    try:
        publish_if_valid(customers, rules, target)
        raise AssertionError("a failing table was published")
    except SuiteFailed:
        pass
    return first.unionByName(spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n")).select(F.lit("after a failed check").alias("step"), "n"))
