"""Loads, masks, splits, rollups, reconciliation and merges over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit import functions as fn
from etlkit import operators as op
from etlkit import sources as src
from etlkit.operators.rules import in_set, matches, not_null
from etlkit.session import scratch_path
from etlkit.sinks import (REJECTED, VALID, append_rejected, append_table, create_table, read_outcome, replace_table, upsert_table,
                          write_clustered, write_outcomes)

from workload.inputs import CLAIMS_SQL, RECONCILE_SQL, claims, line_totals, load, open_claims

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return keep


# ---- flagship: read, mask, split, roll up ------------------------------------------------------------------

FLAGSHIP_RULES = [not_null("claim_status"), matches("priority", "^[1-4]-[A-Z ]+")]


@query(f"""WITH {CLAIMS_SQL}
SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, count(*) AS total_claims,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(claim_amount) AS avg_amount,
  CAST(sum(CAST('0x' || substr(sha256(CAST(patient_id AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) AS patient_checksum
FROM claims WHERE claim_status <> 'P' AND regexp_matches(priority, '^[1-4]-[A-Z ]+') GROUP BY 1""")
def etl_flagship(spark, folder):
    raw = claims(spark, folder).withColumn("claim_status", F.nullif("claim_status", F.lit("P")))
    masked = fn.mask_columns(raw, ["patient_id"])
    valid, _ = op.split_valid(masked, FLAGSHIP_RULES, as_of="2024-01-31")
    checksum = F.sum(F.conv(F.substring("patient_id_masked", 1, 8), 16, 10).cast("bigint")).alias("patient_checksum")
    return op.monthly_rollup(valid, extra=[checksum]).select(
        "claim_month", "total_claims", F.col("total_amount").cast("double").alias("total_amount"), "avg_amount", "patient_checksum")


# ---- projections, masks, splits ----------------------------------------------------------------------------

@query("""SELECT c_custkey, c_nationkey, c_mktsegment, sha256(c_name) AS c_name_masked,
  sha256(CAST(c_acctbal AS VARCHAR)) AS c_acctbal_masked FROM customer""")
def mask_columns(spark, folder):
    return fn.mask_columns(load(spark, folder, "customer"), ["c_name", "c_acctbal", "ssn"], on_missing="skip")


@query("""SELECT c_custkey, sha256('pepper' || c_name) AS c_name_masked FROM customer""")
def mask_salted(spark, folder):
    return fn.mask_columns(load(spark, folder, "customer").select("c_custkey", "c_name"), ["c_name"], salt="pepper")


@query("""SELECT * FROM (VALUES ('c_name'), ('c_acctbal')) v(column_name),
  (SELECT true AS original_removed, count(*) AS masked_values, CAST(0 AS BIGINT) AS not_digest,
          CAST(0 AS BIGINT) AS leaked_values, true AS passed FROM customer)""")
def masking_check(spark, folder):
    raw = load(spark, folder, "customer")
    masked = fn.mask_columns(raw, ["c_name", "c_acctbal"])
    return fn.masking_check(masked, ["c_name", "c_acctbal"], original=raw, keys=["c_custkey"])


def _coded_parts(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey", F.nullif("p_type", F.lit("ECONOMY")).alias("patient_id"), F.col("p_brand").alias("diagnosis_code"))


BRAND = "^Brand#[0-9]{2}$"


@query("""SELECT p_partkey, CASE WHEN rules = '' THEN 'valid' ELSE 'rejected' END AS outcome, rules AS failed_rules
FROM (SELECT p_partkey, concat_ws(',', CASE WHEN nullif(p_type, 'ECONOMY') IS NULL THEN 'not_null:patient_id' END,
   CASE WHEN NOT regexp_matches(p_brand, '^Brand#[0-9]{2}$') THEN 'matches:diagnosis_code' END) AS rules FROM part)""")
def split_total(spark, folder):
    tagged = op.with_outcome(_coded_parts(spark, folder), op.clinical_rules(pattern=BRAND), as_of="2024-01-31")
    return tagged.select("p_partkey", "outcome", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("""SELECT p_partkey, 'valid' AS outcome FROM part
WHERE nullif(p_type, 'ECONOMY') IS NOT NULL AND regexp_matches(p_brand, '^Brand#[0-9]{2}$')
UNION ALL SELECT p_partkey, 'rejected' FROM part WHERE nullif(p_type, 'ECONOMY') IS NULL""")
def split_literal(spark, folder):
    valid, rejected = op.split_literal(_coded_parts(spark, folder), pattern=BRAND, as_of="2024-01-31")
    return valid.select("p_partkey", F.lit("valid").alias("outcome")).unionByName(
        rejected.select("p_partkey", F.lit("rejected").alias("outcome")))


@query("""SELECT o_orderkey AS claim_id, o_custkey AS patient_id, o_totalprice AS claim_amount FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'""")
def range_prune(spark, folder):
    day = F.to_date("o_orderdate")
    return load(spark, folder, "orders").where(day.between(F.lit("1997-01-01").cast("date"), F.lit("1997-01-31").cast("date"))).select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("patient_id"), F.col("o_totalprice").alias("claim_amount"))


# ---- rollups -----------------------------------------------------------------------------------------------

def _shown(months):
    return months.select("claim_month", "total_claims", F.col("total_amount").cast("double").alias("total_amount"),
                         "avg_amount")


ROLLUP_SQL = """SELECT CAST(date_trunc('month', claim_date) AS DATE) AS claim_month, count(*) AS total_claims,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(claim_amount) AS avg_amount FROM """


@query(f"WITH {CLAIMS_SQL} {ROLLUP_SQL} claims GROUP BY 1")
def monthly_rollup(spark, folder):
    return _shown(op.monthly_rollup(claims(spark, folder)))


@query(f"WITH {CLAIMS_SQL} {ROLLUP_SQL} claims GROUP BY 1")
def refresh_monthly(spark, folder):
    """A stored rollup of the claims up to mid-March 1998, brought up to date with the later ones."""
    all_claims, cut = claims(spark, folder), F.lit("1998-03-15").cast("date")
    path = scratch_path(spark, "monthly")
    replace_table(op.monthly_rollup(all_claims.where(F.col("claim_date") <= cut)), path)
    return _shown(op.refresh_monthly(spark.read.parquet(path), all_claims.where(F.col("claim_date") > cut)))


@query(f"""WITH {CLAIMS_SQL} {ROLLUP_SQL} claims WHERE date_trunc('month', claim_date) IN
  (SELECT date_trunc('month', claim_date) FROM claims WHERE priority = '1-URGENT' AND claim_amount > 490000) GROUP BY 1""")
def recompute_months(spark, folder):
    base = claims(spark, folder)
    return _shown(op.recompute_months(base, base.where("priority = '1-URGENT' AND claim_amount > 490000")))


# ---- counts and duplicates ---------------------------------------------------------------------------------

@query("""SELECT 'Source' AS source, count(*) AS row_count FROM orders
UNION ALL SELECT 'Target', count(*) FROM lineitem""")
def row_counts(spark, folder):
    return op.row_counts({"Source": load(spark, folder, "orders"), "Target": load(spark, folder, "lineitem")})


@query("""SELECT s AS source_rows, t AS target_rows, t - s AS difference, s = t AS matched
FROM (SELECT count(*) AS s FROM orders), (SELECT count(*) AS t FROM lineitem)""")
def row_count_match(spark, folder):
    return op.row_count_match(load(spark, folder, "orders"), load(spark, folder, "lineitem"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS occurrence_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def find_duplicates(spark, folder):
    return op.find_duplicates(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- reconciliation ----------------------------------------------------------------------------------------

@query(f"""WITH {RECONCILE_SQL}
SELECT s.claim_id, CAST(s.claim_amount AS DOUBLE) AS source_claim_amount, CAST(t.claim_amount AS DOUBLE) AS target_claim_amount,
  CAST(abs(s.claim_amount - t.claim_amount) AS DOUBLE) AS difference
FROM s FULL OUTER JOIN t ON s.claim_id = t.claim_id
WHERE s.claim_amount <> t.claim_amount OR s.claim_id IS NULL OR t.claim_id IS NULL""")
def reconcile_literal(spark, folder):
    report = op.reconcile_literal(open_claims(spark, folder), line_totals(spark, folder), "claim_id", "claim_amount")
    return report.select("claim_id", *[F.col(c).cast("double").alias(c) for c in report.columns[1:]])


RECONCILED_SQL = """SELECT coalesce(s.claim_id, t.claim_id) AS claim_id,
  CASE WHEN s.claim_id IS NULL THEN 'missing_in_source' WHEN t.claim_id IS NULL THEN 'missing_in_target' ELSE 'mismatch' END AS status,
  CAST(s.claim_amount AS DOUBLE) AS source_claim_amount, CAST(t.claim_amount AS DOUBLE) AS target_claim_amount,
  CAST(abs(s.claim_amount - t.claim_amount) AS DOUBLE) AS difference_claim_amount
FROM s FULL OUTER JOIN t ON s.claim_id = t.claim_id
WHERE (s.claim_amount IS DISTINCT FROM t.claim_amount OR s.claim_id IS NULL OR t.claim_id IS NULL)"""


def _reported(report):
    return report.select("claim_id", "status", *[F.col(c).cast("double").alias(c) for c in report.columns if "amount" in c])


@query(f"WITH {RECONCILE_SQL} {RECONCILED_SQL}")
def reconcile_null_safe(spark, folder):
    return _reported(op.reconcile(open_claims(spark, folder), line_totals(spark, folder), ["claim_id"], ["claim_amount"]))


@query(f"""WITH {RECONCILE_SQL} {RECONCILED_SQL}
AND CAST('0x' || substr(md5(CAST(coalesce(s.claim_id, t.claim_id) AS VARCHAR)), 1, 8) AS BIGINT) % 16 = 0""")
def reconcile_sample(spark, folder):
    """The sampling form of the reconciliation: one key in sixteen."""
    return _reported(op.reconcile(open_claims(spark, folder), line_totals(spark, folder), ["claim_id"], ["claim_amount"], sample=16))


@query("""WITH s AS (SELECT l_orderkey, count(*) AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1),
t AS (SELECT l_orderkey + 33 AS l_orderkey, count(*) AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT status, count(*) AS keys, CAST(sum(sn) AS BIGINT) AS source_rows, CAST(sum(tn) AS BIGINT) AS target_rows FROM (
 SELECT coalesce(s.n, 0) AS sn, coalesce(t.n, 0) AS tn,
  CASE WHEN s.n > 1 OR t.n > 1 THEN 'duplicate_key' WHEN s.n IS NULL THEN 'missing_in_source' WHEN t.n IS NULL THEN 'missing_in_target'
       WHEN abs(s.q - t.q) > 5 THEN 'mismatch' ELSE 'match' END AS status
 FROM s FULL OUTER JOIN t ON s.l_orderkey = t.l_orderkey) GROUP BY 1""")
def reconcile_statuses(spark, folder):
    """Tables whose key repeats, and a tolerance on the compared value."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    report = op.reconcile(lines, lines.withColumn("l_orderkey", F.col("l_orderkey") + 33), ["l_orderkey"], ["l_quantity"],
                          tolerance=5, keep_matches=True)
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("keys"), F.sum("source_rows").alias("source_rows"),
                                        F.sum("target_rows").alias("target_rows"))


@query(f"""WITH {RECONCILE_SQL}
SELECT compared, agreeing, round(agreeing / compared, 6) AS accuracy FROM (
 SELECT count(*) AS compared, count(*) FILTER (s.claim_id IS NOT NULL AND t.claim_id IS NOT NULL
   AND abs(s.claim_amount - t.claim_amount) <= 100000) AS agreeing
 FROM s FULL OUTER JOIN t ON s.claim_id = t.claim_id)""")
def accuracy_rate(spark, folder):
    rate = op.accuracy_rate(open_claims(spark, folder), line_totals(spark, folder), ["claim_id"], ["claim_amount"], tolerance=100_000)
    return rate.withColumn("accuracy", F.round("accuracy", 6))


@query("""WITH t AS (SELECT * REPLACE (CASE WHEN l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem WHERE l_linenumber <> 5)
SELECT *, 'source' AS only_in, count(*) AS copies FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM t) GROUP BY ALL
UNION ALL SELECT *, 'target', count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM lineitem) GROUP BY ALL""")
def row_diff(spark, folder):
    """All columns of a table against a copy that was altered and lost rows."""
    lines = load(spark, folder, "lineitem")
    altered = lines.where("l_linenumber <> 5").withColumn("l_quantity", F.when(F.col("l_linenumber") == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return op.row_diff(lines, altered)


@query("""SELECT s.k AS l_partkey, s.v AS source_l_quantity, t.v AS target_l_quantity, abs(s.v - t.v) AS difference
FROM (SELECT nullif(l_partkey, 1) AS k, l_quantity AS v FROM lineitem) s
FULL OUTER JOIN (SELECT nullif(p_partkey, 2) AS k, CAST(p_size AS DOUBLE) AS v FROM part) t ON s.k = t.k
WHERE s.k IS NULL OR t.k IS NULL OR s.v <> t.v""")
def reconcile_repeated_keys(spark, folder):
    """The published report on a source whose keys repeat, with NULL keys on both sides."""
    source = load(spark, folder, "lineitem").select(F.nullif("l_partkey", F.lit(1)).alias("l_partkey"), "l_quantity")
    target = load(spark, folder, "part").select(F.nullif("p_partkey", F.lit(2)).alias("l_partkey"), F.col("p_size").cast("double").alias("l_quantity"))
    return op.reconcile_literal(source, target, "l_partkey", "l_quantity")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN 'rejected' ELSE 'valid' END AS outcome FROM orders""")
def corrected_batch(spark, folder):
    """A batch written again after its input was corrected: the second attempt is all that is left."""
    orders, path = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), scratch_path(spark, "batch")
    for wrong in (["P"], ["P", "O"]):
        tagged = orders.withColumn("outcome", F.when(F.col("o_orderstatus").isin(wrong), "rejected").otherwise("valid"))
        write_outcomes(tagged, path, ["o_orderpriority"], batch_id=7)
    return spark.read.parquet(path).select("o_orderkey", "outcome")


# ---- incremental loads and merges --------------------------------------------------------------------------

@query("""SELECT event_id, user_id, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')""")
def incremental_slice(spark, folder):
    events = load(spark, folder, "events")
    loaded = events.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    return src.incremental_slice(events, "ts", loaded, "ts").select("event_id", "user_id", "value")


@query("""SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def loaded_on_day(spark, folder):
    return src.loaded_on(load(spark, folder, "events"), "ts", "2024-01-15").select("event_id", "user_id", "value")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, folder):
    return op.latest_per_key(load(spark, folder, "events"), ["user_id", "event_type"], "ts", ["event_id"]).select(
        "user_id", "event_type", "event_id", "value")


def _accounts(spark, folder):
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("claim_id"), F.col("c_acctbal").alias("claim_amount"),
        F.lit("2023-12-31").cast("timestamp").alias("processed_at"))


def _account_changes(spark, folder):
    """Events as changes of accounts: users stand for customers, signups for new ones, errors for deletes."""
    return load(spark, folder, "events").select(
        F.when(F.col("event_type") == "signup", -1 - F.col("user_id")).otherwise(F.col("user_id")).alias("claim_id"),
        F.col("value").alias("claim_amount"), F.col("ts").alias("updated_at"), "event_id",
        F.when(F.col("event_type") == "error", "d").otherwise("u").alias("op"))


CHANGES_SQL = """w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY ts DESC, event_id DESC) AS rn FROM
 (SELECT CASE WHEN event_type = 'signup' THEN -1 - user_id ELSE user_id END AS claim_id, value, ts, event_id, event_type FROM events)) WHERE rn = 1)"""


@query(f"""WITH {CHANGES_SQL}
SELECT c_custkey AS claim_id, c_acctbal AS claim_amount, DATE '2023-12-31' AS processed_on FROM customer
WHERE NOT EXISTS (SELECT 1 FROM w WHERE claim_id = c_custkey)
UNION ALL SELECT claim_id, value, DATE '2024-01-31' FROM w""")
def upsert(spark, folder):
    merged = op.upsert(_accounts(spark, folder), _account_changes(spark, folder), ["claim_id"], "updated_at", ["event_id"],
                       as_of="2024-01-31")
    return merged.select("claim_id", "claim_amount", F.to_date("processed_at").alias("processed_on"))


@query(f"""WITH {CHANGES_SQL}
SELECT c_custkey AS claim_id, c_acctbal AS claim_amount FROM customer WHERE NOT EXISTS (SELECT 1 FROM w WHERE claim_id = c_custkey)
UNION ALL SELECT claim_id, value FROM w WHERE event_type <> 'error'""")
def apply_changes(spark, folder):
    return op.apply_changes(_accounts(spark, folder).drop("processed_at"), _account_changes(spark, folder), ["claim_id"],
                            "updated_at", ["event_id"])


@query("""WITH w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
   l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1)
SELECT o_orderkey AS claim_id, o_totalprice AS claim_amount, CAST(o_orderdate AS DATE) AS claim_date, CAST(year(o_orderdate) AS BIGINT) AS claim_year
FROM orders WHERE NOT EXISTS (SELECT 1 FROM w WHERE l_orderkey = o_orderkey)
UNION ALL SELECT l_orderkey, l_extendedprice, CAST(l_shipdate AS DATE), CAST(year(l_shipdate) AS BIGINT) FROM w""")
def upsert_partitions(spark, folder):
    """Merge into a table partitioned by year; the changes move claims to another year."""
    path = scratch_path(spark, "claims")
    held = claims(spark, folder).select("claim_id", "claim_amount", "claim_date", F.year("claim_date").alias("claim_year"))
    append_table(held, path, "claim_year")
    changes = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("claim_id"), F.col("l_extendedprice").alias("claim_amount"),
        F.to_date("l_shipdate").alias("claim_date"), F.year("l_shipdate").alias("claim_year"),
        "l_linenumber", "l_partkey", "l_suppkey")
    upsert_table(spark, path, changes, ["claim_id"], "claim_date", ["l_linenumber", "l_partkey", "l_suppkey", "claim_amount"],
                 partition_col="claim_year")
    return spark.read.parquet(path).select("claim_id", "claim_amount", "claim_date", F.col("claim_year").cast("bigint").alias("claim_year"))


# ---- sources and sinks -------------------------------------------------------------------------------------

@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS c_acctbal,
  c_mktsegment = 'MACHINERY' AS unparsed FROM customer""")
def read_csv_rows(spark, folder):
    """Text input with cells that do not fit the schema: the rows are kept and marked."""
    path = scratch_path(spark, "customer-csv")
    broken = F.when(F.col("c_mktsegment") == "MACHINERY", "n/a").otherwise(F.col("c_acctbal").cast("string"))
    load(spark, folder, "customer").select("c_custkey", broken.alias("c_acctbal")).write.csv(path, header=True)
    schema = spark.createDataFrame([], "c_custkey bigint, c_acctbal double").schema
    parsed, corrupt = src.split_corrupt(src.read_table(spark, path, "csv", schema, header="true"))
    return parsed.withColumn("unparsed", F.lit(False)).unionByName(
        corrupt.select("c_custkey", F.lit(None).cast("double").alias("c_acctbal"), F.lit(True).alias("unparsed")))


@query("""SELECT p_type, count(*) AS n, min(p_partkey) AS first_key, max(p_retailprice) AS top_price FROM part GROUP BY 1""")
def write_clustered_table(spark, folder):
    """A table partitioned by type and clustered by key, read back."""
    path = scratch_path(spark, "parts")
    write_clustered(load(spark, folder, "part"), path, ["p_type"], ["p_partkey"])
    return spark.read.parquet(path).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_key"), F.max("p_retailprice").alias("top_price"))


@query("""SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN 'valid' ELSE 'rejected' END AS side, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1""")
def append_both_sides(spark, folder):
    """Valid rows to a partitioned table, rejected rows to its `_rejected` neighbour."""
    path = scratch_path(spark, "orders")
    valid, rejected = op.split_valid(claims(spark, folder), [in_set("claim_status", ["F", "O"])], as_of="2024-01-31")
    append_table(valid, path, "claim_status")
    append_rejected(rejected, path)
    sides = spark.read.parquet(path).select(F.lit("valid").alias("side"), "claim_amount").unionByName(
        spark.read.parquet(f"{path}_rejected").select(F.lit("rejected").alias("side"), "claim_amount"))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("claim_amount").cast("decimal(18,2)")).cast("double").alias("amount"))


@query("""SELECT o_orderkey AS claim_id, o_totalprice AS claim_amount, 'new' AS state FROM orders""")
def created_table(spark, folder):
    """A table with a default, filled by an insert that does not name the defaulted column."""
    path, name = scratch_path(spark, "created"), f"created_{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField("claim_id", T.LongType(), False), T.StructField("claim_amount", T.DoubleType()), T.StructField("state", T.StringType())])
    create_table(spark, name, schema, path, defaults={"state": "'new'"})
    rows = claims(spark, folder).select("claim_id", "claim_amount")
    rows.createOrReplaceTempView(f"{name}_rows")
    spark.sql(f"INSERT INTO {name} (claim_id, claim_amount) SELECT * FROM {name}_rows")
    spark.catalog.dropTempView(f"{name}_rows")
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table lay outside the warehouse
    return spark.read.schema(schema).parquet(path)
