"""Tables kept up to date, compared, searched and laid out anew, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit import operators as op
from etlkit import plans
from etlkit import sinks
from etlkit import sources as src
from etlkit.functions import mask_columns
from etlkit.operators.rules import between, matches
from etlkit.session import scratch_path, staged
from workload import batch, modelling
from workload.inputs import CLAIMS_SQL, claims, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return keep


# ---- comparison --------------------------------------------------------------------------------------------

@query(batch.SQL["row_diff"])
def row_diff_by_digests(spark, folder):
    """As `row_diff`, from digests of key ranges."""
    lines = load(spark, folder, "lineitem")
    altered = lines.where("l_linenumber <> 5").withColumn("l_quantity", F.when(F.col("l_linenumber") == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return op.digest_diff(lines, altered, "l_orderkey").rows


@query("""SELECT * EXCLUDE (rn), 'target' AS only_in, 1::BIGINT AS copies FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
WHERE o_orderkey % 1000 = 7
UNION ALL SELECT * EXCLUDE (rn) REPLACE (o_totalprice + 1 AS o_totalprice), 'source', 1 FROM (SELECT *, 0 AS rn FROM orders) WHERE o_orderkey % 1000 = 7""")
def digests_of_few_changes(spark, folder):
    """A copy in which one claim in a thousand has another amount."""
    orders = load(spark, folder, "orders")
    altered = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return op.digest_diff(altered, orders, "o_orderkey").rows


# ---- history -----------------------------------------------------------------------------------------------

@query(modelling.SQL["as_of_join"])
def merged_as_of(spark, folder):
    """As `as_of_join`, by one merged order of claims and versions."""
    return op.merged_as_of(claims(spark, folder), modelling._versions(spark, folder), "patient_id", "claim_date", ["patient_key"]).select("claim_id", "patient_key")


@query(f"""WITH {CLAIMS_SQL}, v AS (SELECT patient_id, claim_date, max(claim_id) AS version FROM claims GROUP BY ALL),
e AS (SELECT event_id, user_id % 100 AS patient_id, (DATE '1992-01-01' + CAST(event_id % 2400 AS INTEGER)) AS day FROM events),
w AS (SELECT patient_id % 100 AS patient_id, claim_date, max(version) AS version FROM v GROUP BY ALL)
SELECT e.event_id, w.version FROM e ASOF LEFT JOIN w ON e.patient_id = w.patient_id AND e.day >= w.claim_date""")
def as_of_many_versions(spark, folder):
    """A hundred keys with very many facts and versions each: events, and the last claim of their key."""
    versions = claims(spark, folder).groupBy((F.col("patient_id") % 100).alias("patient_id"), F.col("claim_date").alias("effective_date")).agg(
        F.max("claim_id").alias("version")).withColumn("expiration_date", F.lit(None).cast("date"))
    facts = load(spark, folder, "events").select("event_id", (F.col("user_id") % 100).alias("patient_id"),
                                                 F.date_add(F.lit("1992-01-01").cast("date"), (F.col("event_id") % 2400).cast("int")).alias("day"))
    return op.merged_as_of(facts, versions, "patient_id", "day", ["version"]).select("event_id", "version")


LATE = {"2024-01-01": 0, "2024-02-01": 3000, "2024-03-01": -500, "2024-04-01": 3000}
LATE_SQL = """WITH o AS (SELECT c_custkey AS patient_id, c_mktsegment AS plan, DATE '2020-01-01' AS d FROM customer
""" + "\n".join(f" UNION ALL SELECT c_custkey, CASE WHEN c_acctbal < {low} THEN 'NONE' ELSE c_mktsegment END, DATE '{day}' FROM customer" for day, low in LATE.items()) + """),
c AS (SELECT *, lag(plan) OVER (PARTITION BY patient_id ORDER BY d) IS DISTINCT FROM plan AS opens FROM o)
SELECT patient_id, plan, d AS effective_date, lead(d) OVER (PARTITION BY patient_id ORDER BY d) AS expiration_date FROM c WHERE opens"""


@query(LATE_SQL)
def scd2_late_snapshots(spark, folder):
    """Four snapshots that arrive out of order, spliced into the patients' history one after the other."""
    customers = load(spark, folder, "customer")
    dim = customers.select(F.col("c_custkey").alias("patient_key"), F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("plan"),
                           F.lit("2020-01-01").cast("date").alias("effective_date"), F.lit(None).cast("date").alias("expiration_date"))
    for day in ("2024-03-01", "2024-01-01", "2024-04-01", "2024-02-01"):
        plan = F.when(F.col("c_acctbal") < LATE[day], "NONE").otherwise(F.col("c_mktsegment"))
        seen = customers.select(F.col("c_custkey").alias("patient_id"), plan.alias("plan"), F.lit(day).cast("date").alias("seen_on"))
        dim = staged(op.splice_versions(dim, seen, "patient_id", "seen_on", surrogate="patient_key"))
    return dim.select("patient_id", "plan", "effective_date", "expiration_date")


# ---- totals from changes -----------------------------------------------------------------------------------

@query(f"""WITH {CLAIMS_SQL}, now AS (SELECT claim_id, CASE WHEN claim_id % 7 = 1 THEN claim_date + 40 ELSE claim_date END AS claim_date,
  CASE WHEN claim_id % 5 = 0 THEN NULL WHEN claim_id % 5 = 1 THEN claim_amount * 2 ELSE claim_amount END AS claim_amount FROM claims WHERE claim_id % 11 <> 3)
{batch.ROLLUP_SQL} now GROUP BY 1""")
def rollup_by_deltas(spark, folder):
    """Monthly totals after updates, moves to another month and deletes, applied in batches of which some come again."""
    before = claims(spark, folder).select("claim_id", "claim_date", F.col("claim_amount").cast("decimal(18,2)").alias("claim_amount"))
    k = F.col("claim_id")
    doubled = F.when(k % 5 == 0, F.lit(None).cast("decimal(18,2)")).when(k % 5 == 1, (F.col("claim_amount") * 2).cast("decimal(18,2)")).otherwise(F.col("claim_amount"))
    moved = F.when(k % 7 == 1, F.date_add("claim_date", 40)).otherwise(F.col("claim_date"))
    old, new = F.struct("claim_id", "claim_date", "claim_amount"), F.struct("claim_id", moved.alias("claim_date"), doubled.alias("claim_amount"))
    changes = before.where("claim_id % 11 = 3 OR claim_id % 7 = 1 OR claim_id % 5 < 2").select(
        "claim_id", old.alias("before"), F.when(k % 11 != 3, new).alias("after"))
    path = scratch_path(spark, "totals")
    sinks.publish_version(op.monthly_rollup(before), path)
    for batch_id in (0, 1, 0, 2, 2, 1):
        plans.apply_batch_to_rollup(spark, path, changes.where(k % 3 == batch_id), batch_id, once=["claim_id"])
    return batch._shown(sinks.read_version(spark, path))


# ---- versions ----------------------------------------------------------------------------------------------

@query("""SELECT 1 AS version, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer UNION ALL
SELECT 2, count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal > 0 UNION ALL SELECT 3, count(*), sum(c_custkey)::BIGINT FROM customer""")
def published_versions(spark, folder):
    """A table, its successor, a publication that fails, and the return to the first version; each read by its number."""
    path, customers = scratch_path(spark, "versions"), load(spark, folder, "customer")
    sinks.publish_version(customers, path)
    sinks.publish_version(sinks.read_version(spark, path).where("c_acctbal > 0"), path, [between("c_acctbal", 0, None)])
    try:
        sinks.publish_version(customers, path, [between("c_acctbal", 0, None)])
        raise AssertionError("a failing table was published")
    except op.SuiteFailed:
        pass
    sinks.roll_back(spark, path, 1)
    counts = [sinks.read_version(spark, path, n).agg(F.lit(n).alias("version"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")) for n in sinks.versions(spark, path)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# ---- leaks -------------------------------------------------------------------------------------------------

@query("""SELECT * FROM (SELECT 'c_name' AS sensitive_column, 'note' AS found_in, count(*) FILTER (c_custkey % 10 = 3) AS cells, count(DISTINCT c_name) FILTER (c_custkey % 10 = 3) AS values FROM customer
UNION ALL SELECT 'c_acctbal', 'shown', count(*) FILTER (c_custkey % 10 = 4), count(DISTINCT c_acctbal) FILTER (c_custkey % 10 = 4) FROM customer) WHERE cells > 0""")
def leaked_values(spark, folder):
    """Masked customers in whose output some names and balances stand in clear, in other columns and other rows."""
    raw = load(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    other = raw.select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("c_name").alias("near"))
    masked = mask_columns(raw, ["c_name", "c_acctbal"]).join(other, "c_custkey", "left").join(raw.select("c_custkey", F.col("c_acctbal").alias("shown")), "c_custkey")
    output = masked.select(F.concat(F.lit("id "), "c_custkey").alias("customer"), "c_name_masked", "c_acctbal_masked",
                           F.when(F.col("c_custkey") % 10 == 4, F.col("near")).otherwise(F.lit("none")).alias("note"), F.when(F.col("c_custkey") % 10 == 4, F.col("shown")).alias("shown"))
    return op.find_leaked_values(output, raw, ["c_name", "c_acctbal"])


# ---- loads -------------------------------------------------------------------------------------------------

@query("""SELECT count(*) AS rows, count(DISTINCT event_id) AS events, count(DISTINCT load) AS loads FROM (SELECT event_id, 1 AS load FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 2 FROM events WHERE event_id % 3 = 1 UNION ALL SELECT event_id, 3 FROM events WHERE event_id % 3 = 2)""")
def late_commits(spark, folder):
    """Events of which a third becomes visible at a time, whatever their time, and a load between that finds nothing new."""
    events = load(spark, folder, "events").select("event_id", "ts", "user_id")
    target, state = scratch_path(spark, "loaded"), scratch_path(spark, "load-state")
    for seen in (1, 2, 2, 3):
        plans.load_committed(spark, events.where(F.col("event_id") % 3 < seen), target, state, ["event_id"], "ts", "400 days")
    return spark.read.parquet(target).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"), F.count_distinct("load").alias("loads"))


@query("""SELECT 16 AS parts, count(*) AS rows, true AS even FROM lineitem""")
def balanced_ranges(spark, folder):
    """The lines in 16 ranges of a key whose values crowd at one end; every range within 5 % of its share."""
    order = F.col("l_orderkey").cast("decimal(19,0)")  # from order 2,097,152 on a cube takes more than 64 bits
    lines = load(spark, folder, "lineitem").select((order * order * order + F.col("l_linenumber")).alias("k"))
    conditions = src.balanced_predicates(lines, "k", 16)
    counts = lines.agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.count_if(F.expr(c)) for c in conditions]).alias("n"))
    even = F.forall("n", lambda n: F.abs(n * 16 / F.col("rows") - 1) <= 0.05)
    return counts.select(F.size("n").alias("parts"), F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("rows"), (even & (F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b) == F.col("rows"))).alias("even"))


# ---- layout ------------------------------------------------------------------------------------------------

@query("""SELECT 1::BIGINT AS files_of_a_key, true AS was_deeper, 0 AS rewritten_again, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders""")
def reclustered_files(spark, folder):
    """Claims appended in no order, laid out so that a claim lies in one file; a second call finds nothing to do."""
    path, orders = scratch_path(spark, "clustered"), load(spark, folder, "orders")
    for part in range(4):
        orders.where(F.col("o_orderkey") % 4 == part).repartition(2).write.mode("append").parquet(path)
    few = max(1, orders.count() // 5)
    first, again = (sinks.recluster(spark, path, "o_orderkey", few) for _ in range(2))
    held = spark.read.parquet(path)
    per_key = held.groupBy("o_orderkey").agg(F.count_distinct(F.col("_metadata.file_path")).alias("f"))
    return per_key.agg(F.max("f").alias("files_of_a_key")).crossJoin(held.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))).select(
        "files_of_a_key", F.lit(first.depth > 1).alias("was_deeper"), F.lit(again.rewritten).alias("rewritten_again"), "rows", "keys")


# ---- dead letters ------------------------------------------------------------------------------------------

@query("""SELECT CASE WHEN p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') THEN 'valid' ELSE 'quarantined' END AS outcome, count(*) AS n,
  max(CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 2 ELSE 3 END) AS attempts FROM part GROUP BY 1""")
def replayed_letters(spark, folder):
    """Rejected parts judged again by rules that admit more brands each time; what fails three times is quarantined."""
    path = scratch_path(spark, "letters")
    plans.collect_dead_letters(load(spark, folder, "part"), path, "p_partkey")
    for replay, last in ((1, 2), (1, 9), (2, 3), (3, 3), (2, 9)):  # replays of a number that has been done change nothing
        plans.replay_dead_letters(spark, path, [matches("p_brand", f"^Brand#1[1-{last}]$")], replay)
    return sinks.read_version(spark, path).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.max("attempts").alias("attempts"))
