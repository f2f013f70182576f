"""Distributions of the given tables compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit import operators as op
from etlkit.session import staged
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


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KS_SQL = """SELECT '{c}' AS column_name, max(rn) AS reference_rows, max(cn) AS current_rows,
  CAST(max(gap) AS DOUBLE) / CAST(max(rn) * max(cn) AS DOUBLE) AS distance, arg_min({c}, (-gap, {c})) AS at
FROM (SELECT {c}, rn, cn, abs(r * cn - c * rn)::BIGINT AS gap FROM (
  SELECT {c}, sum(r) OVER (ORDER BY {c}) AS r, sum(c) OVER (ORDER BY {c}) AS c, (sum(r) OVER ())::BIGINT AS rn, (sum(c) OVER ())::BIGINT AS cn
  FROM (SELECT {c}, count(*) FILTER (l_returnflag = 'N') AS r, count(*) FILTER (l_returnflag <> 'N') AS c FROM lineitem GROUP BY 1)))"""


@query("\nUNION ALL\n".join(KS_SQL.format(c=c) for c in LINE_COLUMNS))
def ks_drift(spark, folder):
    """How far the lines that came back differ from those that did not."""
    lines = load(spark, folder, "lineitem")
    return op.ks_distance(lines.where("l_returnflag = 'N'"), lines.where("l_returnflag <> 'N'"), LINE_COLUMNS)


EDGES_SQL = """WITH d AS (SELECT DISTINCT unnest(quantile_disc(o_totalprice, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0])) AS high FROM orders WHERE o_orderstatus = 'F'),
k AS (SELECT row_number() OVER (ORDER BY high) - 1 AS bucket, lag(high) OVER (ORDER BY high) AS low, high FROM d UNION ALL SELECT count(*), max(high), NULL FROM d),
b AS (SELECT k.bucket, k.low, k.high, count(o_orderkey) FILTER (o_orderstatus = 'F') AS n, count(o_orderkey) FILTER (o_orderstatus <> 'F') AS m
  FROM k LEFT JOIN orders ON (low IS NULL OR o_totalprice > low) AND (high IS NULL OR o_totalprice <= high) GROUP BY 1, 2, 3)"""


def _stored(spark, folder):
    """Edges and bucket counts of the closed claims, as they would be stored."""
    closed = claims(spark, folder).where("claim_status = 'F'")
    edges = staged(op.equal_depth_edges(closed, ["claim_amount"], 8), "edges")
    return edges, staged(op.bucket_counts(closed, edges), "bucket-counts")


@query(EDGES_SQL + "SELECT 'claim_amount' AS column_name, bucket::INTEGER AS bucket, low, high, m AS n FROM b")
def histogram_of_stored_edges(spark, folder):
    """The open claims in the buckets of the closed ones."""
    edges, _ = _stored(spark, folder)
    return op.bucket_counts(claims(spark, folder).where("claim_status <> 'F'"), edges)


@query(EDGES_SQL + """, s AS (SELECT n, m, (n + 0.5::DOUBLE) / (sum(n) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS p,
  (m + 0.5::DOUBLE) / (sum(m) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS q FROM b)
SELECT 'claim_amount' AS column_name, sum(n)::BIGINT AS reference_rows, sum(m)::BIGINT AS current_rows, round(sum((q - p) * ln(q / p)), 9) AS stability_index FROM s""")
def stability_of_stored_edges(spark, folder):
    edges, counts = _stored(spark, folder)
    found = op.stability(counts, claims(spark, folder).where("claim_status <> 'F'"), edges)
    return found.withColumn("stability_index", F.round("stability_index", 9))
