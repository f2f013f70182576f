"""Star schema: surrogate keys, date dimension, slowly changing dimension, fact table."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etlkit.functions.arrays import array_of
from etlkit.functions.audit import moment
from etlkit.operators.changes import latest_per_key
from etlkit.session import staged

UNKNOWN_KEY = -1
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 200_000  # bucket starts are sent to all tasks: some megabytes


# ---- surrogate keys ----------------------------------------------------------------------------------------

def assign_keys(df: DataFrame, key: str, by: list[str], existing: DataFrame | None = None,
                buckets: int | None = None) -> DataFrame:
    """Add `key`: dense numbers that follow the largest `key` in `existing` (1, 2, ... without it).

    `by` names the business key, one row each. Rows are numbered inside hash buckets of it, and each bucket
    starts where the one before ends, so no task sees more than one bucket and the same input gets the same
    numbers on every run. Without `buckets` there are as many as give about BUCKET_ROWS each. `df` is read twice, and
    a third time to count it if `buckets` is not given.
    """
    if buckets is None:
        buckets = max(8, min(MOST_BUCKETS, -(-df.count() // BUCKET_ROWS)))
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # At most `buckets` rows from here on: safe for a single window and for a broadcast.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    base = F.lit(0).cast("bigint")
    if existing is not None:
        base = existing.select(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*by))
    numbered = bucketed.withColumn("_place", place).join(F.broadcast(starts), "_bucket")
    columns = [c for c in df.columns if c != key]
    return numbered.select((base + F.col("_start") + F.col("_place")).alias(key), *columns)


# ---- date dimension ----------------------------------------------------------------------------------------

def date_key(day: Column) -> Column:
    """yyyyMMdd as a number."""
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def span_of(df: DataFrame, column: str) -> DataFrame:
    """One row with the first and last day of a column."""
    day = F.to_date(column)
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def fixed_span(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    return spark.range(1).select(F.lit(first_day).cast("date").alias("first_day"),
                                 F.lit(last_day).cast("date").alias("last_day"))


def build_dim_date(span: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day of the span. `day_of_week` is 1 on Sunday; `holidays` is a table of dates, first column."""
    days = span.where("first_day IS NOT NULL").select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    if holidays is None:
        days = days.withColumn("is_holiday", F.lit(False))
    else:
        off = holidays.select(F.col(holidays.columns[0]).cast("date").alias("full_date")).dropna().distinct()
        days = days.join(off.withColumn("is_holiday", F.lit(True)), "full_date", "left")
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"), day,
        F.dayofweek(day).cast("bigint").alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).cast("bigint").alias("month"), F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("bigint").alias("quarter"), F.year(day).cast("bigint").alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"), F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"))


# ---- slowly changing dimension -----------------------------------------------------------------------------

def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, as_of, surrogate: str | None = None,
               tracked: list[str] | None = None, close_missing: bool = False,
               newest: str | list[str] | None = None, tie_break: list[str] = ()) -> DataFrame:
    """The dimension after a snapshot, each key at most one row with `expiration_date` NULL.

    A changed key gets its open row closed at `as_of` and a new one opened from `as_of`; validity is
    half-open. Closed rows pass through. New rows have a NULL `surrogate`; number them with `number_new_rows`.
    A snapshot with several rows per key is reduced by `newest` and `tie_break`, or else to the row with the
    greatest values, the same on every run. Rows without a key are left out; `rows_without_key` gives them.
    A snapshot of the day a row was opened overwrites that row's values
    rather than leaving a row that is valid for no time. An open row of a later day stays as it is, since the snapshot says nothing
    about that day: `splice_versions` takes snapshots in any order.
    """
    snapshot = snapshot.where(F.col(key).isNotNull())
    if newest:
        snapshot = latest_per_key(snapshot, [key], newest, list(tie_break))
    else:
        others = [c for c in snapshot.columns if c != key]
        snapshot = snapshot.groupBy(key).agg(F.max(F.struct(*others)).alias("_s")).select(key, "_s.*") if others else snapshot.distinct()
    at = moment(as_of).cast("date")
    attributes = [c for c in dim.columns if c not in (surrogate, key, "effective_date", "expiration_date")]
    tracked = tracked or attributes
    closed = dim.where(F.col("expiration_date").isNotNull())
    d = dim.where(F.col("expiration_date").isNull()).select(F.struct(*dim.columns).alias("d"), F.col(key).alias("_k"))
    s = snapshot.select(F.struct(key, *attributes).alias("s"), F.col(key).alias("_k"))
    pairs = d.join(s, "_k", "full_outer")

    known, seen = F.col("d").isNotNull(), F.col("s").isNotNull()
    changed = known & seen & reduce(operator.or_, [~F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked])
    ahead = known & F.coalesce(F.col("d.effective_date") > at, F.lit(False))
    same_day = F.col("d.effective_date") == at
    changed = changed & ~ahead
    gone = known & ~seen & ~ahead & F.lit(close_missing)

    def row(attribute_of: str, surrogate_value: Column, effective: Column, expiration: Column) -> Column:
        out = []
        for f in dim.schema.fields:
            value = {surrogate: surrogate_value, "effective_date": effective, "expiration_date": expiration}.get(
                f.name, F.col(f"{attribute_of}.{f.name}"))
            out.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*out)

    none = F.lit(None)
    held = F.col(f"d.{surrogate}") if surrogate else none
    merged = pairs.select(F.inline(array_of(
        (known & ~(changed & same_day), row("d", held, F.col("d.effective_date"), F.when(changed | gone, at))),
        (changed & same_day, row("s", held, F.col("d.effective_date"), none)),
        ((seen & ~known) | (changed & ~same_day), row("s", none, at, none)))))
    return closed.unionByName(merged)


OBSERVED = "observed"


def splice_versions(dim: DataFrame, changes: DataFrame, key: str, at: str, surrogate: str | None = None) -> DataFrame:
    """The dimension after `changes` (key, the date `at`, attributes) of any dates, in whatever order they arrive.

    A change dated inside history cuts the version that covers it. What was seen of a key later on stays: `observed` holds the dates
    at which a version's values were seen, and the next of them ends the new version. Validity is half-open and gapless from
    a key's first date, the last version is open, and neighbours differ. The same changes in any order, at once or one after the
    other, also repeated, give the same versions: of several values for one day the greatest counts.

    `dim` needs the columns of the result, but for `observed`, without which a version was seen on its first day. Rows keep their
    `surrogate` with their key and first day; new versions have none until `number_new_rows`. Keys without changes are passed
    through. Rows without key or date are left out. A key's versions meet in one task, one row per day.
    """
    attributes = [c for c in dim.columns if c not in (surrogate, key, "effective_date", "expiration_date", OBSERVED)]
    changes = changes.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    touched = changes.select(key).distinct()
    held = dim if OBSERVED in dim.columns else dim.withColumn(OBSERVED, F.array("effective_date"))
    passed = held.join(touched, key, "left_anti").select(*held.columns)
    old = held.join(touched, key, "left_semi")
    values = F.struct(*[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in attributes])
    number = F.col(surrogate) if surrogate else F.lit(None)
    seen = old.select(key, F.explode(OBSERVED).alias("_day"), values.alias("_values")).unionByName(
        changes.select(F.col(key).cast(dim.schema[key].dataType).alias(key), F.to_date(F.col(at)).alias("_day"), values.alias("_values")))
    days = seen.groupBy(key, "_day").agg(F.max("_values").alias("_values"))
    along = Window.partitionBy(key).orderBy("_day")
    opens = days.withColumn("_opens", (F.row_number().over(along) == 1) | ~F.col("_values").eqNullSafe(F.lag("_values").over(along)))
    parts = opens.withColumn("_part", F.sum(F.col("_opens").cast("int")).over(along)).groupBy(key, "_part").agg(
        F.min("_day").alias("effective_date"), F.array_sort(F.collect_list("_day")).alias(OBSERVED), F.first("_values").alias("_values"))
    spliced = parts.withColumn("expiration_date", F.lead("effective_date").over(Window.partitionBy(key).orderBy("_part")))
    if surrogate:
        numbers = old.select(key, "effective_date", number.alias(surrogate))
        spliced = spliced.join(numbers, [key, "effective_date"], "left")
    return passed.unionByName(spliced.select(key, "_values.*", "effective_date", "expiration_date", OBSERVED, *([surrogate] if surrogate else [])).select(*held.columns))


def rows_without_key(snapshot: DataFrame, key: str) -> DataFrame:
    """What `scd2_merge` leaves out."""
    return snapshot.where(F.col(key).isNull())


def number_new_rows(dim: DataFrame, surrogate: str, by: list[str]) -> DataFrame:
    """Give rows with a NULL `surrogate` the next free keys. `dim` is read more than once: staged it first
    if it is costly to compute."""
    held = dim.where(F.col(surrogate).isNotNull())
    fresh = dim.where(F.col(surrogate).isNull())
    return held.unionByName(assign_keys(fresh, surrogate, by, existing=held).select(*dim.columns))


def refresh_patients(dim: DataFrame, snapshot: DataFrame, as_of, **options) -> DataFrame:
    """The patient dimension after a snapshot, new versions numbered. The merge is written once to the
    checkpoint folder, since numbering reads it several times."""
    merged = staged(scd2_merge(dim, snapshot, "patient_id", as_of, surrogate="patient_key", **options))
    return number_new_rows(merged, "patient_key", ["patient_id"])


# ---- fact table --------------------------------------------------------------------------------------------

def as_of_join(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: list[str],
               dim_key: str | None = None) -> DataFrame:
    """Left join to the dimension row valid at `at` (effective <= at < expiration, open rows never end).

    A key's validity ranges do not overlap, so a fact matches at most one row.
    """
    versions = dim.select(F.col(dim_key or key).alias("_key"), F.col("effective_date").alias("_from"),
                          F.col("expiration_date").alias("_to"), *columns)
    when = F.to_date(F.col(at))
    valid = (when >= F.col("_from")) & (F.col("_to").isNull() | (when < F.col("_to")))
    return facts.join(versions, (F.col(key) == F.col("_key")) & valid, "left").drop("_key", "_from", "_to")


def merged_as_of(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: list[str], dim_key: str | None = None) -> DataFrame:
    """`as_of_join` by one merged order, for keys with many versions: no fact meets any version but its own.

    Facts and versions are put in one order of (key, time), cut into slices wherever rows call for it, also inside a key and a
    day. Each fact takes the last version before it in its slice; one row per slice passes on the last version to the slices
    behind. So a key with any number of facts and versions costs its rows, not their pairs. Facts without key or time, and versions
    without key or start, match nothing. Versions of a key do not overlap.
    """
    when = F.to_date(F.col(at))
    payload = F.struct(F.col("expiration_date").alias("_to"), *[F.col(c) for c in columns])
    name = dim_key or key
    versions = dim.where(F.col(name).isNotNull() & F.col("effective_date").isNotNull()).select(
        F.col(name).alias("_key"), F.col("effective_date").cast("date").alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"), payload.alias("_version"))
    asking = (F.col(key).isNotNull() & when.isNotNull())
    rows = facts.where(asking).select(F.col(key).alias("_key"), when.alias("_at"), F.lit(1).alias("_kind"),
                                      F.xxhash64(*facts.columns).alias("_tie"), F.struct(*facts.columns).alias("_fact"))
    order = ["_key", "_at", "_kind", "_tie"]
    both = versions.unionByName(rows, allowMissingColumns=True)
    sliced = staged(both.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "merged-order")
    # One row per slice: the last version in it, and from there the last one of all slices before.
    last = sliced.groupBy("_slice").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_key", "_at", "_version"))).alias("_last"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    passed = last.select("_slice", F.max("_last").over(earlier).alias("_passed"))
    along = Window.partitionBy("_slice", "_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = sliced.withColumn("_inside", F.last("_version", ignorenulls=True).over(along)).where("_kind = 1")
    met = inside.join(F.broadcast(passed), "_slice", "left")
    found = met.withColumn("_found", F.coalesce("_inside", F.when(F.col("_passed._key") == F.col("_key"), F.col("_passed._version"))))
    valid = F.col("_found._to").isNull() | (F.col("_at") < F.col("_found._to"))
    matched = found.select("_fact.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in columns])
    alone = facts.where(~F.coalesce(asking, F.lit(False))).select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in columns])
    return matched.unionByName(alone)


def key_lookup(facts: DataFrame, dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Left join that adds `surrogate`; a fact whose key the dimension lacks gets -1.

    No hint: the dimension is sent to all executors only if its measured size is small enough, otherwise
    both sides are shuffled and a hot key is split by adaptive execution.
    """
    found = facts.join(dim.select(key, surrogate), key, "left")
    return found.withColumn(surrogate, F.coalesce(surrogate, F.lit(UNKNOWN_KEY)))


def build_dim_provider(ids: DataFrame, column: str = "provider_id", existing: DataFrame | None = None) -> DataFrame:
    """provider_key, provider_id for the distinct ids that `existing` does not hold yet, after those it holds."""
    distinct = ids.select(F.col(column).alias("provider_id")).dropna().distinct()
    if existing is None:
        return assign_keys(distinct, "provider_key", ["provider_id"])
    fresh = distinct.join(existing.select("provider_id"), "provider_id", "left_anti")
    return existing.select("provider_key", "provider_id").unionByName(
        assign_keys(fresh, "provider_key", ["provider_id"], existing=existing))


def load_fact(claims: DataFrame, dim_patient: DataFrame, dim_date: DataFrame, dim_provider: DataFrame,
              point_in_time: bool = True, date_column: str = "claim_date") -> DataFrame:
    """Claims with dimension keys, one row per claim, before numbering (`assign_keys(..., "claim_key")`).

    Measures the claims lack come out NULL. Keys the dimensions lack become -1.
    """
    day = F.to_date(F.col(date_column))
    # One row per calendar day by construction: bounded by the range of dates, whatever the size of the facts.
    dates = F.broadcast(dim_date.groupBy(F.col("full_date").alias("_day")).agg(F.min("date_key").alias("date_key")))
    facts = claims.join(dates, day == F.col("_day"), "left").drop("_day")
    if point_in_time:
        facts = as_of_join(facts, dim_patient, "patient_id", date_column, ["patient_key"])
    else:
        facts = facts.join(dim_patient.where("expiration_date IS NULL").select("patient_id", "patient_key"),
                           "patient_id", "left")
    facts = key_lookup(facts, dim_provider, "provider_id", "provider_key")
    unknown = F.lit(UNKNOWN_KEY).cast("bigint")
    measures = [F.col(c) if c in claims.columns else F.lit(None).cast(t).alias(c)
                for c, t in (("claim_amount", "decimal(38,9)"), ("paid_amount", "decimal(38,9)"), ("claim_status", "string"))]
    return facts.select("claim_id", F.coalesce("patient_key", unknown).alias("patient_key"),
                        F.coalesce("date_key", unknown).alias("date_key"), "provider_key", *measures)
