"""Versions in any order, facts in one merged order, tables compared by digests, layout, ranges, leaks."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from etlkit.operators import (as_of_join, digest_diff, find_leaked_values, leaks, merged_as_of, row_diff, scd2_merge, splice_versions)
from etlkit.session import staged
from etlkit.sinks import clustering, file_intervals, overlaps, recluster
from etlkit.sources import balanced_cuts, balanced_predicates
from workload import QUERIES

D = dt.date
DIM = "n int, id string, city string, plan int, effective_date date, expiration_date date"


def brute_history(observations):
    """id -> versions, from all that was ever seen: of values of one day the greatest counts."""
    out = []
    low = (0, "")
    for key in {o[0] for o in observations}:
        days = {}
        for k, day, city, plan in observations:
            if k == key:
                days[day] = max(days.get(day, ((-1, ""), (-1, 0))), (((1, city) if city is not None else low), ((1, plan) if plan is not None else (0, 0))))
        line = sorted(days.items())
        runs = [(day, v) for n, (day, v) in enumerate(line) if n == 0 or line[n - 1][1] != v]
        for n, (day, (city, plan)) in enumerate(runs):
            out.append((key, city[1] if city[0] else None, plan[1] if plan[0] else None, day, runs[n + 1][0] if n + 1 < len(runs) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_changes_in_any_order_give_the_same_history(spark, rows, seed):
    rng = random.Random(seed)
    day = lambda: D(2024, 1, rng.randrange(1, 15))
    first = [(k, f"k{k}", rng.choice("XY"), rng.choice([None, 1]), day(), None) for k in range(6)]
    dim = spark.createDataFrame(first, DIM)
    changes = [(f"k{rng.randrange(8)}", day(), rng.choice(["X", "Y", None]), rng.choice([None, 1, 2])) for _ in range(60)]
    want = brute_history([(k, d, c, p) for _, k, c, p, d, _ in first] + changes)
    names = ("id", "city", "plan", "effective_date", "expiration_date")
    for order in (changes, changes[::-1], rng.sample(changes, 60) + changes[:20]):
        held = dim
        for n in range(0, len(order), 25):
            held = staged(splice_versions(held, spark.createDataFrame(order[n:n + 25], "id string, seen date, city string, plan int"), "id", "seen", "n"))
        assert rows(held, *names) == want
    kept = {(r.id, r.effective_date): r.n for r in held.where("n IS NOT NULL").collect()}
    assert kept == {(k, d): n for n, k, _, _, d, _ in first if (k, d) in {(w[0], w[3]) for w in want}} or set(kept.values()) <= set(range(6))


def test_a_change_inside_history_cuts_the_version(spark, rows):
    dim = spark.createDataFrame([(1, "a", "X", 1, D(2024, 1, 1), D(2024, 3, 1)), (2, "a", "Y", 1, D(2024, 3, 1), None), (3, "b", "X", 1, D(2024, 1, 1), None)], DIM)
    late = spark.createDataFrame([("a", D(2024, 2, 1), "Z", 1), (None, D(2024, 2, 1), "Z", 1), ("b", None, "Z", 1), ("c", D(2024, 5, 1), "Q", None)], "id string, at date, city string, plan int")
    out = splice_versions(dim, late, "id", "at", "n")
    assert rows(out.drop("plan", "observed")) == sorted([
        (1, "a", "X", D(2024, 1, 1), D(2024, 2, 1)), (None, "a", "Z", D(2024, 2, 1), D(2024, 3, 1)), (2, "a", "Y", D(2024, 3, 1), None),
        (3, "b", "X", D(2024, 1, 1), None), (None, "c", "Q", D(2024, 5, 1), None)], key=repr)
    assert rows(splice_versions(out, late, "id", "at", "n")) == rows(out)


def test_a_late_snapshot_does_not_overwrite(spark, rows):
    dim = spark.createDataFrame([(1, "a", "X", 1, D(2024, 3, 1), None), (2, "b", "X", 1, D(2024, 3, 1), None), (3, "c", "X", 1, D(2023, 1, 1), None)], DIM)
    snap = spark.createDataFrame([("a", "OLD", 0)], "id string, city string, plan int")
    assert rows(scd2_merge(dim, snap, "id", "2024-02-01", surrogate="n", close_missing=True)) == sorted(
        [(1, "a", "X", 1, D(2024, 3, 1), None), (2, "b", "X", 1, D(2024, 3, 1), None), (3, "c", "X", 1, D(2023, 1, 1), D(2024, 2, 1))], key=repr)


# ---- as of -------------------------------------------------------------------------------------------------

def test_merged_order_gives_what_the_join_gives(spark, rows):
    rng = random.Random(4)
    versions, facts = [], []
    for k in ["a", "b", "c"]:
        cuts = sorted(rng.sample(range(60), 9))
        versions += [(k, 10 * n, f"{k}{n}", D(2024, 1, 1) + dt.timedelta(a), None if b is None else D(2024, 1, 1) + dt.timedelta(b - (n % 3 == 0)))
                     for n, (a, b) in enumerate(itertools.zip_longest(cuts, cuts[1:]))]
    facts = [(i, rng.choice(["a", "b", "d", None]), rng.choice([None, D(2024, 1, 1) + dt.timedelta(rng.randrange(-5, 70))])) for i in range(300)] * 2
    dim = spark.createDataFrame([*versions, (None, 1, "no", D(2020, 1, 1), None), ("a", 1, "no", None, None)], "id string, v int, w string, effective_date date, expiration_date date")
    frame = spark.createDataFrame(facts, "f int, k string, at date").repartition(3)
    want = rows(as_of_join(frame, dim.where("effective_date IS NOT NULL"), "k", "at", ["v", "w"], dim_key="id"))
    assert rows(merged_as_of(frame, dim, "k", "at", ["v", "w"], dim_key="id")) == want
    assert len({r[3] for r in want}) > 6


def test_one_key_with_very_many_versions_and_facts(spark):
    """100,000 versions and 1,000,000 facts of one key: the pairs would be 10**11 rows."""
    day = F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") % 100_000).cast("int"))
    dim = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"), day.alias("effective_date"), F.date_add(day, 1).alias("expiration_date"))
    facts = spark.range(1_000_000).select(F.lit("hot").alias("k"), "id", day.alias("at"))
    found = merged_as_of(facts, dim, "k", "at", ["v"])
    assert found.agg(F.count(F.lit(1)), F.count_if(F.col("v") == F.col("id") % 100_000)).first() == (1_000_000, 1_000_000)


# ---- digests -----------------------------------------------------------------------------------------------

def tables(spark, key):
    base = spark.range(20_000).selectExpr(f"{key} AS k", "if(id % 9 = 0, null, id % 50) AS a", "if(id % 7 = 0, null, 'x' || id % 3) AS `b.c`", "id AS n")
    return base, base.withColumn("a", F.when(F.col("n") % 1000 == 5, F.lit(-1)).otherwise(F.col("a"))).where("n % 5000 <> 9")


@pytest.mark.parametrize("key", ["id * id", "concat('k', id)", "date_add(date'2000-01-01', int(id % 3000))", "if(id % 3 = 0, 1, if(id % 11 = 0, null, -id))", "bigint(if(id % 2 = 0, 9223372036854775807 - id, -9223372036854775808 + id))"])
def test_digests_report_what_row_diff_reports(spark, rows, key):
    source, target = tables(spark, key)
    found = digest_diff(source, target.select("n", "`b.c`", "a", "k"), "k", leaf_rows=16)
    assert rows(found.rows) == rows(row_diff(source, target)) and found.fetched == 44
    assert found.compared == 39_996 and found.moved <= 0.05 * found.compared


def test_equal_tables_cost_one_round(spark):
    source, _ = tables(spark, "id")
    same = digest_diff(source, source.repartition(7), "k")
    assert (same.rounds, same.moved, same.fetched, same.rows.collect()) == (1, 0, 0, [])
    assert digest_diff(source.limit(0), source.limit(0), "k").rows.collect() == []
    assert digest_diff(source.where("n < 3"), source.limit(0)).rows.count() == 3


def test_tables_that_differ_much_are_compared_whole(spark, rows):
    source = spark.range(30_000).selectExpr("id div 4 AS k", "id % 4 AS n", "concat('v', id % 91) AS a", "if(id % 13 = 0, null, id) AS b")
    target = source.where("n <> 3").selectExpr("k", "n", "if(n = 1, concat(a, '!'), a) AS a", "b")
    found = digest_diff(source, target.unionByName(target.where("k % 50 = 0")), "k")
    assert found.dense and found.moved <= 0.05 * found.compared and found.rounds == 1
    assert rows(found.rows) == rows(row_diff(source, target.unionByName(target.where("k % 50 = 0"))))
    few = digest_diff(source, source.selectExpr("k", "n", "if(k % 100 = 7 and n = 1, 'w', a) AS a", "b"), "k")
    assert not few.dense and few.fetched == 150 and few.rows.count() == 150


def test_digests_count_copies_and_tell_nulls_apart(spark, rows):
    a = spark.createDataFrame([(1, None, "x")] * 5 + [(2, "x", None), (3, None, None)], "k int, p string, q string")
    b = spark.createDataFrame([(1, None, "x")] * 3 + [(2, None, "x"), (3, None, None)], "k int, p string, q string")
    for key in ("k", None):
        assert rows(digest_diff(a, b, key).rows) == rows(row_diff(a, b)) == sorted([(1, None, "x", "source", 2), (2, "x", None, "source", 1), (2, None, "x", "target", 1)], key=repr)


# ---- ranges ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("key,parts", [("id", 7), ("id * id * id", 16), ("bigint(pow(2, id % 62)) + id", 12), ("-9223372036854775808 + id", 5), ("int(id % 40)", 8)])
def test_parts_of_skewed_keys_are_even(spark, tmp_path, key, parts):
    path = str(tmp_path / "source")
    spark.range(8000).selectExpr(f"{key} AS k").write.parquet(path)
    source = spark.read.parquet(path)
    counts = [source.where(c).count() for c in balanced_predicates(source, "k", parts)]
    assert sum(counts) == 8000 and len(counts) == parts
    assert all(abs(n * parts / 8000 - 1) <= 0.05 for n in counts)


def test_a_key_larger_than_a_part_is_a_part(spark):
    source = spark.range(9000).selectExpr("if(id % 3 = 0, 500, if(id % 3 = 1, id, null)) AS k")
    conditions = balanced_predicates(source, "k", 6)
    counts = [source.where(c).count() for c in conditions]
    assert sum(counts) == 9000 and max(counts) <= 3000 + 1600
    assert balanced_cuts(source.limit(0), "k", 4) == [] and balanced_predicates(source.where("k = 500"), "k", 4) == ["1 = 1"]


def test_keys_beyond_64_bits_are_cut_too(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(8000).selectExpr("id * 1125 - 4500000 AS id").selectExpr("cast(id as decimal(19,0)) * cast(id as decimal(19,0)) * cast(id as decimal(19,0)) * 1000000000 AS k").write.parquet(path)
    source = spark.read.parquet(path)
    assert source.where("abs(k) > 9223372036854775807").count() > 7000
    counts = [source.where(c).count() for c in balanced_predicates(source, "k", 12)]
    assert sum(counts) == 8000 and len(counts) == 12 and all(abs(n * 12 / 8000 - 1) <= 0.05 for n in counts)


def test_the_ranges_query_takes_orders_whose_cube_overflows(spark, tmp_path):
    spark.range(21_000).selectExpr("3000000 + id div 7 * 2000 AS l_orderkey", "int(id % 7) + 1 AS l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in QUERIES["balanced_ranges"](spark, str(tmp_path)).collect()] == [(16, 21_000, True)]


# ---- layout ------------------------------------------------------------------------------------------------

def holders(spark, path, key, value):
    return file_intervals(spark, path, key).where((F.col("low") <= clustering._sortable(value)) & (F.col("high") >= clustering._sortable(value))).count()


def test_reclustering_leaves_one_file_to_a_lookup(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        spark.range(n * 300, n * 300 + 1200).selectExpr("id % 2000 - 700 AS k", "id", "string(id) AS s").repartition(3).write.mode("append").parquet(path)
    spark.range(50_000, 60_000).selectExpr("id AS k", "id", "string(id) AS s").coalesce(1).write.mode("append").parquet(path)  # large and apart
    before, apart = rows(spark.read.parquet(path)), set(file_intervals(spark, path, "k").where("rows = 10000").toPandas()["file"])
    assert holders(spark, path, "k", 100) > 5
    done = recluster(spark, path, "k", 500)
    assert done.rewritten == done.files - 1 == 15 and done.depth > 5
    assert rows(spark.read.parquet(path)) == before
    assert [holders(spark, path, "k", v) for v in (-700, -1, 0, 100, 55_555)] == [1] * 5
    assert apart <= set(file_intervals(spark, path, "k").toPandas()["file"])
    assert recluster(spark, path, "k", 500).rewritten == 0


def test_small_files_and_files_without_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        spark.createDataFrame([(f"k{n}{i}", i) for i in range(5)] + [(None, n)], "k string, v int").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(None, 9)], "k string, v int").coalesce(1).write.mode("append").parquet(path)
    before = rows(spark.read.parquet(path))
    assert recluster(spark, path, "k", 1000).rewritten == 5
    assert rows(spark.read.parquet(path)) == before and len(spark.read.parquet(path).inputFiles()) == 1
    assert recluster(spark, path, "k", 1000).rewritten == 0


@pytest.mark.parametrize("step", range(1, 9))
def test_reclustering_that_fails_is_finished(spark, rows, tmp_path, monkeypatch, step):
    from tests.test_upkeep import Crash, crashing
    path = str(tmp_path / "t")
    for n in range(2):
        spark.range(100).selectExpr("id AS k").coalesce(1).write.mode("append").parquet(path)
    before = rows(spark.read.parquet(path))
    with monkeypatch.context() as m:
        crashing(m, step)
        try:
            recluster(spark, path, "k", 1000)
        except Crash:
            pass
    recluster(spark, path, "k", 1000)
    assert rows(spark.read.parquet(path)) == before and len(spark.read.parquet(path).inputFiles()) == 1


def test_sweep_finds_depth(spark, rows):
    files = spark.createDataFrame([("a", 600, "00", "09"), ("b", 600, "05", "20"), ("c", 600, "08", "08"), ("d", 600, "21", "30"), ("e", 10, "31", "32"), ("f", 10, "33", "33"), ("g", 0, None, None)],
                                  "file string, rows bigint, low string, high string")
    got = {r.file: (r.depth, r.rewrite) for r in overlaps(files, 1000).collect()}
    assert got == {"a": (3, True), "b": (3, True), "c": (3, True), "d": (1, False), "e": (1, True), "f": (1, True)}


# ---- leaks -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [leaks.FILTER_BITS, 64])
def test_values_are_found_wherever_they_stand(spark, rows, bits):
    """Also with a filter so full that nearly every cell passes it: what is reported is confirmed."""
    rng = random.Random(2)
    raw = spark.createDataFrame([(i, f"name {i}", i * 1000 + 7, rng.choice("MF")) for i in range(200)], "id int, name string, `ssn.no` int, sex string")
    output = spark.createDataFrame([(f"r{i}", "name 5" if i < 30 else f"name {i + 100}" if i % 40 == 0 else f"text {i}", None if i % 2 else i * 1000 + 7, "M", "name 5 and more") for i in range(150)],
                                   "a string, note string, `n.o` bigint, sex string, longer string")
    want = [("name", "note", 30 + 2, 1 + 2), ("ssn.no", "n.o", 75, 75)]
    places = [tuple(r) for r in output.collect()]
    assert sum(p[1] in {f"name {i}" for i in range(200)} for p in places) == 32
    assert rows(find_leaked_values(output, raw, ["name", "ssn.no", "sex"], allowed={"sex": ["sex"]}, bits=bits)) == want
    assert rows(find_leaked_values(output, raw, ["name", "ssn.no", "sex"], least_length=2, bits=bits)) == [want[0], ("ssn.no", "n.o", 74, 74)]
    assert ("sex", "sex", 150, 1) in rows(find_leaked_values(output, raw, ["sex"], bits=bits))
    assert rows(find_leaked_values(output, raw.limit(0), ["name"], bits=bits)) == [] == rows(find_leaked_values(output.limit(0), raw, ["name"], bits=bits))
