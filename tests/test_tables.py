import datetime as dt

import pytest
from pyspark.sql import functions as F

from etlkit.operators import SuiteFailed, clinical_rules, with_outcome
from etlkit.operators.rules import not_null, row_count, unique
from etlkit.plans import GateFailed, enforce_gate, post_load_gate, run_batch_etl, run_migration
from etlkit.session import drop_scratch, scratch_path, shared_folder, shuffle_partitions_for
from etlkit.sinks import files
from etlkit.sinks import (REJECTED, VALID, append_rejected, append_table, create_table, publish_if_valid, read_outcome, replace_table, upsert_table,
                          write_clustered, write_outcomes)
from etlkit.sources import CLAIMS_SCHEMA, CLINICAL_SCHEMA, extract_table, jdbc_reader, loaded_on, range_predicates, read_table, split_corrupt


@pytest.fixture(scope="module")
def clinical(spark):
    return spark.createDataFrame([
        ("P1", "Ann", dt.date(1990, 1, 1), "A01", "m", dt.date(2024, 1, 15), "DR1"),
        ("P2", "Bob", dt.date(1991, 1, 1), None, "m", dt.date(2024, 1, 15), "DR1"),
        (None, "Cy", None, "B12", "m", dt.date(2024, 1, 16), "DR1"),
        ("P4", None, None, "bad", "m", None, "DR1"),
        ("P5", "Eve", None, "C50", "m", None, "DR2")],
        "patient_id string, name string, dob date, diagnosis_code string, medication string, visit_date date, provider_id string")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_formats_with_the_fixed_schema(spark, clinical, tmp_path, fmt):
    path = str(tmp_path / fmt)
    clinical.write.format(fmt).save(path)
    df = read_table(spark, path, fmt)
    assert df.count() == 5 and df.columns[:7] == CLINICAL_SCHEMA.names
    assert df.select("visit_date").dtypes == [("visit_date", "date")]


@pytest.mark.parametrize("fmt,text", [("csv", "P1,Ann,1990-01-01,A01,m,2024-01-15,DR1\nP2,Bob,notadate,A01,m,2024-01-15,DR1\n"),
                                      ("json", '{"patient_id":"P1","dob":"1990-01-01"}\n{"patient_id":"P2","dob":"notadate"}\n')])
def test_bad_cells(spark, tmp_path, fmt, text):
    path = tmp_path / f"x.{fmt}"
    path.write_text(text)
    good, bad = split_corrupt(read_table(spark, str(path), fmt))
    assert [r["patient_id"] for r in good.select("patient_id").collect()] == ["P1"]
    assert bad.select("_corrupt_record").count() == 1
    assert good.count() + bad.count() == 2
    with pytest.raises(Exception):
        read_table(spark, str(path), fmt, bad_rows="fail").collect()
    with pytest.raises(ValueError):
        read_table(spark, str(path), fmt, bad_rows="ignore")


@pytest.mark.parametrize("lower,upper,parts", [(0, 100, 7), (5, 6, 4), (0, 0, 3), (0, 10, 1), (-50, 50, 10), (0, 3, 10)])
def test_range_predicates_cover_each_row_once(spark, lower, upper, parts):
    df = spark.range(-20, 130).selectExpr("if(id = 50, null, id) AS k")
    predicates = range_predicates("k", lower, upper, parts)
    assert len(predicates) <= max(parts, 1)
    assert sum(df.where(p).count() for p in predicates) == df.count()


def test_jdbc_reader_is_partitioned(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **kw: seen.update(url=url, table=table, **kw) or spark.range(3))
    df, n = extract_table(spark, jdbc_reader("jdbc:x", "claims", "id", 0, 100, 4, fetchsize=500, user="u"))
    assert n is None and df.count() == 3
    assert len(seen["predicates"]) == 4 and seen["properties"] == {"fetchsize": "500", "user": "u"}


def test_extract(spark, tmp_path):
    df, n = extract_table(spark, lambda s: s.range(10), stage_path=str(tmp_path / "stage"))
    assert n == 10 and df.count() == 10
    for stage in (None, str(tmp_path / "stage2")):
        with pytest.raises(ValueError, match="empty"):
            extract_table(spark, lambda s: s.range(0), stage_path=stage)
    assert extract_table(spark, lambda s: s.range(0), fail_if_empty=False)[0].count() == 0


def test_loaded_today_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 23)), (2, dt.datetime(2024, 1, 2))], "k int, load_timestamp timestamp").write.parquet(path)
    df = loaded_on(spark.read.parquet(path), "load_timestamp", "2024-01-02")
    assert [r["k"] for r in df.collect()] == [2]
    assert "GreaterThanOrEqual(load_timestamp" in df._jdf.queryExecution().executedPlan().toString()


def test_append_and_rejected(spark, clinical, tmp_path):
    path = str(tmp_path / "t")
    append_table(clinical, path, "visit_date")
    append_table(clinical, path, "visit_date")
    assert spark.read.parquet(path).count() == 10
    assert append_rejected(clinical.limit(0), path) is False and append_rejected(clinical, path) is True
    assert spark.read.parquet(f"{path}_rejected").count() == 5


def test_replace_whole_and_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    replace_table(df, path, "p")
    replace_table(spark.createDataFrame([(9, "a")], "k int, p string"), path, "p", whole=False)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(2, "b"), (9, "a")]
    replace_table(spark.createDataFrame([(7, "c")], "k int, p string"), path, "p")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(7, "c")]


def test_clustered_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    write_clustered(spark.range(1000).selectExpr("id % 2 AS p", "(id * 7919) % 1000 AS k"), path, ["p"], ["k"])
    read = spark.read.parquet(path)
    for f in read.inputFiles():
        keys = [r["k"] for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)
    assert read.count() == 1000


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        append_table(spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 20) AS p", "uuid() AS v"), path, "p")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.read.parquet(path).where("p = 0").inputFiles()
    assert len([f for f in files if "/p=0/" in f]) > 1 and spark.read.parquet(path).count() == 300_000


def test_created_table_fills_defaults(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics")
    for _ in range(2):
        create_table(spark, "analytics.claims", CLAIMS_SCHEMA, str(tmp_path / "claims"), ["claim_date"], {"processed_at": "current_timestamp()"})
    spark.sql("INSERT INTO analytics.claims (claim_id, patient_id, claim_amount, claim_date) VALUES ('c', 'p', 1.5, date'2024-01-01')")
    row = spark.table("analytics.claims").first()
    assert row["claim_id"] == "c" and row["processed_at"] is not None
    spark.sql("DROP TABLE analytics.claims")


def test_outcomes_from_one_scan(spark, clinical, tmp_path):
    path = str(tmp_path / "o")
    tagged = with_outcome(clinical, clinical_rules(), as_of="2024-01-31")
    for _ in range(2):
        write_outcomes(tagged, path, batch_id=4)
    assert read_outcome(spark, path, VALID).count() == 2 and read_outcome(spark, path, REJECTED).count() == 3
    assert "failed_rules" not in read_outcome(spark, path, VALID).columns
    assert spark.read.parquet(f"{path}/outcome=valid").count() == 2


def test_batch_etl(spark, clinical, tmp_path, rows):
    source, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    clinical.write.parquet(source)
    run = run_batch_etl(spark, source, out, as_of="2024-01-31", run_log_path=log)
    assert (run.loaded, run.valid, run.rejected) == (5, 2, 3)
    valid = spark.read.parquet(run.valid_path)
    assert {"name", "dob"}.isdisjoint(valid.columns) and {"name_masked", "dob_masked", "processed_at"} <= set(valid.columns)
    assert rows(valid, "patient_id", "visit_date") == [("P1", dt.date(2024, 1, 15)), ("P5", None)]
    assert rows(spark.read.parquet(run.rejected_path), "patient_id", "failed_rules") == [
        ("P2", ["matches:diagnosis_code"]), ("P4", ["matches:diagnosis_code"]), (None, ["not_null:patient_id"])]
    metrics = dict(rows(spark.read.parquet(log), "metric", "value"))
    assert metrics["loaded"] == 5.0 and metrics["rejected"] == 3.0 and metrics["seconds"] > 0
    assert rows(spark.read.parquet(log), "run_id")[0][0] == run.run_id


def test_batch_etl_rejects_unparsed_text_without_leaking_it(spark, tmp_path):
    source, out = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text("P1,Ann,1990-01-01,A01,m,2024-01-15,DR1\nP2,Secret Name,notadate,A01,m,2024-01-15,DR1\n")
    run = run_batch_etl(spark, str(source), out, fmt="csv", as_of="2024-01-31")
    assert (run.loaded, run.valid, run.rejected) == (2, 1, 1)
    row = spark.read.parquet(run.rejected_path).first()
    assert row["failed_rules"] == ["parses"] and "Secret" not in str(row)


def test_a_batch_that_runs_again_replaces_its_rows(spark, clinical, tmp_path):
    clinical.write.parquet(str(tmp_path / "in"))
    for day in (20240130, 20240131, 20240131):
        run = run_batch_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), as_of="2024-01-31", batch_id=day)
    assert (run.loaded, spark.read.parquet(run.valid_path).count(), spark.read.parquet(run.rejected_path).count()) == (5, 4, 6)


def test_batch_etl_rules_before_mask(spark, clinical, tmp_path):
    clinical.write.parquet(str(tmp_path / "in"))
    run = run_batch_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), rules=[not_null("name")], rules_before_mask=True)
    assert (run.valid, run.rejected) == (4, 1)


def test_publish(spark, tmp_path):
    target = str(tmp_path / "t")
    good, bad = spark.range(10), spark.range(10).selectExpr("id % 5 AS id")
    result, n = publish_if_valid(good, [unique("id"), row_count(low=5)], target)
    assert n == 10 and result.count() == 2
    with pytest.raises(SuiteFailed):
        publish_if_valid(bad, [unique("id")], target)
    with pytest.raises(SuiteFailed, match="10 instead of 11"):
        publish_if_valid(good, [], target, expected_rows=11)
    assert spark.read.parquet(target).distinct().count() == 10


def test_publish_by_pointing_a_table(spark, tmp_path):
    create_table(spark, "published", spark.range(1).schema, str(tmp_path / "old"))
    publish_if_valid(spark.range(3), [row_count(low=1)], "published", str(tmp_path / "new"), as_table=True)
    assert spark.table("published").count() == 3
    with pytest.raises(SuiteFailed):
        publish_if_valid(spark.range(0), [row_count(low=1)], "published", str(tmp_path / "newer"), as_table=True)
    assert spark.table("published").count() == 3
    spark.sql("DROP TABLE published")


def test_migration(spark, tmp_path, rows):
    source = spark.createDataFrame([(1, "A@x", "d"), (2, "B@x", "d"), (3, None, "d")], "Customer_Id int, email string, created_at string")
    target, log = str(tmp_path / "t"), str(tmp_path / "log")
    run = run_migration(spark, lambda _: source, target, transform=lambda d: d.dropna(subset=["email"]), rules=[not_null("email")], run_log_path=log, keeps_rows=False)
    assert (run.extracted, run.published, run.counts_match) == (3, 2, False)
    with pytest.raises(SuiteFailed):
        run_migration(spark, lambda _: source, target, transform=lambda d: d.limit(1), keeps_rows=True)
    with pytest.raises(ValueError, match="email"):
        run_migration(spark, lambda _: source.drop("email"), target, run_log_path=log)
    assert spark.read.parquet(target).count() == 2
    assert rows(spark.read.parquet(log).where("metric = 'failed'"), "value") == [(1.0,)]


def test_post_load_gate(spark):
    schema = "patient_id string, admission_date date, load_timestamp timestamp"
    at = dt.datetime(2024, 1, 2, 3)
    good = spark.createDataFrame([("p", dt.date(2024, 1, 2), at), (None, dt.date(2030, 1, 1), dt.datetime(2024, 1, 1))], schema)
    enforce_gate(post_load_gate(good, "2024-01-02"))
    bad = spark.createDataFrame([(None, dt.date(2024, 1, 3), at)], schema)
    with pytest.raises(GateFailed, match="1 rows without id; 1 dates in the future"):
        enforce_gate(post_load_gate(bad, "2024-01-02"))
    with pytest.raises(GateFailed, match="no rows"):
        enforce_gate(post_load_gate(good, "2025-01-01"))


def test_only_scratch_can_be_dropped(spark, tmp_path):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    for other in (str(tmp_path), shared_folder(spark), f"{shared_folder(spark)}-other/x"):
        with pytest.raises(ValueError):
            drop_scratch(spark, other)


def test_empty_batch(spark, clinical, tmp_path):
    clinical.limit(0).write.parquet(str(tmp_path / "in"))
    run = run_batch_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), as_of="2024-01-31")
    assert (run.loaded, run.valid, run.rejected) == (0, 0, 0)


def executions(spark):
    """The SQL executions Spark still lists, by number; it forgets old ones, so their count tells nothing."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {runs.apply(i).executionId(): runs.apply(i) for i in range(runs.size())}


def scans(spark, since):
    """Physical plans of the SQL executions after the one numbered `since`, as text."""
    return [run.physicalPlanDescription() for n, run in sorted(executions(spark).items()) if n > since]


def test_batch_etl_reads_its_input_once(spark, clinical, tmp_path):
    source = str(tmp_path / "in")
    clinical.write.parquet(source)
    before = max(executions(spark))
    run_batch_etl(spark, source, str(tmp_path / "out"), as_of="2024-01-31")
    plans = scans(spark, before)
    assert len(plans) == 1
    assert plans[0].split("== Physical Plan ==")[-1].count("(1) Scan parquet") >= 1
    assert sum(line.startswith("(") and "Scan parquet" in line for line in plans[0].splitlines()) == 1


def test_session_helpers(spark):
    assert shuffle_partitions_for(100 << 40, 8) == 50_000 and shuffle_partitions_for(100 << 30, 8) == 100 and shuffle_partitions_for(1, 8) == 8
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{folder}/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")


# ---- interrupted changes -----------------------------------------------------------------------------------

class Stopped(Exception):
    pass


def stop_at(monkeypatch, step):
    """Make the `step`-th change of a folder fail."""
    left = [step]
    for name in ("rename", "delete"):
        def counted(self, *paths, f=getattr(files.Folders, name)):
            left[0] -= 1
            if left[0] < 0:
                raise Stopped
            return f(self, *paths)
        monkeypatch.setattr(files.Folders, name, counted)


@pytest.mark.parametrize("partition", [None, "p"])
def test_interrupted_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch, rows, partition):
    want = [("a", 2, "y"), ("b", 1, "x"), ("c", 1, "z")]
    stops = 0
    for step in range(40):
        path = str(tmp_path / f"t{step}")
        replace_table(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, v int, p string"), path, partition)
        changes = spark.createDataFrame([("a", 2, "y"), ("c", 1, "z")], "k string, v int, p string")
        merge = lambda: upsert_table(spark, path, changes, ["k"], "v", ["p"], partition)
        with monkeypatch.context() as m:
            stop_at(m, step)
            try:
                merge()
                done = True
            except Stopped:
                done, stops = False, stops + 1
        merge()
        assert rows(spark.read.parquet(path), "k", "v", "p") == want
        if done:
            break
    assert done and stops >= 3


def test_interrupted_refresh_keeps_old_or_new(spark, tmp_path, monkeypatch):
    for step in range(20):
        path = str(tmp_path / f"t{step}")
        replace_table(spark.range(3).toDF("i"), path)
        with monkeypatch.context() as m:
            stop_at(m, step)
            try:
                replace_table(spark.range(5).toDF("i"), path)
                done = True
            except Stopped:
                done = False
        files.recover(spark, path)
        assert spark.read.parquet(path).count() in (3, 5)
        replace_table(spark.read.parquet(path).limit(2), path)
        assert spark.read.parquet(path).count() == 2
        if done:
            return
    raise AssertionError


def test_a_corrected_batch_leaves_nothing_of_the_first(spark, tmp_path):
    rows = [("P1", "n", None, "A01", "m", dt.date(2024, 1, 1), "D"), ("P2", "n", None, None, "m", dt.date(2024, 1, 2), "D")]
    load = lambda data, **kw: (spark.createDataFrame(data, CLINICAL_SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "in")),
                               run_batch_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), **kw))[1]
    first = load(rows, batch_id=1)
    assert (first.valid, first.rejected) == (1, 1)
    second = load([rows[0], (*rows[1][:3], "B02", *rows[1][4:])], batch_id=1)
    assert (second.valid, second.rejected) == (2, 0)
    load(rows[:1], batch_id=2)
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.where("outcome = 'valid'").count() == 3 and kept.where("outcome = 'rejected'").count() == 0


def test_header_line_is_no_record(spark, tmp_path):
    (tmp_path / "in.csv").write_text("patient_id,name,dob,diagnosis_code,medication,visit_date,provider_id\nP1,n,2000-01-01,A01,m,2024-01-01,D\n")
    run = run_batch_etl(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), fmt="csv", options={"header": "true"})
    assert (run.loaded, run.valid, run.rejected) == (1, 1, 0)


def test_publishing_a_table_from_scratch_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="stage_path"):
        publish_if_valid(spark.range(1).toDF("i"), [], "some_table", as_table=True)
