"""Versions, totals from changes, late loads, dead letters: also when any step fails."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from etlkit.operators import SuiteFailed, maintain_rollup, monthly_rollup, signed_rollup, signed_rows
from etlkit.operators.rules import between, matches
from etlkit.plans import QUARANTINED, apply_batch_to_rollup, collect_dead_letters, letters_of, load_committed, replay_dead_letters
from etlkit.sinks import REJECTED, VALID, VersionConflict, drop_old_versions, files, publish_version, read_version, roll_back, version, versions

D = dt.date


class Crash(Exception):
    pass


def crashing(monkeypatch, after):
    """Every change of the file system by `Folders`, and every write of rows, counts; the one numbered `after` fails, before or after it is done."""
    steps = {"n": 0}

    def wrap(name):
        real = getattr(files.Folders, name)

        def step(self, *args):
            steps["n"] += 1
            if steps["n"] == after and after % 2:
                raise Crash(name)
            out = real(self, *args)
            if steps["n"] == after:
                raise Crash(name)
            return out
        monkeypatch.setattr(files.Folders, name, step)

    for name in ("create_if_absent", "delete", "rename", "write"):
        wrap(name)
    return steps


# ---- versions ----------------------------------------------------------------------------------------------

def test_readers_meet_a_whole_table(spark, tmp_path):
    path, first, second = str(tmp_path / "t"), spark.range(10), spark.range(5).selectExpr("id", "id * 2 AS more")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert version(spark, path) is None
    publish_version(first, path)
    reader = read_version(spark, path)
    publish_version(second, path, meta={"k": 1})
    assert reader.count() == 10 and read_version(spark, path).columns == ["id", "more"]
    assert version(spark, path).meta == {"k": 1} and version(spark, path).rows == 5
    publish_version(read_version(spark, path).where("id > 2"), path)
    assert [read_version(spark, path, n).count() for n in versions(spark, path)] == [10, 5, 2]
    assert roll_back(spark, path, 1).number == 4 and read_version(spark, path).count() == 10


def test_conflicts_and_failed_rules_publish_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(3), path)
    publish_version(spark.range(4), path, made_from=1)
    with pytest.raises(VersionConflict):
        publish_version(spark.range(9), path, made_from=1)
    with pytest.raises(SuiteFailed):
        publish_version(spark.range(9), path, [between("id", 0, 5)])
    with pytest.raises(SuiteFailed):
        publish_version(spark.range(9), path, expected_rows=8)
    assert versions(spark, path) == [1, 2] and read_version(spark, path).count() == 4
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


@pytest.mark.parametrize("step", range(1, 5))
def test_a_publication_that_fails_at_any_step(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    publish_version(spark.range(3), path)
    with monkeypatch.context() as m:
        steps = crashing(m, step)
        try:
            publish_version(spark.range(4), path)
            crashed = False
        except Crash:
            crashed = True
        assert crashed == (steps["n"] >= step)
    assert read_version(spark, path).count() in ((3, 4) if crashed else (4,))
    publish_version(spark.range(5), path)
    assert read_version(spark, path).count() == 5 and versions(spark, path) == list(range(1, len(versions(spark, path)) + 1))


@pytest.mark.parametrize("step", range(1, 8))
def test_dropping_old_versions_that_fails_at_any_step(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        publish_version(spark.range(n), path)
    roll_back(spark, path, 2)
    with monkeypatch.context() as m:
        crashing(m, step)
        try:
            drop_old_versions(spark, path, 2)
        except Crash:
            pass
    assert [read_version(spark, path, n).count() == version(spark, path, n).rows for n in versions(spark, path)] == [True] * len(versions(spark, path))
    drop_old_versions(spark, path, 2)
    assert versions(spark, path) == [5, 6] and read_version(spark, path).count() == 2 and read_version(spark, path, 5).count() == 5
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_only_one_of_many_gets_a_name(spark, tmp_path):
    folders = files.Folders(spark, str(tmp_path))
    assert [folders.create_if_absent(str(tmp_path / "d" / "x"), str(n)) for n in range(4)] == [True, False, False, False]
    assert folders.read(str(tmp_path / "d" / "x")) == "0" and folders.children(str(tmp_path / "d")) == ["x"]


# ---- totals ------------------------------------------------------------------------------------------------

CLAIM = "claim_id int, claim_date date, claim_amount double"


def change_batches(rng, table, batches):
    """Random changes of `table` (id: (date, amount)), which is changed along."""
    for _ in range(batches):
        batch = []
        for _ in range(rng.randrange(1, 25)):
            k = rng.randrange(40)
            old, new = table.get(k), None
            if old is None or rng.random() < 0.7:
                new = (rng.choice([None, D(2024, rng.randrange(1, 5), 3)]), rng.choice([None, 1.25, -3.5, rng.randrange(100) / 4]))
            if old == new is None:
                continue
            batch.append((len(batch), (k, *old) if old else None, (k, *new) if new else None))
            table.pop(k, None)
            if new:
                table[k] = new
        yield batch


@pytest.mark.parametrize("seed", range(2))
def test_totals_from_changes_equal_recomputed_ones(spark, rows, tmp_path, seed):
    rng, table, path = random.Random(seed), {}, str(tmp_path / "totals")
    frame = lambda t: spark.createDataFrame([(k, *v) for k, v in t.items()], CLAIM)
    publish_version(monthly_rollup(frame(table)), path)
    for batch_id, batch in enumerate(change_batches(rng, table, 5)):
        changes = spark.createDataFrame(batch + rng.sample(batch, len(batch) // 2), f"seq int, before struct<{CLAIM.replace(' ', ':')}>, after struct<{CLAIM.replace(' ', ':')}>".replace(",:", ","))
        for again in ([batch_id], [batch_id, 0, batch_id])[batch_id % 2]:
            apply_batch_to_rollup(spark, path, changes, again, once=["seq"])
        assert rows(read_version(spark, path)) == rows(monthly_rollup(frame(table)))


def test_months_without_rows_disappear_and_foreign_changes_fail(spark):
    one = spark.createDataFrame([(1, D(2024, 1, 5), 2.0), (2, D(2024, 2, 5), None)], CLAIM)
    gone = signed_rollup(one.withColumn("_sign", F.lit(-1)))
    assert maintain_rollup(monthly_rollup(one), gone).collect() == []
    assert [tuple(r) for r in maintain_rollup(monthly_rollup(one), gone.where("claim_month = '2024-01-01'")).collect()] == [(D(2024, 2, 1), 1, 0, None, None)]
    with pytest.raises(Exception, match="do not belong"):
        maintain_rollup(monthly_rollup(one.where("claim_id = 1")), gone).collect()
    image = F.struct("claim_id", "claim_date", "claim_amount")
    still = signed_rollup(signed_rows(one.select(image.alias("before"), image.alias("after"))))
    assert still.collect() == []


# ---- late loads --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(2))
def test_rows_that_commit_late_come_once(spark, tmp_path, monkeypatch, seed):
    """Rows become visible up to three hours after their time, some in two versions; loads fail at random steps and run again."""
    rng, target, state = random.Random(seed), str(tmp_path / "t"), str(tmp_path / "s")
    start = dt.datetime(2024, 1, 1)
    made = []  # (visible from, row)
    for k in range(80):
        at = rng.randrange(0, 40 * 3600)
        made.append((at + rng.randrange(0, 3 * 3600), (k, start + dt.timedelta(seconds=at), f"v{k % 3}")))
        if k % 5 == 0:
            made.append((at + 3600 + rng.randrange(0, 3600), (k, start + dt.timedelta(seconds=at + 60), "next")))
    for now in range(0, 48 * 3600, 8 * 3600):
        visible = [r for t, r in made if t <= now]
        source = spark.createDataFrame(visible, "k int, ts timestamp, v string")
        with monkeypatch.context() as m:
            crashing(m, rng.randrange(1, 5))
            try:
                load_committed(spark, source, target, state, ["k"], "ts", "4 hours")
            except Crash:
                pass
        load_committed(spark, source, target, state, ["k"], "ts", "4 hours")
        assert load_committed(spark, source, target, state, ["k"], "ts", "4 hours") == 0
        got = [(r.k, r.v) for r in spark.read.schema("k int, ts timestamp, v string, load int").parquet(target).collect()]
        assert sorted(got) == sorted((k, v) for k, _, v in visible)
    held = read_version(spark, state)
    assert held.count() < len(made) and "ts" in held.columns


# ---- dead letters ------------------------------------------------------------------------------------------

def sides(spark, path):
    counts = {r["outcome"]: r["count"] for r in read_version(spark, path).groupBy("outcome").count().collect()}
    return counts.get(VALID, 0), counts.get(REJECTED, 0), counts.get(QUARANTINED, 0)


@pytest.mark.parametrize("step", range(1, 4))
def test_letters_move_once_whatever_fails(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "letters")
    letters = spark.createDataFrame([(k, f"{'ABC'[k % 3]}{k % 5}") for k in range(30)] * 2, "id int, code string")
    collect_dead_letters(letters, path, "id")
    collect_dead_letters(letters.where("id < 7"), path, "id")
    assert sides(spark, path) == (0, 30, 0)
    for replay, letter in ((1, "A"), (2, "B")):
        with monkeypatch.context() as m:
            crashing(m, step)
            try:
                replay_dead_letters(spark, path, [matches("code", f"^{letter}")], replay, most_attempts=4)
            except Crash:
                pass
        assert sum(sides(spark, path)) == 30
        for _ in range(2):
            replay_dead_letters(spark, path, [matches("code", f"^{letter}")], replay, most_attempts=4)
        assert sides(spark, path) == (10 * replay, 30 - 10 * replay, 0)
        assert {r.code[0] for r in letters_of(spark, path, VALID, replay).collect()} == {letter}
    late = collect_dead_letters(spark.createDataFrame([(99, "D1"), (3, "changed")], "id int, code string"), path, "id")
    assert late.rows == 31
    replay_dead_letters(spark, path, [matches("code", "^[AB]")], 3, most_attempts=4)
    assert sides(spark, path) == (20, 1, 10)
    replay_dead_letters(spark, path, [matches("code", "^E")], 4, most_attempts=4, repair={"code": F.concat(F.lit("E"), "code")})
    assert sides(spark, path) == (21, 0, 10)
    assert {tuple(r.failed_rules) for r in letters_of(spark, path, QUARANTINED).collect()} == {("matches:code",)}
