import pytest

from etlkit.operators import clinical_rules, split_literal, split_valid, with_outcome
from etlkit.operators.rules import between, expr_rule, in_set, matches, unique

SCHEMA = "patient_id string, diagnosis_code string"


def split(spark, data):
    return split_valid(spark.createDataFrame(data, SCHEMA), clinical_rules(), as_of="2024-01-31")


@pytest.mark.parametrize("code", ["K07", "A00", "Z90", "M59"])
def test_sound_codes(spark, code):
    valid, rejected = split(spark, [("P1", code)])
    assert (valid.count(), rejected.count()) == (1, 0)


@pytest.mark.parametrize("code", ["k07", "507", "-07", "KX7", "K0x", "K", "K0", "K070", "KK07", " K07", "K07 ", "", " ", "\n", "\u00c407", "K\u0660\u0667", None])
def test_unsound_codes(spark, code):
    valid, rejected = split(spark, [("P1", code)])
    assert (valid.count(), [r["failed_rules"] for r in rejected.collect()]) == (0, [["matches:diagnosis_code"]])


def test_trailing_newline_passes_as_in_java(spark):
    assert split(spark, [("P1", "K07\n")])[0].count() == 1


def test_null_ids(spark, rows):
    valid, rejected = split(spark, [(None, "K07"), ("u1", "K07"), (None, "M59"), (None, "A00"), ("", "Z90")])
    assert rows(valid, "patient_id") == [("",), ("u1",)] and rejected.count() == 3


def test_empty_input(spark):
    valid, rejected = split(spark, [])
    assert (valid.count(), rejected.count()) == (0, 0)


def test_rows_the_literal_split_loses_are_rejected(spark, rows):
    data = [("P1", "K07"), ("P2", None), (None, "M59"), ("P4", "K0x"), (None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    valid, rejected = split_valid(df, clinical_rules(), as_of="2024-01-31")
    assert rows(rejected, "patient_id", "failed_rules") == [
        ("P2", ["matches:diagnosis_code"]), ("P4", ["matches:diagnosis_code"]), (None, ["not_null:patient_id", "matches:diagnosis_code"]),
        (None, ["not_null:patient_id"])]
    assert valid.count() + rejected.count() == len(data)
    assert "processed_at" in rejected.columns
    literal_valid, literal_rejected = split_literal(df)
    assert literal_valid.count() + literal_rejected.count() == 3
    assert "processed_at" not in literal_rejected.columns


def test_outcome_agrees_with_split(spark, rows):
    df = spark.createDataFrame([("P1", "K07"), ("P2", None), (None, "x")], SCHEMA)
    tagged = with_outcome(df, clinical_rules(), as_of="2024-01-31")
    assert rows(tagged, "patient_id", "outcome") == [("P1", "valid"), ("P2", "rejected"), (None, "rejected")]


def test_rules_with_null_conditions_partition_the_table(spark):
    df = spark.range(100).selectExpr("if(id % 3 = 0, null, id) AS a", "if(id % 5 = 0, null, 'x') AS b")
    rules = [between("a", 10, 80), in_set("b", ["x"]), expr_rule("odd", "a % 2 = 1")]
    valid, rejected = split_valid(df, rules)
    assert valid.count() + rejected.count() == 100
    assert rejected.where("size(failed_rules) = 0").count() == 0


def test_only_row_rules(spark):
    with pytest.raises(ValueError, match="unique"):
        split_valid(spark.range(1), [unique("id")])
    with pytest.raises(ValueError):
        split_valid(spark.range(1), [])


def test_both_patterns(spark):
    df = spark.createDataFrame([("A01.5",)], "c string")
    assert split_valid(df, [matches("c", "^[A-Z][0-9]{2}$")])[0].count() == 0
    assert split_valid(df, [matches("c", r"^[A-Z][0-9]{2}(\.[0-9]{1,2})?$")])[0].count() == 1
