import pytest
from pyspark.sql import functions as F

from etlkit.functions import add_audit, convert_types, mask_columns, masking_check, spark_type, split_converted

JOHN = "6cea57c2fb6cbc2a40411135005760f241fffc3e5e67ab99882726431037f908"


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("P1", "John Doe", "1-2"), ("P2", None, "3-4")], "patient_id string, name string, ssn string")


def test_masked_columns_come_last_in_the_order_listed(people):
    assert mask_columns(people, ["ssn", "name"]).columns == ["patient_id", "ssn_masked", "name_masked"]


def test_digest_value_and_null(people, rows):
    assert rows(mask_columns(people, ["name"]), "patient_id", "name_masked") == [("P1", JOHN), ("P2", None)]


def test_missing_column(people):
    with pytest.raises(ValueError, match="dob"):
        mask_columns(people, ["name", "dob"])
    assert mask_columns(people, ["name", "dob"], on_missing="skip").columns == ["patient_id", "ssn", "name_masked"]
    assert mask_columns(people, ["dob"], on_missing="skip").columns == people.columns


def test_salt_changes_the_digest_but_not_null(people, rows):
    salted = dict(rows(mask_columns(people, ["name"], salt="s"), "patient_id", "name_masked"))
    assert salted["P1"] != JOHN and len(salted["P1"]) == 64 and salted["P2"] is None


def test_masking_keeps_rows_and_is_deterministic(people, rows):
    assert rows(mask_columns(people, ["name"])) == rows(mask_columns(people, ["name"]))
    assert mask_columns(people, ["name"]).count() == 2


def test_check_finds_what_is_wrong(people, rows):
    good = mask_columns(people, ["name", "ssn"])
    assert all(r["passed"] for r in masking_check(good, ["name", "ssn"], people, ["patient_id"]).collect())
    kept = good.withColumn("name", F.lit("x"))
    assert rows(masking_check(kept, ["name"]), "original_removed", "passed") == [(False, False)]
    plain = people.withColumnRenamed("ssn", "ssn_masked").drop("name")
    report = masking_check(plain, ["ssn"], people, ["patient_id"]).first()
    assert (report["not_digest"], report["leaked_values"], report["passed"]) == (2, 2, False)
    assert masking_check(people, ["dob"]).first()["passed"] is False


def test_audit_time_is_an_argument(people):
    stamped = add_audit(people, "2024-01-31 10:00:00").select(F.col("processed_at").cast("string")).distinct().collect()
    assert [r[0] for r in stamped] == ["2024-01-31 10:00:00"]


def test_type_map():
    assert spark_type("VARCHAR(20)") == "string" and spark_type("BYTEINT") == "bigint"
    assert spark_type("DECIMAL(18, 2)") == "decimal(18,2)" and spark_type("decimal") == "decimal(38,9)"
    assert spark_type("TIMESTAMP(6)") == "timestamp" and spark_type("FLOAT") == "double"
    with pytest.raises(ValueError):
        spark_type("PERIOD")


def test_convert_keeps_rows_and_names_failures(spark, rows):
    df = spark.createDataFrame([("1", "ab  ", "x"), ("no", "c", None)], "n string, c string, d string")
    types = {"n": "INTEGER", "c": "CHAR(4)", "d": "DATE"}
    assert rows(convert_types(df, types)) == [(1, "ab", None, ["d"]), (None, "c", None, ["n"])]
    good, bad = split_converted(df, types)
    assert good.count() == 0 and bad.count() == 2
    assert good.schema.simpleString() == "struct<n:bigint,c:string,d:date>"
