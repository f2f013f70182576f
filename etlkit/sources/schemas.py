"""Schemas of the tables the toolkit knows by name."""

from pyspark.sql import types as T

CLINICAL_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("dob", T.DateType()),
    T.StructField("diagnosis_code", T.StringType()),
    T.StructField("medication", T.StringType()),
    T.StructField("visit_date", T.DateType()),
    T.StructField("provider_id", T.StringType()),
])

CLAIMS_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType(), False),
    T.StructField("patient_id", T.StringType()),
    T.StructField("claim_amount", T.DecimalType(38, 9)),
    T.StructField("claim_date", T.DateType()),
    T.StructField("processed_at", T.TimestampType()),
])

DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.LongType(), False),
    T.StructField("full_date", T.DateType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("month", T.LongType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("quarter", T.LongType()),
    T.StructField("year", T.LongType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_holiday", T.BooleanType()),
])

DIM_PATIENT_SCHEMA = T.StructType([
    T.StructField("patient_key", T.LongType(), False),
    T.StructField("patient_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("date_of_birth", T.DateType()),
    T.StructField("gender", T.StringType()),
    T.StructField("insurance_type", T.StringType()),
    T.StructField("effective_date", T.DateType()),
    T.StructField("expiration_date", T.DateType()),
])

FACT_CLAIMS_SCHEMA = T.StructType([
    T.StructField("claim_key", T.LongType(), False),
    T.StructField("claim_id", T.StringType()),
    T.StructField("patient_key", T.LongType()),
    T.StructField("date_key", T.LongType()),
    T.StructField("provider_key", T.LongType()),
    T.StructField("claim_amount", T.DecimalType(38, 9)),
    T.StructField("paid_amount", T.DecimalType(38, 9)),
    T.StructField("claim_status", T.StringType()),
])

CLINICAL_EVENT_SCHEMA = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("provider_id", T.StringType()),
])

# What a message source delivers, whichever transport carries it.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])
