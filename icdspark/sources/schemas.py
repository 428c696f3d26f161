"""Explicit schemas for the clinical CSV inputs (bronze: every column a string)."""

from pyspark.sql import types as T

CODES_CSV = T.StructType([
    T.StructField("ROW_ID", T.StringType()),
    T.StructField("SUBJECT_ID", T.StringType()),
    T.StructField("HADM_ID", T.StringType()),
    T.StructField("SEQ_NUM", T.StringType()),
    T.StructField("ICD9_CODE", T.StringType()),
])

NOTES_CSV = T.StructType([
    T.StructField("ROW_ID", T.StringType()),
    T.StructField("SUBJECT_ID", T.StringType()),
    T.StructField("HADM_ID", T.StringType()),
    T.StructField("CHARTDATE", T.StringType()),
    T.StructField("CHARTTIME", T.StringType()),
    T.StructField("STORETIME", T.StringType()),
    T.StructField("CATEGORY", T.StringType()),
    T.StructField("DESCRIPTION", T.StringType()),
    T.StructField("CGID", T.StringType()),
    T.StructField("ISERROR", T.StringType()),
    T.StructField("TEXT", T.StringType()),
])

LABELLED = T.StructType([
    T.StructField("subject_id", T.LongType()),
    T.StructField("hadm_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("labels", T.StringType()),
])

LABEL_FREQUENCY = "label string, frequency long"
LABEL_LIST = "label string"
