"""Column contracts of the tables the audit reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Required source columns and the result table's columns.
REQUIRED_SOURCE_COLUMNS = ("DOC_IDN", "LINK", "PERIODO_PRODUCCION", "FECHA_INGRESO")

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("DOC_IDN", T.LongType(), False),
        T.StructField("LINK", T.StringType(), True),
        T.StructField("PERIODO_PRODUCCION", T.DateType(), True),
        T.StructField("FECHA_INGRESO", T.TimestampType(), True),
        T.StructField("METADATA_CREATOR", T.StringType(), True),
        T.StructField("METADATA_PRODUCER", T.StringType(), True),
        T.StructField("METADATA_CREADATE", T.StringType(), True),
        T.StructField("METADATA_MODDATE", T.StringType(), True),
        T.StructField("ES_METADATA", T.BooleanType(), True),
        T.StructField("AFP", T.StringType(), True),
        T.StructField("ES_CERT_COT", T.BooleanType(), True),
        T.StructField("CODVER", T.StringType(), True),
        T.StructField("RUT", T.StringType(), True),
        T.StructField("RUT_L11", T.StringType(), True),
        T.StructField("RES_AFP", T.StringType(), True),
        T.StructField("ES_DIF", T.BooleanType(), True),
        T.StructField("RES_DIF", T.StringType(), True),
        T.StructField("FECHA_PROCESO", T.TimestampType(), False),
    ]
)

# Landed documents: one row per download attempt, newest attempt wins.
LANDED_KEY = ("link",)
LANDED_COLUMNS = ("http_status", "text", "creator", "producer", "creation_date", "mod_date")

# Landed issuer responses: one row per request made, newest answer wins.
RESPONSE_KEY = ("afp", "request_key")
RESPONSE_COLUMNS = ("http_status", "body", "document_text")

LANDED_AT = "landed_at"
