"""Avro record values of topics whose schemas are kept in a registry.

Such a value is one zero byte, a four-byte schema id, then the Avro record. The
framing is plain Spark; the record itself needs the spark-avro package on the
cluster, and the schema (JSON) is passed in by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Framing of registry-encoded values. Fixed values.
MAGIC = "00"
HEADER_BYTES = 5


def frame(payload: Column, schema_id: int) -> Column:
    header = F.unhex(F.concat(F.lit(MAGIC), F.lpad(F.hex(F.lit(schema_id)), 8, "0")))
    return F.concat(header, payload)


def schema_id(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.conv(F.substring(F.hex(value), 3, 8), 16, 10).cast("int")


def payload(value: Column | str) -> Column:
    """The record bytes; a value without the leading zero byte fails the query."""
    value = F.col(value) if isinstance(value, str) else value
    framed = F.substring(F.hex(value), 1, 2) == MAGIC
    return F.when(
        framed, F.substring(value, HEADER_BYTES + 1, 2_147_483_647)
    ).otherwise(F.raise_error(F.lit("value does not start with the framing byte")).cast("binary"))


def decode_records(topic_rows: DataFrame, schema_json: str) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    rest = [c for c in topic_rows.columns if c != "value"]
    record = from_avro(payload("value"), schema_json)
    return topic_rows.select(record.alias("r"), *rest).select("r.*", *rest)


def encode_records(df: DataFrame, schema_json: str, registered_as: int) -> DataFrame:
    from pyspark.sql.avro.functions import to_avro

    record = to_avro(F.struct(*df.columns), schema_json)
    return df.select(frame(record, registered_as).alias("value"))
