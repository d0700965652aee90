"""Schema drift of landed JSON: fields nobody expected are kept, and runs are compared by their fields.

``read_rescued`` reads with the declared schema and keeps what it does not name in a VARIANT column.
``field_types`` says which fields a run's records have and of which type (one aggregate over the parsed
records, a row per field); stored per run, ``schema_drift`` compares a run with the last one before it
from these small tables alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail.schemas import CORRUPT_COL, with_corrupt
from contrail.sources.layers import last_run_before, read_run, write_run
from contrail.sources.snapshots import JSON_OPTIONS

RESCUED_COL = "_rescued"
FIELD_TYPES = T.StructType([T.StructField("field", T.StringType()), T.StructField("type", T.StringType()), T.StructField("records", T.LongType())])


def read_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with ``schema``, ``_corrupt_record`` and ``_rescued``: the fields that ``schema`` does not name, as a
    VARIANT object (NULL if there are none)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, **JSON_OPTIONS}
    named = [f.name for f in schema.fields]
    others = F.map_filter(F.from_json("value", "map<string,variant>"), lambda k, v: ~k.isin(named))
    read = spark.read.text(path).select(F.from_json("value", with_corrupt(schema), options).alias("r"), others.alias("o"))
    return read.select("r.*", F.when(F.size("o") > 0, F.parse_json(F.to_json("o"))).alias(RESCUED_COL))


def _kind(schema_text: Column) -> Column:
    """A variant's schema as one of number, string, boolean, object, array, mixed, or its own name; NULL if only null was seen."""
    s = schema_text
    return (F.when(s == "VOID", F.lit(None).cast("string"))
            .when(s.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"), "number")
            .when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array")
            .when(s == "VARIANT", "mixed").otherwise(F.lower(s)))


def field_types(lines: DataFrame) -> DataFrame:
    """``field, type, records`` of the top-level fields of JSON records (column ``value``). A value of JSON's null
    has the field but no type; lines that are no JSON object have no fields."""
    found = lines.sparkSession.sql("""
        SELECT v.key AS field, schema_of_variant_agg(v.value) AS seen, count(*) AS records
        FROM (SELECT try_parse_json(value) AS record FROM {lines}) l, LATERAL variant_explode(l.record) v
        WHERE v.key IS NOT NULL GROUP BY v.key""", lines=lines)
    return found.select("field", _kind(F.col("seen")).alias("type"), "records")


def note_fields(spark: SparkSession, landing: str, path: str, run_ts: dt.datetime | str) -> None:
    """Store the fields of one run's landed records."""
    write_run(field_types(spark.read.text(landing)), path, run_ts)


def schema_drift(spark: SparkSession, path: str, run_ts: dt.datetime | str) -> DataFrame:
    """What changed since the last run: ``field, change`` (new, vanished, retyped), ``before, after`` (types) and
    ``records`` (that have the field; of a vanished one, in the last run). Without an earlier run nothing changed; a
    field without a type in one of the runs is not retyped."""
    now = read_run(spark, path, run_ts, FIELD_TYPES)
    last = last_run_before(spark, path, run_ts, FIELD_TYPES)
    if last is None:
        last = now
    both = last.select("field", F.col("type").alias("before"), F.col("records").alias("was")).join(
        now.select("field", F.col("type").alias("after"), F.col("records").alias("are")), "field", "full")
    change = (F.when(F.col("was").isNull(), "new").when(F.col("are").isNull(), "vanished")
              .when(F.col("before") != F.col("after"), "retyped"))
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select(
        "field", "change", "before", "after", F.coalesce("are", "was").alias("records"))
