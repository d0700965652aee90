"""Landed snapshot sources: JSON lines with an explicit schema and a corrupt-record column.

The live feed is polled by an external collector that lands one file set per poll; the
job only ever reads landed files (batch here, Structured Streaming in
``contrail.streaming``). Corrupt input never stops a read: malformed and mistyped lines
keep their text in ``_corrupt_record`` and are routed to quarantine by the caller. Zone trees
are whole documents; a bad document or node goes to quarantine with its path, the others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from contrail.functions.columns import nullify_sentinel
from contrail.schemas import AIRPORTS, AIRPORTS_RAW, CORRUPT_COL, with_corrupt
from contrail.session import fresh_path

# Microsecond timestamps survive the JSON round trip (Spark's default keeps milliseconds).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """PERMISSIVE JSON-lines read; schema plus ``_corrupt_record``."""
    return (spark.read.schema(with_corrupt(schema))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .options(**JSON_OPTIONS)
            .json(path))


def land_json(df: DataFrame, path: str) -> str:
    """Write ``df`` as JSON lines (test and fixture helper standing in for the collector)."""
    df.write.mode("overwrite").options(**JSON_OPTIONS).json(path)
    return path


def land_text(df: DataFrame, path: str, col: str = "value") -> str:
    df.select(col).write.mode("overwrite").text(path)
    return path


def typed_airports(raw: DataFrame, keep=()) -> DataFrame:
    """Loosely typed airport records -> ``AIRPORTS`` types with ``try_cast``.

    Text 'None'/'N/A'/'NaN'/'' becomes NULL first; a value that does not parse becomes
    NULL instead of failing the job.
    """
    cols = []
    for f in AIRPORTS.fields:
        c = nullify_sentinel(F.col(f.name).cast("string"))
        cols.append(c.try_cast(f.dataType).alias(f.name) if f.dataType != T.StringType() else c.alias(f.name))
    return raw.select(*cols, *keep)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Landed airports (every field as text) -> typed frame (quarantine column kept)."""
    raw = read_snapshots(spark, path, AIRPORTS_RAW)
    return typed_airports(raw, keep=[CORRUPT_COL])


# ------------------------------------------------------------------ zone trees

CORNERS = ("tl_y", "tl_x", "br_y", "br_x")
MAX_DEPTH = 50  # levels of a zone tree; Spark's own limit of a recursive query is 100


def read_zone_docs(spark: SparkSession, path: str) -> DataFrame:
    """Landed zone documents: ``file, line, value``. A file that is one JSON value (pretty-printed or not) is one
    document; any other file is read as JSON lines, a document each."""
    files = (spark.read.text(path, wholetext=True, recursiveFileLookup=True)
             .select(F.col("_metadata.file_path").alias("file"), "value"))
    lines = F.filter(F.transform(F.split("value", "\r?\n"), lambda x, i: F.struct(i.alias("line"), x.alias("value"))), lambda x: F.trim(x["value"]) != "")
    whole = F.array(F.struct(F.lit(0).alias("line"), F.col("value").alias("value")))
    single = F.try_parse_json("value").isNotNull() & (F.size(lines) > 1) & F.get(lines, F.lit(0))["value"].rlike(r"^\s*[{\[]\s*$")
    return files.select("file", F.explode(F.when(single, whole).otherwise(lines)).alias("d")).select("file", "d.line", "d.value")


def _children(json: str) -> str:
    """The entries of a JSON object in the order of the document (a variant would sort them)."""
    return f"posexplode(from_json({json}, 'map<string,string>'))"


ZONE_NODES_SQL = """
WITH RECURSIVE z(file, line, path, position, zone_name, parent_zone, depth, node) AS (
  SELECT d.file, d.line, concat('$.', e.k), array(e.pos), e.k, CAST(NULL AS STRING), 0, e.v
  FROM {docs} d, LATERAL """ + _children("d.value") + """ e(pos, k, v)
  UNION ALL
  SELECT z.file, z.line, concat(z.path, '.subzones.', e.k), concat(z.position, array(e.pos)), e.k, z.zone_name, z.depth + 1, e.v
  FROM z, LATERAL """ + _children("get_json_object(z.node, '$.subzones')") + """ e(pos, k, v)
  WHERE z.depth + 1 < {limit}
)
SELECT file, line, path, position, zone_name, parent_zone, depth, node FROM z"""


def zone_nodes(docs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Every node of the zone trees, parent first, with what is wrong with it:
    ``file, line, path, position, zone_name, parent_zone, depth, tl_y, tl_x, br_y, br_x, problem, below, node``.

    Documents are objects ``{name: {tl_y, tl_x, br_y, br_x, subzones: {...}}}``, ``max_depth`` levels at most. ``position``
    orders the nodes of a document as they stand in it (a parent before its subzones). ``problem`` says why the node is
    no zone (it is not an object, a corner is missing or no number), ``below`` why its subzones are not read; both are NULL
    for a good node. A document that is no object is one row with the path ``$``. ``node`` is the
    node as VARIANT. A recursive query over the JSON text.
    """
    spark = docs.sparkSession
    if "file" not in docs.columns:
        docs = docs.select(F.lit(None).cast("string").alias("file"), F.lit(0).alias("line"), "value")
    docs = docs.withColumn("value", F.col("value").cast("string"))
    nodes = spark.sql(ZONE_NODES_SQL, docs=docs, limit=max_depth)
    corner = {c: F.get_json_object("node", f"$.{c}").try_cast("double") for c in CORNERS}
    is_object = lambda c: F.coalesce(F.from_json(c, "map<string,string>").isNotNull(), F.lit(False))
    problem = F.when(~is_object(F.col("node")), F.lit("not an object"))
    for c in CORNERS:
        problem = problem.when(F.col(c).isNull() | F.isnan(c), F.lit(f"{c} is missing or no number"))
    inner = F.get_json_object("node", "$.subzones")
    below = (F.when(inner.isNotNull() & ~is_object(inner), F.lit("subzones is not an object"))
             .when((F.col("depth") + 1 >= max_depth) & (F.size(F.from_json(inner, "map<string,string>")) > 0), F.lit(f"deeper than {max_depth} levels")))
    tree = nodes.withColumns(corner).withColumns({"problem": problem, "below": below})
    broken = docs.where(~is_object(F.col("value"))).select(
        "file", "line", F.lit("$").alias("path"), F.array().cast("array<int>").alias("position"), F.lit(None).cast("string").alias("zone_name"),
        F.lit(None).cast("string").alias("parent_zone"), F.lit(0).alias("depth"), F.col("value").alias("node"),
        *[F.lit(None).cast("double").alias(c) for c in CORNERS],
        F.when(F.try_parse_json("value").isNull(), F.lit("not JSON")).otherwise(F.lit("not an object")).alias("problem"), F.lit(None).cast("string").alias("below"))
    both = tree.unionByName(broken)
    return both.select("file", "line", "path", "position", "zone_name", "parent_zone", "depth", *CORNERS, "problem", "below",
                       F.coalesce(F.try_parse_json("node"), F.expr("to_variant_object(named_struct('text', node))")).alias("node"))


def flatten_zones(docs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The good nodes of the zone trees, one row per zone: ``zone_name, parent_zone, depth, tl_y, tl_x, br_y, br_x``."""
    return zone_nodes(docs, max_depth).where(F.col("problem").isNull()).select("zone_name", "parent_zone", "depth", *CORNERS)


def zone_quarantine(nodes: DataFrame) -> DataFrame:
    """What ``zone_nodes`` found wrong: ``file, line, path, problem, node`` (VARIANT), a row per problem."""
    problems = F.filter(F.array("problem", "below"), lambda p: p.isNotNull())
    return nodes.select("file", "line", "path", F.explode(problems).alias("problem"), "node")


def zones_in_order(nodes: DataFrame) -> DataFrame:
    """The good nodes with ``zone_order``: their place in the documents (by file, line and position, from 0), so that of
    two overlapping zones the later one in the tree wins, a subzone over its parent. Zones are a table written by
    hand: one task numbers them. They are written once, so that documents are not parsed again for every use."""
    place = F.row_number().over(Window.orderBy("file", "line", "position")) - 1
    zones = nodes.where(F.col("problem").isNull()).withColumn("zone_order", place.cast("int")).select(
        "zone_name", "parent_zone", "depth", "zone_order", *CORNERS)
    path = fresh_path(nodes.sparkSession, "zones")
    zones.write.parquet(path)
    return nodes.sparkSession.read.schema(zones.schema).parquet(path)
