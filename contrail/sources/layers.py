"""Bronze / Silver / Gold folders with kata naming, written per run.

Layout: ``<base>/<layer>/<dataset>/tech_year=YYYY/tech_month=YYYY-MM/tech_day=YYYY-MM-DD/tech_hour=H``.
A job's runs have their own folder below the hour (``tech_run=<time>``), so runs of one hour stay
apart. A run is published as a whole: its rows are written beside the earlier ones, below
``version=<id>``, and only then a marker (an empty file below ``_published``, one atomic creation)
names that version; readers take the version that the last marker names. A write that fails
leaves no marker, so the last good rows stay; an empty re-run leaves nothing old. What a newer
version replaces is deleted after the publication.

The folders are the directory of runs: ``lookup`` opens the folder of its (date, hour), and
``last_run_before`` walks back from its run, newest first; neither lists the history.
``write_layer`` (many runs at once, backfills) uses dynamic partition overwrite, which replaces
the partitions that have rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail.functions.columns import RUN_COLUMNS, run_columns, run_ts_literal

RUN_SCHEMA = T.StructType([
    T.StructField("tech_year", T.IntegerType()),
    T.StructField("tech_month", T.StringType()),
    T.StructField("tech_day", T.DateType()),
    T.StructField("tech_hour", T.IntegerType()),
])


def stamp_run(df: DataFrame, run_ts: dt.datetime | str | Column) -> DataFrame:
    """Adds the run columns from one run timestamp (a literal, or a column for backfills)."""
    ts = run_ts if isinstance(run_ts, Column) else run_ts_literal(run_ts)
    return df.withColumns(run_columns(ts))


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", partition_cols=RUN_COLUMNS,
                header: bool = True) -> None:
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).format(fmt))
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


# ------------------------------------------------------------------ one run's folder

RUN_ID = "tech_run"  # below the hour: runs of the same hour stay apart
VERSION = "version"  # below the run: what one write made
MARKERS = "_published"  # beside the versions; hidden from Spark's listings


def _time(run_ts: dt.datetime | str) -> dt.datetime:
    return dt.datetime.fromisoformat(run_ts) if isinstance(run_ts, str) else run_ts


def run_id(run_ts: dt.datetime | str) -> str:
    ts = _time(run_ts)
    return ts.strftime("%Y%m%dT%H%M%S") + (f"_{ts.microsecond:06d}" if ts.microsecond else "")


def run_time(name: str) -> dt.datetime:
    """The time that :func:`run_id` named."""
    return dt.datetime.strptime(name, "%Y%m%dT%H%M%S_%f" if "_" in name else "%Y%m%dT%H%M%S")


def _hour_steps(ts: dt.datetime) -> list[tuple[str, int | str]]:
    return [("tech_year", ts.year), ("tech_month", f"{ts:%Y-%m}"), ("tech_day", f"{ts:%Y-%m-%d}"), ("tech_hour", ts.hour)]


def _folder(path: str, steps: list[tuple[str, int | str]]) -> str:
    return "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in steps]])


def run_path(path: str, run_ts: dt.datetime | str) -> str:
    """The folder of one run: kata naming, then the run itself."""
    return _folder(path, [*_hour_steps(_time(run_ts)), (RUN_ID, run_id(run_ts))])


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder, hidden ones included; none if it does not exist."""
    fs, p = _store(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _store(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _store(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; one that is there already stays."""
    fs, p = _store(spark, path)
    fs.create(p, True).close()


def publish(spark: SparkSession, home: str, version: str) -> None:
    """Make ``version`` the rows of ``home``: one empty file, created at once. Then what it replaces goes."""
    earlier = [m for m in names_in(spark, f"{home}/{MARKERS}") if not m.startswith(".")]
    number = int(earlier[-1].split(".")[0]) + 1 if earlier else 1
    fs, p = _store(spark, f"{home}/{MARKERS}/{number:08d}.{version}")
    fs.create(p, False).close()
    for marker in earlier:
        delete(spark, f"{home}/{VERSION}={marker.split('.')[1]}")
        delete(spark, f"{home}/{MARKERS}/{marker}")


def published(spark: SparkSession, home: str) -> str | None:
    """The folder of the published rows, None before the first publication."""
    markers = [m for m in names_in(spark, f"{home}/{MARKERS}") if not m.startswith(".")]
    return f"{home}/{VERSION}={markers[-1].split('.')[1]}" if markers else None


def write_run(df: DataFrame, path: str, run_ts: dt.datetime | str, fmt: str = "parquet", part: str = "",
              header: bool = True) -> None:
    """Write one run (or one ``part`` of it) beside what is there and publish it as a whole."""
    home, version = run_path(path, run_ts) + (f"/{part}" if part else ""), uuid.uuid4().hex
    w = df.write.format(fmt)
    (w.option("header", header) if fmt == "csv" else w).save(f"{home}/{VERSION}={version}")
    publish(df.sparkSession, home, version)


def read_run(spark: SparkSession, path: str, run_ts: dt.datetime | str, data_schema: T.StructType | None = None,
             parts: bool = False, fmt: str = "parquet", header: bool = True) -> DataFrame:
    """The published rows of one run (``parts``: of all its parts); only its folder is listed."""
    home = run_path(path, run_ts)
    homes = [f"{home}/{n}" for n in names_in(spark, home) if not n.startswith(("_", "."))] if parts else [home]
    folders = [f for f in (published(spark, h) for h in homes) if f is not None]
    if not folders:
        raise FileNotFoundError(f"no published run in {home}")
    r = spark.read.format(fmt)
    r = r.option("header", header) if fmt == "csv" else r
    return (r.schema(data_schema) if data_schema is not None else r).load(folders)


# ------------------------------------------------------------------ the directory of runs

def _value(name: str) -> int | str:
    v = name.split("=", 1)[1]
    return int(v) if v.isdigit() else v


def runs_before(spark: SparkSession, path: str, run_ts: dt.datetime | str) -> Iterator[str]:
    """Folders of the runs before ``run_ts``, newest first. Folders are listed as they are reached."""
    steps = [*_hour_steps(_time(run_ts)), (RUN_ID, run_id(run_ts))]

    def walk(folder: str, depth: int, edge: bool) -> Iterator[str]:
        key, limit = steps[depth]
        last = depth == len(steps) - 1
        found = sorted((n for n in names_in(spark, folder) if n.startswith(f"{key}=")), key=_value, reverse=True)
        for n in found:
            if edge and (_value(n) > limit or last and _value(n) == limit):
                continue
            if last:
                yield f"{folder}/{n}"
            else:
                yield from walk(f"{folder}/{n}", depth + 1, edge and _value(n) == limit)

    yield from walk(path.rstrip("/"), 0, True)


def last_run_before(spark: SparkSession, path: str, run_ts: dt.datetime | str, data_schema: T.StructType) -> DataFrame | None:
    """Published rows of the newest earlier run, None without one (used only where a source failed)."""
    for home in runs_before(spark, path, run_ts):
        folder = published(spark, home)
        if folder is not None:
            return spark.read.schema(data_schema).parquet(folder)
    return None


def layer_schema(data_schema: T.StructType) -> T.StructType:
    names = {f.name for f in data_schema.fields}
    return T.StructType([f for f in data_schema.fields if f.name not in RUN_COLUMNS]
                        + [f for f in RUN_SCHEMA.fields if f.name in RUN_COLUMNS or f.name in names])


def read_layer(spark: SparkSession, path: str, data_schema: T.StructType, fmt: str = "parquet",
               header: bool = True) -> DataFrame:
    """The whole table, every run of it."""
    r = spark.read.schema(layer_schema(data_schema)).format(fmt)
    if fmt == "csv":
        r = r.option("header", header)
    return r.load(path)


def run_filter(day: dt.date | str, hour: int | None = None) -> Column:
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    cond = F.col("tech_day") == F.lit(day)
    if hour is not None:
        cond = cond & (F.col("tech_hour") == F.lit(hour))
    return cond


def lookup_folders(spark: SparkSession, path: str, day: dt.date | str, hour: int | None = None) -> list[str]:
    """The folders that hold the rows of one ``(date, hour)`` pair: its published runs, and an hour's own
    files (backfills)."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    steps = _hour_steps(dt.datetime(day.year, day.month, day.day))[:3]
    home = _folder(path, steps)
    hours = [f"tech_hour={hour}"] if hour is not None else [n for n in names_in(spark, home) if n.startswith("tech_hour=")]
    out = []
    for h in hours:
        names = names_in(spark, f"{home}/{h}")
        out += [f for f in (published(spark, f"{home}/{h}/{n}") for n in names if n.startswith(f"{RUN_ID}=")) if f is not None]
        if any(not n.startswith(("_", ".", f"{RUN_ID}=")) for n in names):
            out.append(f"{home}/{h}")
    return out


def lookup(spark: SparkSession, path: str, data_schema: T.StructType, day: dt.date | str,
           hour: int | None = None, fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Rows of the run(s) of one ``(date, hour)`` pair; only their folders are listed and read."""
    folders = lookup_folders(spark, path, day, hour)
    schema = layer_schema(data_schema)
    if not folders:
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema).format(fmt).option("basePath", path)
    if fmt == "csv":
        r = r.option("header", header)
    return r.load(folders).where(run_filter(day, hour))


def layer_path(base: str, layer: str, dataset: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{dataset}"
