"""Table scans and sinks: explicit schemas, strict coercion, benchmark splits, aligned exports, atomic publishing, logs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

ENV = "FAULTLINE_DATA_DIR"
TASKS = {"ground_motion": (None, "station", "time"), "phase_picking": (None,), "early_warning": (None,)}
CATALOG = "event_id string, magnitude double, mag_type string, place string, longitude double, latitude double, depth_km double, status string, source string, time_utc timestamp"
RAW = "source_event_id string, time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double, mag_type string, source string"


def resolve(path: str | None = None, data_dir: str | None = None, name: str = "") -> str:
    """Explicit path, else the given folder, else the environment's, else ``data``; local ones must exist."""
    found = path or str(Path(data_dir or os.environ.get(ENV) or "data") / name)
    if "://" not in found and not Path(found).exists():
        raise FileNotFoundError(f"{found} does not exist: give a path or data_dir, or set {ENV}")
    return found


def scan(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet or CSV by suffix; CSV has a header and wants a schema. NaN becomes NULL."""
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV scan needs a schema")
        df = spark.read.schema(schema).option("header", True).csv(path)
    else:
        df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType | FloatType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def strict(df: DataFrame, required: dict[str, str], ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Required columns, trimmed and cast (text that is no value becomes NULL); values that are not finite or out of range become NULL."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    out = df
    for c, kind in required.items():
        if kind == "string":
            out = out.withColumn(c, F.trim(F.col(c).cast("string")))
        elif kind == "timestamp":
            out = out.withColumn(c, F.try_to_timestamp(F.trim(F.col(c).cast("string"))))
        else:
            v = F.col(c).cast("string").try_cast(kind)
            low, high = (ranges or {}).get(c, (-1.7e308, 1.7e308))
            out = out.withColumn(c, F.when(v.between(low, high), v))
    return out


def normalize(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order: milliseconds become timestamps, missing columns are NULL, rows are by ``time_utc`` where there is one."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.typeName() == "timestamp" and dict(df.dtypes)[f.name] in ("bigint", "double"):
            out.append(F.timestamp_millis(F.col(f.name).cast("long")).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    rows = df.select(*out)
    return rows.orderBy("time_utc") if "time_utc" in rows.columns else rows


def benchmark_path(task: str, split: str, holdout: str | None = None, base: str = "benchmarks") -> str:
    """Path of a split, its arguments checked before anything is read."""
    if task not in TASKS or holdout not in TASKS[task]:
        raise ValueError(f"no task {task!r} with holdout {holdout!r}")
    if split not in (("train", "test") if holdout == "time" else ("train", "val", "test")):
        raise ValueError(f"no split {split!r} for holdout {holdout!r}")
    return "/".join([base, task, *([f"holdout_by_{holdout}"] if holdout else []), f"split={split}"])


def load_benchmark(spark: SparkSession, task: str, split: str, holdout: str | None = None, base: str = "benchmarks") -> DataFrame:
    return spark.read.parquet(benchmark_path(task, split, holdout, base))


def write_splits(df: DataFrame, path: str, column: str = "split") -> None:
    """One folder a split, without the split's column."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def aligned(splits: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same schema in all splits: a column that is NULL throughout a split takes the others' type, or string."""
    kinds: dict[str, set[str]] = {}
    full: dict[str, set[str]] = {}
    for name, df in splits.items():
        row = df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns)).first()
        full[name] = {c for c in df.columns if row[c]}
        for c, kind in df.dtypes:
            kinds.setdefault(c, set())
            if c in full[name]:
                kinds[c].add(kind)
    to = {c: "string" if not k or "string" in k else next(iter(k)) if len(k) == 1 else "string" for c, k in kinds.items()}
    return {n: df.select(*(F.col(c).cast(to[c]).alias(c) for c in df.columns)) for n, df in splits.items()}


def export(splits: dict[str, DataFrame], path: str) -> None:
    for name, df in aligned(splits).items():
        df.write.mode("overwrite").parquet(f"{path}/{'validation' if name == 'val' else name}")


def publish(parts: dict[int, Callable[[], DataFrame]], path: str, spark: SparkSession) -> int:
    """Write parts (a year each) beside ``path`` and swap when all are there: on a failure, or with no rows, the old output stays."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    failed: list[str] = []
    try:
        for year in sorted(parts):
            try:
                parts[year]().write.parquet(f"{staging}/year={year}")
            except Exception as e:  # every year is tried, and all failures are named
                failed.append(f"{year}: {type(e).__name__}")
        if failed:
            raise RuntimeError("parts failed, nothing is published: " + ", ".join(failed))
        n = spark.read.parquet(staging).count() if parts else 0
        if n == 0:
            raise RuntimeError("no rows, nothing is published")
        old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
        if fs.exists(fs_path(path)):
            fs.rename(fs_path(path), fs_path(old))
        fs.rename(fs_path(staging), fs_path(path))
        fs.delete(fs_path(old), True)
        return n
    finally:
        fs.delete(fs_path(staging), True)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def pending(candidates: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates that the log does not have yet."""
    return candidates.join(log.select(*keys).distinct(), keys, "left_anti")


def migrate_log(log: DataFrame, default: str = "usgs") -> DataFrame:
    """Rows of logs from before the agency's column count as the default agency's."""
    source = F.coalesce("event_source", F.lit(default)) if "event_source" in log.columns else F.lit(default)
    return log.withColumn("event_source", source)


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, made first if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _loader(name: str) -> Callable[..., DataFrame]:
    def load(spark: SparkSession, path: str | None = None, data_dir: str | None = None, schema: str | StructType | None = None) -> DataFrame:
        return scan(spark, resolve(path, data_dir, name), schema)

    load.__name__ = load.__qualname__ = f"load_{name}"
    load.__doc__ = f"The table ``{name}``: of ``path``, else of ``data_dir``, else of the environment's folder."
    return load


load_catalog, load_event_station, load_features, load_stations = (_loader(n) for n in ("catalog", "event_station", "features", "stations"))
