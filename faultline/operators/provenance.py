"""Manifests: hashes of outputs, lineage counts, differences between two manifests."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Values of a source's status, part of the manifest's format (fixed values).
STATUS_CATALOG = ("catalog_records_observed", "no_catalog_records_observed", "catalog_source_status_unverified")
STATUS_BOTH, STATUS_STATIONS, STATUS_NETWORK_UNKNOWN = "stations_and_waveforms_observed", "stations_observed_no_waveforms", "koeri_source_status_unverified"
STATUS_SITES = ("vs30_values_observed", "no_vs30_values_observed", "vs30_source_status_unverified")


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, bytes and sha256 of every file below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def require(root: Path, names: list[str]) -> list[Path]:
    """All of the outputs, or one error that lists every missing one."""
    missing = [n for n in names if not (root / n).exists()]
    if missing:
        raise FileNotFoundError("missing outputs: " + ", ".join(sorted(missing)))
    return [root / n for n in sorted(names)]


def diff_artifacts(old: DataFrame, new: DataFrame) -> DataFrame:
    """path and change (added, removed, changed) of two tables (path, sha256); a path that stands twice is an error."""
    for df in (old, new):
        if not df.groupBy("path").count().where("count > 1").isEmpty():
            raise ValueError("a path stands twice in a manifest")
    both = old.select("path", F.col("sha256").alias("a")).join(new.select("path", F.col("sha256").alias("b")), "path", "full")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", change.alias("change")).where("change is not null")


def diff_lineage(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts (source, metric, value) that differ; a missing one is 0."""
    both = old.select("source", "metric", F.col("value").alias("before")).join(new.select("source", "metric", F.col("value").alias("after")), ["source", "metric"], "full").fillna(0, ["before", "after"])
    return both.where("before <> after").withColumn("delta", F.col("after") - F.col("before"))


def lineage_counts(id_map: DataFrame, stations: DataFrame) -> DataFrame:
    a = id_map.groupBy("source").agg(F.count(F.lit(1)).alias("value")).select("source", F.lit("reports").alias("metric"), "value")
    counts = stations.agg(F.count(F.lit(1)).alias("rows"), F.count("vs30_ms").alias("with_vs30"))
    b = counts.unpivot([], ["rows", "with_vs30"], "metric", "value").select(F.lit("stations").alias("source"), "metric", "value")
    return a.unionByName(b)


def manifest(artifacts: DataFrame, lineage: DataFrame, metadata: dict) -> str:
    """A deterministic JSON document: rows sorted, keys sorted. Its rows are files, not data."""
    rows = lambda df, *keys: [r.asDict() for r in df.orderBy(*keys).collect()]
    return json.dumps({"artifacts": rows(artifacts, "path"), "lineage": rows(lineage, "source", "metric"), "metadata": metadata}, sort_keys=True, indent=2) + "\n"


def source_statuses(lineage: DataFrame, kinds: dict[str, str], skipped: tuple[str, ...] = ()) -> DataFrame:
    """source, status: what the counts (source, metric, value) say of each source of a kind (catalog, network or sites).

    A source without counts is unverified; ``skipped`` ones are marked so. The kinds are a few sources.
    """
    spark = lineage.sparkSession
    named = F.broadcast(spark.createDataFrame(sorted(kinds.items()), "source string, kind string"))  # a row a source
    value = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    counts = lineage.groupBy("source").agg(value("reports").alias("reports"), value("rows").alias("rows"), value("waveform_files").alias("files"), value("with_vs30").alias("sites"))
    d = counts.join(named, "source", "right")
    one = lambda c, some, none, unknown: F.when(c > 0, some).when(c == 0, none).otherwise(unknown)
    network = F.when((F.col("rows") > 0) & (F.col("files") > 0), STATUS_BOTH).when(F.col("rows") > 0, STATUS_STATIONS).otherwise(STATUS_NETWORK_UNKNOWN)
    status = F.when(F.col("kind") == "catalog", one(F.col("reports"), *STATUS_CATALOG)).when(F.col("kind") == "network", network).otherwise(one(F.col("sites"), *STATUS_SITES))
    return d.select("source", F.when(F.col("source").isin(*skipped), F.concat(status, F.lit("_picks_skipped"))).otherwise(status).alias("status"))


def revision(root: Path) -> dict[str, str | bool]:
    """The checked-out revision and whether files differ from it."""
    import subprocess

    def git(*words: str) -> str:
        try:
            return subprocess.run(["git", "-C", str(root), *words], check=True, capture_output=True, text=True).stdout.strip()
        except (OSError, subprocess.CalledProcessError) as e:
            raise RuntimeError(f"no revision of {root}: {e}") from e

    return {"revision": git("rev-parse", "HEAD"), "dirty": bool(git("status", "--porcelain"))}


def versions(names: tuple[str, ...] = ("pyspark", "pyarrow", "pandas", "numpy")) -> dict[str, str]:
    from importlib import metadata

    out = {}
    for name in names:
        try:
            out[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            out[name] = "absent"
    return out
