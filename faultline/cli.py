"""Command line: ``python -m faultline.cli validate|manifest|diff``; exit status 1 for failed checks and for errors."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="faultline")
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="all checks of a data folder; reports beside it")
    v.add_argument("--data", required=True, help="folder of catalog, stations, features and, where present, event_station and fetch_log")
    v.add_argument("--benchmarks", help="folder of benchmark splits")
    v.add_argument("--waveforms", help="folder of waveform files, which are counted")
    v.add_argument("--report", type=Path, help="folder of the reports")
    v.add_argument("--quick", action="store_true", help="no decoding of files")
    m = sub.add_parser("manifest", help="hashes of a folder's files, revision and versions")
    m.add_argument("--root", type=Path, default=Path("."))
    m.add_argument("--data", required=True)
    m.add_argument("--out", type=Path, required=True)
    m.add_argument("--metadata", type=Path, help="JSON object of build metadata")
    d = sub.add_parser("diff", help="what changed between two manifests")
    d.add_argument("old", type=Path)
    d.add_argument("new", type=Path)
    return p


def _validate(spark, args) -> int:
    from faultline.operators import quality, validation
    from faultline.sources import tables

    at = {n: tables.resolve(data_dir=args.data, name=n) for n in ("catalog", "stations", "features")}
    found = {n: spark.read.parquet(p) for n, p in at.items()}
    more = {n: spark.read.parquet(f"{args.data}/{n}") if validation.exists(spark, f"{args.data}/{n}") else None for n in ("event_station", "fetch_log")}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(args.waveforms).select("path") if args.waveforms else None
    splits = validation.load_splits(spark, args.benchmarks) if args.benchmarks else None
    checks = validation.validate(found["catalog"], found["stations"], found["features"], more["event_station"], splits, files, more["fetch_log"], quick=args.quick)
    as_json, as_text, status = quality.report(checks)
    if args.report:
        args.report.mkdir(parents=True, exist_ok=True)
        (args.report / "validation_report.json").write_text(as_json, encoding="utf-8")
        (args.report / "validation_report.md").write_text(as_text, encoding="utf-8")
    print(as_text)
    return status


def _manifest(spark, args) -> int:
    from faultline.operators import provenance

    metadata = json.loads(args.metadata.read_text(encoding="utf-8")) if args.metadata else {}
    if not isinstance(metadata, dict):
        raise ValueError("metadata must be a JSON object")
    metadata = {"git": provenance.revision(args.root), "versions": provenance.versions(), **metadata}
    lineage = spark.createDataFrame([], "source string, metric string, value long")
    args.out.write_text(provenance.manifest(provenance.file_hashes(spark, args.data), lineage, metadata), encoding="utf-8")
    return 0


def _diff(spark, args) -> int:
    from faultline.operators import provenance

    old, new = (json.loads(p.read_text(encoding="utf-8")) for p in (args.old, args.new))
    files = [spark.createDataFrame([(a["path"], a["sha256"]) for a in m["artifacts"]], "path string, sha256 string") for m in (old, new)]
    counts = [spark.createDataFrame([(c["source"], c["metric"], c["value"]) for c in m["lineage"]], "source string, metric string, value long") for m in (old, new)]
    changes = {"artifacts": provenance.diff_artifacts(*files).orderBy("path"), "lineage": provenance.diff_lineage(*counts).orderBy("source", "metric")}
    print(json.dumps({k: [r.asDict() for r in df.collect()] for k, df in changes.items()}, indent=2, sort_keys=True))
    return 0


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if spark is None:
        from faultline.session import build

        spark = build()
    try:
        return {"validate": _validate, "manifest": _manifest, "diff": _diff}[args.command](spark, args)
    except (OSError, ValueError, RuntimeError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
