"""Command line: run the pipeline or the incremental stream.

    spark-submit --py-files stationday.zip stationday/__main__.py run --root s3a://b/wh \
        --weather s3a://b/land/weather --stations s3a://b/land/stations --kind lines --mode upsert
    spark-submit --py-files stationday.zip stationday/__main__.py incremental --root s3a://b/wh \
        --landing s3a://b/land/weather --checkpoint s3a://b/ckpt/obs --downstream

With a catalog that does not outlive the session (the default without a
metastore) each call creates the tables anew over the files under ``--root`` and
registers their partitions, so calls see each other's data either way; one
writer at a time.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict


def _cfg(a):
    from stationday.config import PipelineConfig

    return PipelineConfig(root=a.root, raw_db=a.raw_db, harmonized_db=a.harmonized_db,
                          analytics_db=a.analytics_db, fact_grain=a.grain, sequence_field=a.sequence_field,
                          null_keys=a.null_keys)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="stationday")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "incremental"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="folder (any Hadoop FS URI) that holds the tables")
        s.add_argument("--raw-db", default="raw")
        s.add_argument("--harmonized-db", default="harmonized")
        s.add_argument("--analytics-db", default="analytics")
        s.add_argument("--grain", default="day", choices=["day", "month"])
        s.add_argument("--null-keys", default="insert", choices=["insert", "drop"])
        s.add_argument("--input-bytes", type=int, default=None, help="volume of a run, to size shuffles")
        s.add_argument("--cores", type=int, default=None, help="cores of the cluster, to size shuffles")
        s.add_argument("--sequence-field", default=None)
        s.add_argument("--kind", default="lines", choices=["array", "lines"])
        s.add_argument("--parse-mode", default="strict", choices=["strict", "permissive"])
    r = sub.choices["run"]
    r.add_argument("--weather")
    r.add_argument("--stations")
    r.add_argument("--mode", default="upsert", choices=["upsert", "refresh"])
    i = sub.choices["incremental"]
    i.add_argument("--landing", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--downstream", action="store_true")
    i.add_argument("--max-files-per-trigger", type=int, default=None)
    i.add_argument("--skip-existing", action="store_true", help="mark files already landed as consumed")
    i.add_argument("--clean-source", default="off", choices=["off", "archive", "delete"])
    i.add_argument("--archive-dir", default=None)
    i.add_argument("--max-file-age", default=None, help="e.g. 7d: the source forgets older files")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from stationday.session import cluster_conf

    spark = SparkSession.getActiveSession()
    if spark is None:
        spark = SparkSession.builder.appName(f"stationday-{a.cmd}").getOrCreate()
        given = spark.sparkContext.getConf()
        for k, v in cluster_conf(a.input_bytes, a.cores).items():
            if not given.contains(k):  # what spark-submit was told stays
                spark.conf.set(k, v)
    cfg = _cfg(a)
    if a.cmd == "run":
        from stationday.plans.pipeline import run_pipeline

        res = run_pipeline(spark, cfg, a.weather, a.stations, kind=a.kind, mode=a.mode, parse_mode=a.parse_mode)
        print(json.dumps([asdict(x) for x in res]))
    else:
        from stationday.plans.stages import setup
        from stationday.streaming import incremental_upsert, skip_existing_files

        setup(spark, cfg)
        if a.skip_existing:
            skip_existing_files(spark, a.landing, a.checkpoint, a.kind)
        run = incremental_upsert(spark, cfg, a.landing, a.checkpoint, kind=a.kind, parse_mode=a.parse_mode,
                                 downstream=a.downstream, max_files_per_trigger=a.max_files_per_trigger,
                                 clean_source=a.clean_source, archive_dir=a.archive_dir,
                                 max_file_age=a.max_file_age)
        print(json.dumps({"batches": run.batches, "source_rows": run.source_rows,
                          "dropped_null_keys": run.dropped_null_keys}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
