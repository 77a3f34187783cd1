"""Print the physical plans of the pipeline's key operators over real tables.

    python tools/show_plans.py [sf_dir]

Runs the upsert pipeline once on the sf's events/customer (as JSON files),
then prints, for the operators that decide the cost at scale, the
formatted plan and a one-line summary of what it shuffles, prunes and
broadcasts.
"""

from __future__ import annotations

import os
import re
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan
    keys = {
        "exchanges": len(re.findall(r"Exchange hashpartitioning", final)),
        "broadcasts": len(re.findall(r"BroadcastExchange", final)),
        "partial_aggs": len(re.findall(r"partial_", final)),
        "pruned_scans": len(re.findall(r"PartitionFilters: \[[^\]]", final)),
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", final)[:2],
        "python_udf": "EvalPython" in final,
    }
    return ", ".join(f"{k}={v}" for k, v in keys.items())


def main():
    import datetime as dt

    from stationday.config import PipelineConfig, fresh_dir
    from stationday.operators.analytics import station_analytics
    from stationday.operators.dedupe import dedupe_latest
    from stationday.operators.merge import in_partitions, merge_frames, prepare_source, touched_partitions
    from stationday.operators.parse import parse_observations
    from stationday.operators.pivot import daily_temps
    from stationday.plans import derive, stages
    from stationday.plans.pipeline import run_pipeline
    from stationday.plans.queries import _land_array
    from stationday.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, "stationday-plans")
    land = fresh_dir(spark, "plans-land")
    _land_array(spark, sf, land)
    cfg = PipelineConfig.fresh(spark, "plans", sequence_field=derive.SEQUENCE_FIELD)
    run_pipeline(spark, cfg, f"{land}/weather", f"{land}/stations", kind="array", mode="upsert")
    t = stages.Tables(cfg)
    obs_spec = t.spec("observations")

    staged = parse_observations(spark.table(t.name("observation_staging")), sequence_field="seq")
    src = prepare_source(staged, obs_spec.keys, "latest", cfg.ingest_order, stages.OBSERVATION_TIEBREAK)
    one_day = staged.filter(F.col("observation_date").cast("date") == dt.date(2024, 1, 3))
    touched = touched_partitions(one_day, obs_spec).select(stages.PERIOD_COL)
    target = in_partitions(spark.table(t.name("observations")), stages.PERIOD_COL, touched)
    merged = obs_spec.with_partition(merge_frames(obs_spec.logical(target), obs_spec.logical(obs_spec.with_partition(src)),
                                                  list(obs_spec.keys), {"obs_value": "source", "attributes": "source"},
                                                  None, obs_spec.columns))
    load_id = spark.table(t.name("observation_staging")).select("_load_id").first()[0]
    plans = {
        "staging of one load (upsert input)": stages._staged(spark, t, "observation_staging", [load_id]),
        "dedupe (observations)": dedupe_latest(staged, obs_spec.keys, cfg.ingest_order, stages.OBSERVATION_TIEBREAK),
        "touched partitions": staged.select(obs_spec.partition_expr().alias("p")).groupBy("p").count(),
        "upsert (observations, one day)": merged,
        "pivot (one day)": daily_temps(target),
        "analytics (one day)": station_analytics(
            in_partitions(spark.table(t.name("daily_temps")), stages.PERIOD_COL, touched), spark.table(t.name("stations"))),
    }
    for name, df in plans.items():
        df.write.format("noop").mode("overwrite").save()  # let AQE settle the final plan
        print(f"===== {name}\n{summary(df)}")
        if "-v" in sys.argv:
            df.explain("formatted")


if __name__ == "__main__":
    main()
