"""How time grows with the data, with and without one hot entity.

    python scale.py [copies...]          (default 10 100)

Copies the events table (`$BENCH_SF_DIR`, default sf0.1) the given number of times
with fresh users and event ids spread over twelve years, once evenly and once with a third
of all rows on one user, and times the operators on both.  `per split` is the same
feature matrix written as one aggregation per split, for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.functions.dates import parse_interval, shift
from riskrank.operators.asof import asof_latest_version
from riskrank.operators.cohorts import select_labels
from riskrank.operators.features import compile_features, latest_record_asof, window_features
from riskrank.operators.ranking import rank_rows
from riskrank.operators.splits import temporal_splits
from riskrank.session import build_session, release_scratch, scratch_path

TEMPORAL = {"feature_start_time": "2013-01-01", "feature_duration": "6 years", "label_duration": "1 year",
            "feature_aod_interval": "1 year", "train_repeat_interval": "1 year", "num_train_repeat": 5}
BLOCK = {"prefix": "e", "aggregates": [
    {"column_name": "v", "metrics": ["sum", "avg"], "time_windows": ["all", "1 year", "2 years", "5 years"]},
    {"column_name": "event_date", "metrics": ["datediff"]}]}


def copies(spark, sf: str, times: int, hot: bool) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet").repartition(32)
    copied = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    mixed = F.xxhash64("event_id", "copy")
    user = F.col("user_id") + F.col("copy") * 100000
    if hot:
        user = F.when(F.pmod(mixed, F.lit(3)) == 0, -1).otherwise(user)
    day = F.date_add(F.lit("2013-01-01").cast("date"), F.pmod(mixed, F.lit(4380)).cast("int"))
    out = copied.select(user.alias("entity_id"), (F.col("event_id") * times + F.col("copy")).alias("event_id"),
                        day.alias("event_date"), F.date_add(day, F.pmod(mixed, F.lit(40)).cast("int")).alias("knowledge_date"),
                        F.col("value").alias("v"))
    path = scratch_path(spark, f"events-{times}")
    out.write.parquet(path)
    return spark.read.parquet(path)


def per_split(events: DataFrame, splits, features) -> DataFrame:
    parts = []
    for s in splits:
        seen = events.where(F.col("event_date").between(F.lit(s.feature_start), F.lit(s.feature_end))
                            & (F.col("knowledge_date") <= F.lit(s.feature_end)))

        def value(f, s=s):
            if f.window == "all":
                return F.col(f.column)
            return F.when(F.col("event_date") > F.lit(shift(s.feature_end, -parse_interval(f.window))), F.col(f.column))

        how = {"sum": F.sum, "avg": F.avg}
        parts.append(seen.groupBy("entity_id").agg(*[
            (F.min(F.datediff(F.lit(s.feature_end), f.column)) if f.metric == "datediff"
             else how[f.metric](value(f))).alias(f.name) for f in features]).withColumn("split_id", F.lit(s.split_id)))
    return reduce(DataFrame.unionByName, parts)


def main(argv: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", app="scale",
                          spark__sql__shuffle__partitions="32", spark__driver__memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    splits, features = temporal_splits(TEMPORAL), compile_features(BLOCK)
    for times in [int(a) for a in argv] or [10, 100]:
        for hot in (False, True):
            events = copies(spark, sf, times, hot)
            versions = events.where("v < 20").select(
                F.col("entity_id").alias("key"), F.col("event_date").alias("received"), F.col("event_id").alias("seq"))
            narrow = events.select("entity_id", "event_date", "event_id")
            asof = dict(event_key="entity_id", event_ts="event_date", version_key="key", version_ts="received",
                        event_order=[F.col("event_id").asc()], version_order=[F.col("seq").desc()])
            runs = {
                "window_features": lambda: window_features(events, splits, features),
                "window_features, per split": lambda: per_split(events, splits, features),
                "select_labels": lambda: select_labels(
                    events.withColumn("label", (F.col("v") > 100).cast("int")), splits),
                "latest_record_asof": lambda: latest_record_asof(narrow, splits, date_col="event_date"),
                "rank_rows by entity": lambda: rank_rows(
                    events.select("entity_id", "v", "event_id"), [F.col("v").desc(), F.col("event_id")], group=["entity_id"]),
                "asof_latest_version": lambda: asof_latest_version(narrow, versions, **asof),
                "asof_latest_version, spread": lambda: asof_latest_version(narrow, versions, **asof, spread=True),
            }
            seconds = {}
            for name, run in runs.items():
                start = time.perf_counter()
                run().write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - start, 1)
            print(json.dumps({"rows": events.count(), "hot": hot, "splits": len(splits), "sec": seconds}), flush=True)
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
