"""Shared setup of the examples: a session and the events log as a Parquet log table."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglake.session import local_session, scratch_path  # noqa: E402
from loglake.sources.fixtures import fixture_table  # noqa: E402
from loglake.sources.offsets import OffsetStore  # noqa: E402


def setup(cores: str = "4"):
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores=cores)
    log = fixture_table(spark, sf_dir, "events")  # topic = event_type, 4 partitions per topic
    store = OffsetStore(spark, scratch_path(spark, "example-offsets"))
    return spark, log, store


def show_batch(name: str):
    """Batch function: per-partition record counts of the batch (aggregated
    on the executors; only the small summary reaches the driver)."""

    def process(df, batch_id):
        counts = sorted((r["topic"], r["partition"], r["n"]) for r in df.groupBy("topic", "partition").count()
                        .withColumnRenamed("count", "n").collect())
        print(f"[{name}] batch {batch_id}: {sum(c for _, _, c in counts)} records {counts}", flush=True)

    return process
