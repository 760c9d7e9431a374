"""Write the formatted physical plans of the main operators to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Each plan is taken after the query ran once (AQE final plans).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglake.operators.dedup import dedup_batch  # noqa: E402
from loglake.operators.scan import range_scan  # noqa: E402
from loglake.session import local_session  # noqa: E402
from loglake.sources.fixtures import build_events_log, event_id_of, fixture_log, fixture_table, table  # noqa: E402

NOTES = {
    "range_scan": "Only the planned directories are listed; topic/partition become PartitionFilters, each partition's "
    "offset bounds PushedFilters (row-group skipping); no exchange.",
    "bounds": "LogTable.bounds(): the table's records, neither messages nor footers.",
    "dedup_batch": "row_number = 1 with a window group limit on the map side: a hot id sends one row per task.",
    "to_log": "Offset numbering: range exchange on (topic, partition, order), local sort, run table broadcast after "
    "a count; no window over a whole topic partition.",
}


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    table_ = fixture_table(spark, sf_dir, "events")
    plans = {
        "range_scan": range_scan(table_, {0: (0, 30), 1: (10, 25)}, topic="click"),
        "bounds": table_.bounds(["click", "view"]),
        "dedup_batch": dedup_batch(fixture_log(spark, sf_dir, "dup").withColumn("event_id", event_id_of()), "event_id"),
        "to_log": build_events_log(table(spark, sf_dir, "events")),
    }
    out = ["# Physical plans of the main operators", "", f"Generated by `tools/explain_plans.py` on `{sf_dir}`.", ""]
    for name, df in plans.items():
        out += [f"## {name}", "", NOTES[name], "", "```", _plan(df).strip(), "```", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
