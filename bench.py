"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time is that of writing its whole result to Spark's noop sink, the files it reads being composed
before; each runs once warm-up and then twice, and the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ["read_raw_counts", "read_control", "read_data", "read_segment_customers", "read_segment_items", "read_fields_long", "hierarchy", "xml_to_records", "to_xml", "framing_lf", "write_parts"]
TWICE = 2


def main() -> None:
    from edispark.catalogue import QUERIES

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for k in range(TWICE + 1):
            began = time.time()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            s = time.time() - began
            if k:
                best = s if best is None else min(best, s)
        took[name] = round(best, 3)
    print(json.dumps({"metric": "sum of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
