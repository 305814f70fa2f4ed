"""Runs one step, for ``spark-submit`` or ``python -m orderlake``.

    python -m orderlake silver --root hdfs:///data
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from orderlake import schemas
from orderlake.plans.etl import bronze_to_silver, silver_to_gold
from orderlake.plans.report import segment_report
from orderlake.plans.segmentation import run_segmentation
from orderlake.session import create_session, size_shuffles
from orderlake.sources.lake import Lake


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderlake")
    parser.add_argument("step", choices=["silver", "gold", "segments", "report"])
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--database", default="analytics")
    parser.add_argument("--database-location")
    parser.add_argument("--completed-status", default=schemas.COMPLETED_STATUS)
    parser.add_argument("--max-k", type=int, default=8)
    parser.add_argument("--shuffled-bytes", type=int, help="size of the largest shuffle")
    parser.add_argument("--multi-line", action="store_true", help="line breaks within CSV quotes")
    parser.add_argument("--quarantine", action="store_true", help="silver: keep rejected rows")
    parser.add_argument("--by-order", action="store_true", help="gold: store by order first")
    parser.add_argument("--hive", action="store_true", help="use the Hive catalog")
    options = parser.parse_args(arguments)

    if spark is None:
        spark = create_session(
            f"orderlake {options.step}", hive=options.hive, shuffled_bytes=options.shuffled_bytes
        )
        if options.shuffled_bytes is None:
            layer = "bronze" if options.step == "silver" else "silver"
            size_shuffles(spark, f"{options.root}/{layer}")
    lake = Lake(options.root, options.database, options.database_location)
    if options.step == "silver":
        bronze_to_silver(spark, lake, options.multi_line, options.quarantine).show(1000, truncate=False)
    elif options.step == "gold":
        silver_to_gold(spark, lake, options.completed_status, options.by_order)
    elif options.step == "segments":
        run_segmentation(spark, lake, options.max_k, options.completed_status)
    else:
        for name, df in segment_report(spark, lake).items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
