"""Time the detector against a plain window on a copy of ``events`` in which
one listing holds a third of the rows.

The copy is derived by Spark from the driver table: every row repeated
``copies`` times with new ids, a third of the copies moved to one listing.
It is written once into a fresh scratch folder of the shared checkpoint
location (or the folder given) and only read afterwards.

Usage: python tools/skew_check.py [sf_dir] [copies] [out_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pricewatch.functions.columns import valid_price  # noqa: E402
from pricewatch.operators import changes  # noqa: E402
from pricewatch.session import get_spark, scratch_path  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    spark = get_spark("local[8]", 64, extra={"spark.driver.memory": "16g"})
    out = sys.argv[3] if len(sys.argv) > 3 else scratch_path(spark, f"skew_copy_{copies}")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    rep = ev.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    hot = F.col("rep") < copies // 3
    (rep.select((F.col("event_id") * copies + F.col("rep")).alias("event_id"), "ts",
                F.when(hot, F.lit(-1)).otherwise(F.col("user_id") * copies + F.col("rep"))
                .alias("user_id"),
                F.when(hot, F.lit("hot")).otherwise(F.col("event_type")).alias("event_type"),
                "value")
     .write.mode("overwrite").parquet(out))
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]

    def plain():
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        e = spark.read.parquet(out)
        return e.withColumn("old_price", F.max(F.when(valid_price("value"), F.col("value"))).over(w))

    def detector():
        return changes.classify_changes(spark.read.parquet(out), keys, "value", order)

    for f in (plain, detector, plain, detector):
        t = time.perf_counter()
        f().select("event_id", "old_price").write.format("noop").mode("overwrite").save()
        print(f.__name__, round(time.perf_counter() - t, 2), flush=True)


if __name__ == "__main__":
    main()
