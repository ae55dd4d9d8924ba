"""Write a copy of the smallest driver tables with edge values injected
(NULL keys and values, fractional quantities, missing JSON fields), for
checking that queries and oracles agree beyond the clean test data:

    python scripts/make_edge_tables.py OUT_DIR
    python scripts/check_oracle.py OUT_DIR
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cumulo.sources.session import local_session  # noqa: E402
from cumulo.sources.tables import TABLES  # noqa: E402

SRC = "/root/testdata/sf0.001"


def every(n, col="_i"):
    return (F.col(col) % n) == 0


def write_edge_tables(spark, out: str) -> str:
    """Write the edge-value copies of the ``SRC`` tables under ``out``."""
    for t in TABLES:
        df = spark.read.parquet(f"{SRC}/{t}.parquet").withColumn("_i", F.monotonically_increasing_id())
        if t == "events":
            df = (df.withColumn("user_id", F.when(every(17), None).otherwise(F.col("user_id")))
                    .withColumn("event_type", F.when(every(23), None).otherwise(F.col("event_type")))
                    .withColumn("props", F.when(every(19), F.lit("{}"))
                                          .when(every(29), F.lit('{"k": null}')).otherwise(F.col("props"))))
        elif t == "lineitem":
            df = (df.withColumn("l_quantity", F.when(every(7), F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity")))
                    .withColumn("l_suppkey", F.when(every(31), None).otherwise(F.col("l_suppkey")))
                    .withColumn("l_returnflag", F.when(every(37), None).otherwise(F.col("l_returnflag")))
                    .withColumn("l_linenumber", F.when(every(41), None).otherwise(F.col("l_linenumber"))))
        elif t == "orders":
            df = df.withColumn("o_orderpriority", F.when(every(13), None).otherwise(F.col("o_orderpriority")))
        elif t == "customer":
            df = df.withColumn("c_nationkey", F.when(every(11), None).otherwise(F.col("c_nationkey")))
        df.drop("_i").coalesce(1).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    return out


def main():
    spark = local_session(4)
    write_edge_tables(spark, sys.argv[1])
    spark.stop()


if __name__ == "__main__":
    main()
