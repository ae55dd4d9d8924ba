"""Run jobs in a session that retries failed tasks, with the first attempt
of some input tasks failing on purpose; print whether results match a
clean run.  Used by tests/test_retry.py in its own JVM (local[4,2])."""

import datetime as dt
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cumulo.operators import cumulative, history  # noqa: E402
from cumulo.sources import standins  # noqa: E402
from cumulo.sources.session import work_path  # noqa: E402
from cumulo.streaming.daily import PathStore, run_daily  # noqa: E402

spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
if not spark.conf.get("spark.checkpoint.dir", None):
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="retry-ckpt-"))

SF = "/root/testdata/sf0.001"
MARK = tempfile.mkdtemp(prefix="retry-marks-")  # one file per injected failure (local mode)


@F.udf("boolean")
def flaky(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        open(os.path.join(MARK, f"{ctx.stageId()}-{ctx.partitionId()}-{os.getpid()}-{id(x)}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


orders = spark.read.parquet(f"{SF}/orders.parquet")
players = standins.player_seasons(orders)
clean = rows(history.scd2(players, "player_name", "current_season", "scoring_class"))
noisy = rows(history.scd2(players.where(flaky("player_name")), "player_name", "current_season", "scoring_class"))
print("scd2", clean == noisy)

events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts")
bad_events = events.where(flaky("user_id"))


def load(ev):
    store = PathStore(spark, work_path(spark, "retry"))
    store.write(cumulative.rebuild_dates(ev, "user_id", "ts", dt.date(2024, 1, 27)))

    def step(prev, d):
        return cumulative.cumulate_dates(prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d)

    return rows(run_daily(spark, store, dt.date(2024, 1, 28), dt.date(2024, 1, 30), step))


print("cumulate", load(events) == load(bad_events))
print("injected", len(os.listdir(MARK)) > 0)
spark.stop()
