"""Time the packed sequence operators and their textbook form on generated data of any size.

    python scale_bench.py [rows] [local cores]

Dense data has a third of its rows in one partition and every third offset missing there;
sparse data has offsets that hardly ever share a word. Each form runs three times after a
warm-up, into a sink that discards rows; one JSON line per case.
"""

import json
import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import sequences as sq
from tidemark.session import set_checkpoint_dir


def data(spark, rows, shape):
    ids = spark.range(rows)
    if shape == "dense":
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 64 + 1)
        return ids.select(key.cast("int").alias("partition"), (F.col("id") + F.col("id") / 2).cast("bigint").alias("offset"))
    return ids.select((F.col("id") % 3).cast("int").alias("partition"), F.pmod(F.xxhash64("id"), F.lit(9 * 10**12)).alias("offset"))


def direct_stats(df):
    pairs = df.distinct()
    return pairs.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"))


def direct_gaps(df):
    order = Window.partitionBy("partition").orderBy("offset")
    following = df.distinct().withColumn("next", F.lead("offset").over(order))
    return following.filter(F.col("next") - F.col("offset") > 1)


FORMS = {
    "statistics packed": sq.partition_gap_stats,
    "statistics direct": direct_stats,
    "gaps packed": sq.gap_intervals,
    "gaps direct": direct_gaps,
}


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", 4 * int(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    set_checkpoint_dir(spark)
    for shape in ("dense", "sparse"):
        frame = data(spark, rows, shape)
        for name, form in FORMS.items():
            seconds = []
            for _ in range(4):
                start = time.perf_counter()
                form(frame).write.format("noop").mode("overwrite").save()
                seconds.append(round(time.perf_counter() - start, 2))
            print(json.dumps({"shape": shape, "rows": rows, "form": name, "seconds": seconds[1:]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
