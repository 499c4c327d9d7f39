"""Session defaults used by the tests and the bench; on a cluster the caller brings the session."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores="*", app="framelark", shuffle_partitions=8, driver_memory="8g"):
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test data: split files and shuffles finely enough to keep all cores busy.
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
