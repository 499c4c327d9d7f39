"""Tables that a micro-batch leaves for the next one."""


class BatchState:
    """A folder per batch under `base`; a batch that is run again replaces what it left before."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base

    def read(self, number, name, schema):
        return self.spark.read.schema(schema).parquet(f"{self.base}/state/{number}/{name}")

    def write(self, number, **tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.base}/state/{number}/{name}")

    def forget(self, number):
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(f"{self.base}/state/{number}")
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
