"""Streamed jobs run over the derived tables; their results equal the batch operators'."""

from pyspark.sql import functions as F

from framelark.operators.scale import cut, ordinal, scratch_path
from framelark.plans.datasets import canonical_sql
from framelark.plans.motion import _CANDS
from framelark.plans.projections import _CLASSES
from framelark.plans.registry import ORACLES, query
from framelark.streaming import ingest, propagate


_BODY, _PARTS = canonical_sql("SELECT image_id, ann_id AS pred_id, label AS raw, NULL::DOUBLE AS score, trunc(x1) AS x1, trunc(y1) AS y1, trunc(x2) AS x2, trunc(y2) AS y2 FROM fx_label WHERE image_id % 37 <> 0", 0.75)


@query("stream_vlm_ingest", _BODY, recursive=True, **_PARTS)
def _(t):
    spark = t.fx_vlm.sparkSession
    base = scratch_path(spark, "ingest")
    t.fx_vlm.repartition(16, "image_id").write.parquet(f"{base}/in")
    stream = ingest.stream_responses(spark, f"{base}/in", files_per_batch=8)
    ingest.ingest(stream, t.fx_image, _CLASSES, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("image_id", "label", "x1", "y1", "x2", "y2")


IN_FILE = 500_000  # responses in a file of a batch


@query("stream_vlm_annotations", recursive=True)
def _(t):
    """Two halves in order of name; ids go on from one to the next, so the rows are those of the batch conversion.

    A half is a batch of `files` files of up to IN_FILE rows, dealt in turn, so that each has rows.
    """
    rows = t.fx_vlm.join(t.fx_image.select("image_id", "file_name"), "image_id").select("file_name", F.lit(100).alias("width"), F.lit(80).alias("height"), "response")
    rows = cut(ordinal(rows, [], ["file_name"], "_at"))
    n = rows.count()
    files = max(1, min(-(-n // 2 // IN_FILE), n // 2))
    share, base, spark = -(-n // 2), scratch_path(rows.sparkSession, "annotations"), rows.sparkSession
    for i in range(2):
        half = rows.filter(F.floor(F.col("_at") / share) == i)
        half.repartitionById(files, (F.col("_at") % files).cast("int")).drop("_at").write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.drop("_at").schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    ingest.ingest_annotations(stream, base).awaitTermination()
    anns, images = spark.read.parquet(f"{base}/annotations"), spark.read.parquet(f"{base}/images")
    return anns.join(images.select("image_id", "frame_idx"), "image_id").select("ann_id", "image_id", "category_id", "frame_idx", "x", "y", "w", "h")


# As with the conversion at once.
ORACLES["stream_vlm_annotations"] = ORACLES["vlm_to_annotations"]


@query("stream_propagate", recursive=True)
def _(t):
    """The candidates of a frame come in three batches, mixed with those of other frames, its mark after them."""
    cands = t.sql(_CANDS)
    spark = cands.sparkSession
    base = scratch_path(spark, "propagate")
    marks = cands.groupBy("video_id").agg(F.max("frame_idx").alias("m")).select("video_id", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("frame_idx"))
    late = (F.col("frame_idx") / 10).cast("int")
    rows = cands.withColumn("_file", late + F.col("cand_id") % 3).unionByName(marks.withColumn("_file", late + 3), allowMissingColumns=True)
    rows = cut(rows)
    for i in range(rows.agg(F.max("_file")).first()[0] + 1):
        rows.filter(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(cands.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    seeds = cands.filter("frame_idx = 0").withColumnRenamed("cand_id", "seed_id")
    propagate.propagate(stream, seeds, base).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("seed_id", "frame_idx", "cand_id", "x1", "y1", "x2", "y2")


# The streamed chain is checked by the statement of the batch chain.
ORACLES["stream_propagate"] = ORACLES["propagate_chain"].replace("SELECT video_id, seed_id, frame_idx, cand_id, x1, y1, x2, y2 FROM chain", "SELECT seed_id, frame_idx, cand_id, x1, y1, x2, y2 FROM chain")
