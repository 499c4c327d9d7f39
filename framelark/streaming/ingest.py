"""Model responses turned into boxes or annotations as their files arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.operators.convert import vlm_to_annotations
from framelark.operators.responses import canonical_boxes
from framelark.operators.scale import cut, ordinal
from framelark.streaming.state import BatchState


def stream_responses(spark: SparkSession, folder: str, files_per_batch=None) -> DataFrame:
    """Stream of response rows (image_id, response) from a folder that only grows."""
    reader = spark.readStream.schema("image_id BIGINT, response STRING").format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest(stream: DataFrame, images: DataFrame, classes, out: str, checkpoint: str, order="xyxy", dedup_iou=0.75, coord_scale=1000.0):
    """Start the job and return its query; it takes what is there and stops.

    All detections of an image come in one response, so each batch is complete in itself. A batch writes
    to a folder of its own number and replaces it when it is run again, so every response counts once
    however often the job restarts.
    """

    def write(batch: DataFrame, number: int) -> None:
        canonical_boxes(batch, images, classes, order, dedup_iou, coord_scale).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_CATEGORIES = "category_id int, name string"
_TOTALS = "frames long, images long, annotations long"


def ingest_annotations(stream: DataFrame, base: str):
    """Annotations of arriving responses, numbered on across batches; returns the query, which takes what is there and stops.

    stream: file_name, width, height, response. Each batch is converted as a set of its own and its numbers follow
    those of the batches before: frames, images and annotations by the totals so far, categories by name, new ones
    after the highest id in order of first appearance. Where files arrive in order of their names, the tables equal
    the conversion of all of them at once. They stand in `{base}/images`, `{base}/annotations` and
    `{base}/categories`, a folder per batch that a repeated attempt replaces, so every response counts once.
    """
    spark = stream.sparkSession
    state = BatchState(spark, base)

    def write(batch: DataFrame, number: int) -> None:
        batch = cut(batch.select("file_name", "width", "height", "response"))
        if number:
            known, totals = state.read(number - 1, "categories", _CATEGORIES), state.read(number - 1, "totals", _TOTALS).first()
        else:
            known, totals = spark.createDataFrame([], _CATEGORIES), None
        frames, images_before, anns_before = tuple(totals) if totals else (0, 0, 0)
        images, anns, cats = (cut(t) for t in vlm_to_annotations(batch))
        top = known.agg(F.coalesce(F.max("category_id"), F.lit(-1))).scalar()
        new = ordinal(cats.join(known.select("name"), "name", "left_anti"), [], ["category_id"], "_k")
        new = cut(new.select("category_id", (top + 1 + F.col("_k")).cast("int").alias("_id"), "name"))
        old = cats.join(known.withColumnRenamed("category_id", "_id"), "name").select("category_id", "_id", "name")
        ids = old.unionByName(new).select("category_id", "_id")
        images = images.withColumns({"frame_idx": F.col("frame_idx") + frames, "image_id": F.col("image_id") + images_before})
        named = anns.join(ids, "category_id").withColumns({"category_id": F.col("_id"), "ann_id": F.col("ann_id") + anns_before, "image_id": F.col("image_id") + images_before}).drop("_id")
        fresh = new.select(F.col("_id").alias("category_id"), "name")
        for name, table in (("images", images), ("annotations", named.select(*anns.columns)), ("categories", fresh)):
            table.write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")
        after = spark.createDataFrame([(frames + batch.count(), images_before + images.count(), anns_before + anns.count())], _TOTALS)
        state.write(number, categories=known.unionByName(fresh), totals=after)
        if number > 1:
            state.forget(number - 2)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
