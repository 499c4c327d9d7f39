"""Seeds followed through candidate frames that arrive over time.

A frame counts when it is closed: by its end-of-frame mark, once all frames before it are closed, or by a
watermark, `lag` frames behind the latest one seen. A frontier table holds one row per live seed, the last box
of its chain. Each micro-batch advances it through the frames it closes with the batch operator; candidates of
open frames wait in a table, and those that come after their frame was closed go to a table of their own.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.operators.scale import cut
from framelark.operators.tracks import BOX, propagate_chain
from framelark.streaming.state import BatchState

ORIGIN = [f"s{c}" for c in BOX]


def _first_frontier(seeds, key):
    return seeds.select(key, "seed_id", F.col("frame_idx").cast("long").alias("frame_idx"), *[F.col(c).cast("double").alias(c) for c in BOX], *[F.col(c).cast("double").alias(o) for c, o in zip(BOX, ORIGIN)])


def _closed_now(known, marks, seen, key, lag):
    """known (key, first, closed, top) with the frames that marks and the watermark close by now."""
    top = seen.groupBy(key).agg(F.max("frame_idx").alias("_top"))
    moved = known.join(top, key, "left").withColumn("top", F.greatest("top", "_top")).drop("_top")
    if lag is not None:
        moved = moved.withColumn("closed", F.greatest("closed", F.col("top") - F.lit(lag)))
    # Marks still open are few: the frames of a sequence that wait. Those without a gap close.
    place = F.row_number().over(Window.partitionBy(key).orderBy("frame_idx"))
    ahead = marks.distinct().join(moved.select(key, "closed"), key).filter("frame_idx > closed").withColumn("_place", place)
    run = ahead.filter(F.col("frame_idx") - F.col("closed") == F.col("_place")).groupBy(key).agg(F.max("frame_idx").alias("_marked"))
    return moved.join(run, key, "left").withColumn("closed", F.coalesce("_marked", "closed")).drop("_marked")


def propagate(stream: DataFrame, seeds: DataFrame, base: str, key="video_id", lag=None):
    """Start the job and return its query; it takes what is there and stops.

    stream: key, frame_idx, cand_id, box; a row without cand_id marks the end of its frame. seeds (a table):
    key, seed_id, frame_idx, box. Chains go to `{base}/out`: key, seed_id, frame_idx, cand_id, box, batch. Frames
    may come in any order and spread over any number of batches; candidates of a frame that is closed already
    go to `{base}/late`. Sequences without a live seed are not kept. Every folder carries the number of its batch
    and replaces what an earlier attempt at it left, so each row counts once however often the job restarts.
    """
    spark = stream.sparkSession
    state = BatchState(spark, base)
    first = _first_frontier(seeds, key)
    kind = first.schema[key].dataType.simpleString()
    cand = f"{key} {kind}, frame_idx long, cand_id {stream.schema['cand_id'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in BOX)

    def advance(batch: DataFrame, number: int) -> None:
        if number:
            frontier = state.read(number - 1, "frontier", first.schema)
            known = state.read(number - 1, "known", f"{key} {kind}, first long, closed long, top long")
            waiting, marks = state.read(number - 1, "waiting", cand), state.read(number - 1, "marks", f"{key} {kind}, frame_idx long")
        else:
            frontier, start = first, F.min("frame_idx")
            known = first.groupBy(key).agg(start.alias("first"), start.alias("closed"), start.alias("top"))
            waiting, marks = spark.createDataFrame([], cand), spark.createDataFrame([], f"{key} {kind}, frame_idx long")
        new = batch.select(key, F.col("frame_idx").cast("long").alias("frame_idx"), "cand_id", *[F.col(c).cast("double").alias(c) for c in BOX])
        new = cut(new.join(known.select(key, "first", "closed"), key).filter("frame_idx > first"))
        late = new.filter("frame_idx <= closed and cand_id is not null").select(key, "frame_idx", "cand_id", *BOX)
        new = new.filter("frame_idx > closed").drop("first", "closed")
        open_marks = marks.unionByName(new.filter("cand_id is null").select(key, "frame_idx"))
        pending = waiting.unionByName(new.filter("cand_id is not null"))
        closing = cut(_closed_now(known, open_marks, new.select(key, "frame_idx"), key, lag))
        pending = cut(pending.join(closing.select(key, F.col("closed").alias("_closed")), key))
        ready, ends = pending.filter("frame_idx <= _closed").drop("_closed"), closing.select(key, "closed")
        moving = frontier.join(ends, key).filter("frame_idx < closed").drop("closed")
        if moving.isEmpty() or ready.isEmpty():  # nothing to follow; seeds whose frames closed without a candidate are lost below
            chain = frontier.select(key, "seed_id", "frame_idx", F.lit(None).cast(stream.schema["cand_id"].dataType).alias("cand_id"), *BOX).limit(0)
        else:
            chain = cut(propagate_chain(moving, ready, [key]))
        last = chain.groupBy(key, "seed_id").agg(F.max(F.struct("frame_idx", *BOX)).alias("_last"))
        reached = frontier.join(last, [key, "seed_id"], "left").select(
            key, "seed_id", F.coalesce("_last.frame_idx", "frame_idx").alias("frame_idx"), *[F.coalesce(F.col(f"_last.{c}"), F.col(c)).alias(c) for c in BOX], *ORIGIN)
        live = reached.join(ends, key).filter("frame_idx >= closed").drop("closed")
        live = cut(live)
        followed = closing.join(live.select(key).distinct(), key, "left_semi")
        chain.write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        late.write.mode("overwrite").parquet(f"{base}/late/batch={number}")
        rest = pending.filter("frame_idx > _closed").drop("_closed").join(followed.select(key), key, "left_semi")
        open_marks = open_marks.distinct().join(followed.select(key, "closed"), key).filter("frame_idx > closed").drop("closed")
        state.write(number, frontier=live, known=followed, waiting=rest, marks=open_marks)
        if number > 1:
            state.forget(number - 2)

    return stream.writeStream.foreachBatch(advance).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
