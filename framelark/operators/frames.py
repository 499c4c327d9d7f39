"""Frames in time: indexing, pairing of cameras, nearest frames and poses, keyframes and spans."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions import text
from framelark.operators.scale import nearest, ordinal, running

# Fixed: nanoseconds between frames without a time of their own, and the reach of a pose by time.
SYNTHETIC_STEP = 1_000_000
MAX_POSE_DT = 10_000_000_000


def index_frames(files: DataFrame, keys=("folder",)) -> DataFrame:
    """Position and timestamp of every file of a folder.

    If all stems of a folder are bare integers they are the timestamps and the order; else files are
    ordered by name and get synthetic times.
    """
    keys = list(keys)
    stem = files.withColumn("_ts", text.frame_timestamp(F.col("file_name")))
    numeric = stem.groupBy(*keys).agg((F.count("_ts") == F.count("*")).alias("numeric"))
    rows = stem.join(numeric, keys).withColumn("_k", F.when(F.col("numeric"), F.col("_ts")).otherwise(F.lit(0)))
    ix = ordinal(rows, keys, ["_k", "file_name"], "frame_idx")
    ts = F.when(F.col("numeric"), F.col("_ts")).otherwise(F.col("frame_idx") * SYNTHETIC_STEP)
    return ix.withColumn("timestamp_ns", ts).drop("_ts", "_k")


def sync_by_name(left: DataFrame, right: DataFrame):
    """(right frames whose name was sampled on the left, counts kept/total)."""
    kept = right.join(left.select("file_name").distinct(), "file_name", "left_semi")
    total = right.agg(F.count("*")).scalar()
    return kept, kept.agg(F.count("*").alias("kept")).select("kept", total.alias("total"))


def _first_per_time(side, keys):
    rest = [c for c in side.columns if c not in (*keys, "timestamp_ns")]
    return side.groupBy(*keys, "timestamp_ns").agg(F.min(F.struct(*rest)).alias("f"))


def pair_stereo(left: DataFrame, right: DataFrame, keys=()) -> DataFrame:
    """Frames of both cameras with exactly the same time, numbered in time order."""
    keys = list(keys)
    a, b = _first_per_time(left, keys), _first_per_time(right, keys)
    pairs = a.select(*keys, "timestamp_ns", F.col("f.file_name").alias("left_name")).join(
        b.select(*keys, "timestamp_ns", F.col("f.file_name").alias("right_name")), [*keys, "timestamp_ns"])
    return ordinal(pairs, keys, ["timestamp_ns"], "pair_idx")


def stereo_counts(left: DataFrame, right: DataFrame, keys=()) -> DataFrame:
    """Times on both sides, on the left only, on the right only."""
    tag = lambda d, n: d.select(*keys, "timestamp_ns").distinct().withColumn(n, F.lit(1))
    both = tag(left, "_l").join(tag(right, "_r"), [*keys, "timestamp_ns"], "full_outer")
    l, r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return both.groupBy(*keys).agg(F.count_if(l & r).alias("pairs"), F.count_if(l & ~r).alias("left_only"), F.count_if(r & ~l).alias("right_only"))


def pair_positional(left: DataFrame, right: DataFrame, keys=(), order="file_name") -> DataFrame:
    """Frames of both cameras paired by position in name order; the shorter side decides."""
    keys = list(keys)
    pick = lambda d, n: ordinal(d.select(*keys, order), keys, [order], "pair_idx").withColumnRenamed(order, n)
    return pick(left, "left_name").join(pick(right, "right_name"), [*keys, "pair_idx"]).withColumn(
        "same_name", text.basename(F.col("left_name")) == text.basename(F.col("right_name")))


def nearest_frame(queries: DataFrame, frames: DataFrame, keys=(), payload=("frame_idx",)) -> DataFrame:
    """Frame nearest in time to each query, clamped at the ends; the earlier one wins ties."""
    near = nearest(queries, frames, list(keys), "timestamp_ns", list(payload))
    p, n, ts = F.col("prev"), F.col("next"), F.col("timestamp_ns")
    back, ahead = ts - p["timestamp_ns"], n["timestamp_ns"] - ts
    pick = F.when(n.isNull(), p).when(p.isNull(), n).when(back <= ahead, p).otherwise(n)
    return near.withColumn("near", pick).drop("prev", "next")


def nearest_synthetic(queries: DataFrame, n_frames) -> DataFrame:
    """Frame index of synthetic times: rounded, clamped to the index range."""
    ix = F.bround(F.col("timestamp_ns") / SYNTHETIC_STEP).cast("long")
    return queries.withColumn("frame_idx", F.greatest(F.lit(0), F.least(ix, n_frames - 1)))


def pose_coalesce(prefix="") -> "F.Column":
    """Camera position if complete, else lidar position if complete, else NULL."""
    def full(k):
        cols = [F.col(f"{prefix}{k}_{a}") for a in "xyz"]
        ok = cols[0].isNotNull()
        for c in cols:
            ok = ok & c.isNotNull() & ~F.isnan(c)
        return F.when(ok, F.struct(*[c.alias(a) for c, a in zip(cols, "xyz")]))

    return F.coalesce(full("cam"), full("lidar"))


def check_poses(poses: DataFrame) -> DataFrame:
    """The pose table, refused when empty or without one complete camera position."""
    full = F.lit(True)
    for c in ("cam_x", "cam_y", "cam_z"):
        full = full & F.col(c).isNotNull() & ~F.isnan(c)
    got = poses.agg(F.count("*").alias("n"), F.count_if(full).alias("ok")).first()
    if got["n"] == 0:
        raise ValueError("pose table is empty")
    if got["ok"] == 0:
        raise ValueError("no complete camera pose")
    return poses


def pose_lookup(frames: DataFrame, poses: DataFrame, mode="auto") -> DataFrame:
    """Pose of each frame: adds pose_id, matched_by and pos.

    auto looks for the file name, then a numeric stem as pose id, then the nearest time within ten
    seconds (the earlier wins ties). A key that matches ends the search even when its pose is empty.
    Of several poses with one key the earliest counts.
    """
    pos = poses.withColumn("pos", pose_coalesce()).select("pose_id", "filename", "timestamp_ns", "pos")
    rows = frames.withColumns({"_base": text.basename(F.col("file_name")), "_num": text.frame_timestamp(F.col("file_name"))})
    steps = []
    if mode in ("auto", "filename"):
        by = pos.groupBy(F.col("filename").alias("_base")).agg(F.min(F.struct("timestamp_ns", "pose_id", "pos")).alias("_f"))
        rows = rows.join(by, "_base", "left")
        steps.append(("filename", F.col("_f")))
    if mode in ("auto", "filename_id"):
        # Names without a number would all meet in one partition; they are spread by hash and match nothing.
        key = {"_key": F.coalesce("_num", F.xxhash64("file_name")), "_has": F.col("_num").isNotNull()}
        by = pos.groupBy(F.col("pose_id").cast("long").alias("_key"), F.lit(True).alias("_has")).agg(F.min(F.struct("timestamp_ns", "pose_id", "pos")).alias("_i"))
        rows = rows.withColumns(key).join(by, ["_key", "_has"], "left").drop("_key", "_has")
        steps.append(("filename_id", F.col("_i")))
    if mode in ("auto", "timestamp"):
        rows = nearest_frame(rows, pos.select("timestamp_ns", "pose_id", "pos"), [], ("pose_id", "pos"))
        close = F.abs(F.col("near.timestamp_ns") - F.col("timestamp_ns")) <= MAX_POSE_DT
        steps.append(("timestamp", F.when(close, F.col("near"))))
    hit = F.coalesce(*[F.when(s.isNotNull(), F.struct(F.lit(n).alias("by"), s["pose_id"].alias("pose_id"), s["pos"].alias("pos"))) for n, s in steps])
    return rows.withColumn("_h", hit).select(
        *frames.columns, F.col("_h.pose_id").alias("pose_id"), F.col("_h.by").alias("matched_by"), F.col("_h.pos").alias("pos"))


def keyframes(frames: DataFrame, keys=(), every=5, start=0) -> DataFrame:
    """Every n-th frame from `start`, numbered along each sequence. Frame indexes run without gaps."""
    step = F.col("frame_idx") - start
    return frames.filter((step >= 0) & (step % every == 0)).withColumn("keyframe_id", F.floor(step / every).cast("long"))


def add_regular_keyframes(frames: DataFrame, marks: DataFrame, keys, every: int) -> DataFrame:
    """Existing keyframe marks plus every n-th frame (n >= 2)."""
    if every < 2:
        raise ValueError("keyframe distance must be at least 2")
    cols = [*keys, "frame_idx"]
    return marks.select(*cols).unionByName(keyframes(frames, keys, every).select(*cols)).distinct()


def split_ranges(frames: DataFrame, ranges, total: int) -> DataFrame:
    """Assign frames to named inclusive index ranges; bad or overlapping ranges raise.

    `ranges` is the user's short list of (name, first, last).
    """
    last = -1
    for name, lo, hi in sorted(ranges, key=lambda r: r[1]):
        if lo < 0 or hi >= total or lo > hi:
            raise ValueError(f"range {name} is out of bounds")
        if lo <= last:
            raise ValueError(f"range {name} overlaps another")
        last = hi
    part = F.coalesce(*[F.when(F.col("frame_idx").between(lo, hi), F.lit(name)) for name, lo, hi in ranges])
    return frames.withColumn("part", part).filter("part is not null")


def divide_evenly(frames: DataFrame, n: int, keys=(), index="frame_idx") -> DataFrame:
    """n nearly equal consecutive parts per sequence; the first ones take the remainder."""
    keys = list(keys)
    ix = ordinal(frames, keys, [index], "_i")
    size = frames.groupBy(*keys).agg(F.count("*").alias("_n"))
    joined = ix.join(size, keys) if keys else ix.withColumn("_n", size.select("_n").scalar())
    base, rem, i = F.floor(F.col("_n") / n), F.col("_n") % n, F.col("_i")
    head = rem * (base + 1)
    part = F.when(i < head, F.floor(i / (base + 1))).otherwise(rem + F.floor((i - head) / F.greatest(base, F.lit(1))))
    return joined.withColumn("part", part.cast("int")).drop("_i", "_n")


def neighbor_marks(frames: DataFrame, marks: DataFrame, keys=()) -> DataFrame:
    """Next and previous marked frame of every frame, wrapping around the ends."""
    keys = list(keys)
    m = marks.select(*keys, "frame_idx").distinct()
    near = nearest(frames.select(*keys, "frame_idx"), m.withColumn("_one", F.lit(1)), keys, "frame_idx", ["_one"], strict=True)
    ends = m.groupBy(*keys).agg(F.min("frame_idx").alias("_lo"), F.max("frame_idx").alias("_hi"))
    joined = near.join(ends, keys, "left") if keys else near.withColumns(
        {"_lo": m.agg(F.min("frame_idx")).scalar(), "_hi": m.agg(F.max("frame_idx")).scalar()})
    return joined.select(
        *keys, "frame_idx", F.coalesce("next.frame_idx", "_lo").alias("next_mark"), F.coalesce("prev.frame_idx", "_hi").alias("prev_mark"))


def annotated_frames(boxed: DataFrame, marked: DataFrame, discarded: DataFrame, keys=()) -> DataFrame:
    """Frames with boxes or marks, without the discarded ones."""
    cols = [*keys, "frame_idx"]
    return boxed.select(*cols).unionByName(marked.select(*cols)).distinct().join(discarded.select(*cols).distinct(), cols, "left_anti")


def next_unlabeled(frames: DataFrame, boxed: DataFrame, reviewed: DataFrame, keys=()) -> DataFrame:
    """Next frame without boxes and not reviewed, wrapping around."""
    cols = [*keys, "frame_idx"]
    open_ = frames.select(*cols).join(boxed.select(*cols).unionByName(reviewed.select(*cols)).distinct(), cols, "left_anti")
    return neighbor_marks(frames, open_, keys).select(*cols, F.col("next_mark").alias("next_unlabeled"))


def anchor_spans(boxed: DataFrame, keyframe_marks: DataFrame, keys, min_gap=2) -> DataFrame:
    """Spans between consecutive anchors: keyframes with boxes, or all boxed frames where no keyframe has any."""
    keys = list(keys)
    cols = [*keys, "frame_idx"]
    key = keyframe_marks.select(*cols).distinct().withColumn("_key", F.lit(1))
    rows = boxed.select(*cols).distinct().join(key, cols, "left")
    any_key = rows.groupBy(*keys).agg(F.max("_key").alias("_any"))
    anchors = rows.join(any_key, keys).filter("_any is null or _key = 1").select(*cols)
    nxt = running(anchors, keys, [F.col("frame_idx").desc()], {"b": ("min", F.col("frame_idx"))}, before=True)
    return nxt.filter(F.col("b") - F.col("frame_idx") >= min_gap).select(*keys, F.col("frame_idx").alias("a"), "b")


def waypoints(marks: DataFrame, discarded: DataFrame, frames: DataFrame, poses: DataFrame, keys=()) -> DataFrame:
    """Marked frames numbered from 1 per session, with the pose of each side; frames without pose drop out
    but keep their number."""
    keys = list(keys)
    cols = [*keys, "frame_idx"]
    kept = marks.select(*cols).distinct().join(discarded.select(*cols).distinct(), cols, "left_anti")
    numbered = ordinal(kept, keys, ["frame_idx"], "waypoint", start=1)
    return pose_lookup(frames.join(numbered, cols), poses).filter("pos is not null")
