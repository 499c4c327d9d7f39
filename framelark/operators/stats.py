"""Summaries of tracks, timings, trials, point clouds and review state; sampling and splitting."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.operators.scale import cut, exact_quantiles, ordinal

# Fixed settings of the ground fit and the displacement consensus.
LOW_SLICE, FIT_ROUNDS, INLIER_DIST, MIN_INLIERS, LEVEL_TILT = 0.15, 4, 0.25, 50, 1.0
FB_LIMIT, MIN_TOL, MAD_FACTOR = 1.0, 2.0, 3.0
# Up to this size a sample is cheaper as a top-k than as a distributed ranking.
TOP_K_ROWS = 10_000


def track_lengths(anns: DataFrame, keys=()) -> DataFrame:
    """Per track: boxes, frames spanned, first and last frame."""
    return anns.filter("track_id is not null").groupBy(*keys, "track_id").agg(
        F.count("*").alias("boxes"), F.min("frame_idx").alias("first_frame"), F.max("frame_idx").alias("last_frame"))


def track_summary(anns: DataFrame, images: DataFrame) -> DataFrame:
    """One row: images, annotations, distinct tracks, annotations with a mask."""
    n_images = images.agg(F.count("*")).scalar()
    return anns.agg(
        F.count("*").alias("annotations"), F.count_distinct("track_id").alias("tracks"),
        F.count_if("has_mask").alias("with_mask"),
    ).select(n_images.alias("images"), "annotations", "tracks", "with_mask")


def tracks_per_frame(anns: DataFrame, keys=()) -> DataFrame:
    return anns.filter("track_id is not null").groupBy(*keys, "frame_idx").agg(F.count_distinct("track_id").alias("tracks"))


def latency_profile(times: DataFrame, series, order, value, warmup=0) -> DataFrame:
    """Timing statistics per series after leaving out its first `warmup` rows; empty series give no row."""
    series = list(series)
    timed = ordinal(times, series, order, "_i").filter(F.col("_i") >= warmup) if warmup else times
    basic = timed.groupBy(*series).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.sum(value).alias("total"))
    q = exact_quantiles(timed, series, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return basic.join(q, series).withColumn("per_second", F.when(F.col("mean") != 0, 1.0 / F.col("mean")))


def frame_reduction(raw: DataFrame, levels: dict) -> DataFrame:
    """Frames per camera at each level: raw, then the given {level: table with camera}."""
    tagged = raw.select("camera", F.lit("raw").alias("level"))
    for name, df in levels.items():
        tagged = tagged.unionByName(df.select("camera", F.lit(name).alias("level")))
    names = ["raw", *levels]
    counts = tagged.groupBy("camera").pivot("level", names).count()
    return counts.select("camera", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def labeling_summary(responses: DataFrame, kept: DataFrame, dropped: DataFrame) -> DataFrame:
    """One row: images ok and failed, parse errors, classes found, labels dropped.

    responses: success, parse_error; kept and dropped: label.
    """
    classes = kept.agg(F.count_distinct("label")).scalar()
    lost = dropped.agg(F.count("*")).scalar()
    return responses.agg(
        F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("failed"),
        F.count("parse_error").alias("parse_errors"),
    ).select("ok", "failed", "parse_errors", classes.alias("classes"), lost.alias("dropped_labels"))


def trial_leaderboard(trials: DataFrame, keys=(), mode="max") -> DataFrame:
    """Best successful trial by score (NULL ignored, earliest wins ties) and trial counts."""
    good = (F.col("status") == "success") & F.col("score").isNotNull()
    rank = F.struct(F.when(F.lit(mode == "max"), -F.col("score")).otherwise(F.col("score")).alias("k"), "trial_id", "score")
    return trials.groupBy(*keys).agg(
        F.min(F.when(good, rank)).alias("b"), F.count("*").alias("trials"),
        F.count_if(F.col("status") != "running").alias("completed"),
    ).select(*keys, F.col("b.trial_id").alias("best_trial"), F.col("b.score").alias("best_score"), "trials", "completed")


def group_by_size(images: DataFrame) -> DataFrame:
    return images.groupBy("width", "height").agg(F.count("*").alias("n"))


def consensus_displacement(points: DataFrame, keys) -> DataFrame:
    """Median displacement of the points of a box that agree with each other.

    points: keys, dx, dy, fb_error (NULL = not tracked back). Median and MAD run over all points, the
    result over those with a small forward-backward error and within the tolerance on both axes;
    dx, dy are NULL when none is left.
    """
    keys = list(keys)
    rows = points.filter("dx is not null and dy is not null")

    def medians(df, a, b):
        return exact_quantiles(df, keys, a, {f"m_{a}": 0.5}).join(exact_quantiles(df, keys, b, {f"m_{b}": 0.5}), keys)

    dev = rows.join(medians(rows, "dx", "dy"), keys).withColumns(
        {"ax": F.abs(F.col("dx") - F.col("m_dx")), "ay": F.abs(F.col("dy") - F.col("m_dy"))})
    tol = lambda c: F.greatest(F.lit(MIN_TOL), F.lit(MAD_FACTOR) * F.col(c))
    kept = dev.join(medians(dev, "ax", "ay"), keys).filter(
        (F.col("fb_error") < FB_LIMIT) & (F.col("ax") <= tol("m_ax")) & (F.col("ay") <= tol("m_ay")))
    n = kept.groupBy(*keys).agg(F.count("*").alias("kept"))
    final = medians(kept.select(*keys, "dx", "dy"), "dx", "dy").join(n, keys)
    return rows.select(*keys).distinct().join(final, keys, "left").select(
        *keys, F.col("m_dx").alias("dx"), F.col("m_dy").alias("dy"), F.coalesce("kept", F.lit(0)).alias("kept"))


def _plane_normal(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
    """Unit direction of least variance of each covariance matrix, pointing up."""
    m = np.stack([xx, xy, xz, xy, yy, yz, xz, yz, zz], axis=1).astype(float).reshape(-1, 3, 3)
    n = np.linalg.eigh(np.nan_to_num(m))[1][:, :, 0]
    n = np.where(n[:, 2:3] < 0, -n, n)
    return pd.Series(list(n))


def ground_plane_fit(points: DataFrame, keys=("cloud",), approximate=False) -> DataFrame:
    """Ground plane of each cloud: unit normal, tilt in degrees, inliers, level flag.

    points: keys, x, y, z. Fits the lowest slice by z, then refits on points near the last plane.
    Each round is one aggregate of nine moments per cloud; clouds with too few inliers give no row.
    `approximate` takes the height limit from a quantile sketch.
    """
    keys = list(keys)
    if approximate:
        limit = points.groupBy(*keys).agg(F.percentile_approx("z", LOW_SLICE, 10_000).alias("_lim"))
    else:
        limit = exact_quantiles(points, keys, "z", {"_lim": LOW_SLICE})
    low = points.join(cut(limit), keys).filter("z <= _lim").select(*keys, "x", "y", "z")
    cur = low
    axes = ("x", "y", "z")
    for _ in range(FIT_ROUNDS):
        moments = cur.groupBy(*keys).agg(
            *[F.avg(a).alias(f"c{a}") for a in axes],
            *[F.covar_pop(a, b).alias(f"v{a}{b}") for i, a in enumerate(axes) for b in axes[i:]])
        normal = F.pandas_udf(_plane_normal, "array<double>")("vxx", "vxy", "vxz", "vyy", "vyz", "vzz")
        plane = cut(moments.select(*keys, "cx", "cy", "cz", normal.alias("n")))
        dist = sum((F.col(a) - F.col(f"c{a}")) * F.col("n")[i] for i, a in enumerate(axes))
        cur = low.join(plane, keys).filter(F.abs(dist) < INLIER_DIST).select(*keys, *axes)
    got = cur.groupBy(*keys).agg(F.count("*").alias("inliers")).filter(F.col("inliers") >= MIN_INLIERS)
    nz = F.least(F.greatest(F.col("n")[2], F.lit(-1.0)), F.lit(1.0))
    tilt = F.degrees(F.acos(nz))
    return got.join(plane, keys).select(
        *keys, *[F.col("n")[i].alias(f"n{a}") for i, a in enumerate(axes)], tilt.alias("tilt"), "inliers",
        (tilt < LEVEL_TILT).alias("level"))


def annotation_coverage(images: DataFrame, anns: DataFrame, keys=()) -> DataFrame:
    """Frames with boxes on any side over all frames. images: keys, image_id, frame_idx; anns: image_id."""
    boxed = anns.select("image_id").distinct().withColumn("_b", F.lit(1))
    per = images.join(boxed, "image_id", "left").groupBy(*keys, "frame_idx").agg(F.max("_b").alias("_b"))
    return per.groupBy(*keys).agg(F.count("*").alias("frames"), F.count("_b").alias("boxed")).withColumn(
        "coverage", F.col("boxed") / F.col("frames"))


# --- sampling and splitting -----------------------------------------------------------------------


def shuffle_key(id_col, seed):
    """Position of a row in the seeded order: md5 of seed and id, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _take(df, order, n):
    if n <= TOP_K_ROWS:
        return df.orderBy(*order).limit(n)
    return ordinal(df, [], order, "_i").filter(F.col("_i") < n).drop("_i")


def sample_n(pool: DataFrame, id_col, n: int, seed=0, strict=True) -> DataFrame:
    """Exactly n rows of the pool in seeded order; a smaller pool raises, or is returned whole."""
    have = pool.count()
    if have < n and strict:
        raise ValueError(f"cannot sample {n} of {have}")
    keyed = pool.withColumn("_h", shuffle_key(id_col, seed))
    return _take(keyed, ["_h", id_col], min(n, have)).drop("_h")


def first_n(df: DataFrame, order, n: int) -> DataFrame:
    return _take(df, [order] if isinstance(order, str) else list(order), n)


def random_split(images: DataFrame, id_col, ratios=(0.7, 0.15, 0.15), seed=0) -> DataFrame:
    """Adds split in seeded order: train, then test, then val with the rest."""
    if abs(sum(ratios) - 1.0) > 0.001:
        raise ValueError("ratios must sum to 1")
    total = images.count()
    if total == 0:
        raise ValueError("no images to split")
    train = int(total * ratios[0])
    test = train + int(total * ratios[1])
    ranked = ordinal(images.withColumn("_h", shuffle_key(id_col, seed)), [], ["_h", id_col], "_i")
    split = F.when(F.col("_i") < train, "train").when(F.col("_i") < test, "test").otherwise("val")
    return ranked.withColumn("split", split).drop("_h", "_i")
