"""Model responses to labeled boxes: parsing, label clean-up, box order, class names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.operators.scale import computed_once, cut, ordinal
from framelark.operators.suppress import dedup_cross_class


def parse_responses(df: DataFrame, response="response", field=None) -> DataFrame:
    """Add dets; where the JSON does not parse, raw and parse_error instead. `field` is the key of the box
    where it is not one of the three usual ones."""
    got = computed_once(df, {"_list": text.json_list(text.json_block(F.col(response)))})
    valid = F.try_parse_json("_list").isNotNull()
    got = computed_once(got, {"dets": F.when(valid, F.from_json("_list", text.detections(field)))}).drop("_list")
    failed = F.col("dets").isNull()
    return got.withColumns({
        "raw": F.when(failed, F.col(response)),
        "parse_error": F.when(failed, F.lit("Could not parse as JSON")),
    })


def normalize_box_order(item: Column, order="xyxy", field=None) -> Column:
    """Box of a detection in x1, y1, x2, y2, taken from `field`, else bbox_2d, box_2d, bbox.

    Only the configured field and box_2d are read as y first. A list that is not four long stays as it is.
    """
    keys = ([field] if field else []) + [k for k in ("bbox_2d", "box_2d", "bbox") if k != field]

    def one(k):
        b = item[k]
        if order == "yxyx" and k in (field, "box_2d"):
            return F.when(F.size(b) == 4, F.array(b[1], b[0], b[3], b[2])).otherwise(b)
        return b

    return F.coalesce(*[F.when(item[k].isNotNull(), one(k)) for k in keys])


def filter_confidence(dets: DataFrame, threshold: float, categories: DataFrame, exempt_names=(), floor=0.0) -> DataFrame:
    """Detections at or above `threshold`; exempt classes only need `floor`."""
    sure = F.col("confidence") >= threshold
    if not exempt_names:
        return dets.filter(sure)
    exempt = categories.filter(F.col("name").isin(list(exempt_names))).select("category_id").distinct()
    low = dets.filter(~sure & (F.col("confidence") >= floor)).join(exempt, "category_id", "left_semi")
    return dets.filter(sure).unionByName(low.select(*dets.columns))


def scale_intrinsics(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """Focal lengths and centers scaled from calibration size to image size; unknown cameras raise.

    The calibration table has a row per camera; Spark broadcasts it when it is small.
    """
    lost = images.select("camera").distinct().join(cameras, "camera", "left_anti").take(1)
    if lost:
        raise ValueError(f"no calibration for camera {lost[0]['camera']}")
    sx, sy = F.col("width") / F.col("cal_width"), F.col("height") / F.col("cal_height")
    return images.join(cameras, "camera").withColumns({
        "fl_x": F.col("fl_x") * sx, "cx": F.col("cx") * sx, "fl_y": F.col("fl_y") * sy, "cy": F.col("cy") * sy,
    })


def canonicalize_labels(items: DataFrame, classes):
    """(items under the first requested class they match, items that match none)."""
    got = computed_once(items, {"_m": text.first_matching_class(F.col("label"), classes)})
    return got.filter("_m is not null").withColumn("label", F.col("_m")).drop("_m"), got.filter("_m is null").drop("_m")


def safe_class_names(classes: DataFrame, keys) -> DataFrame:
    """File-safe name per class; later ones of equal name get _2, _3, ... in class order."""
    named = classes.select(*keys, "class_name", text.safe_name(F.col("class_name")).alias("_s"))
    ranked = ordinal(named, [*keys, "_s"], ["class_name"], "_k", start=1)
    return ranked.select(
        *keys, "class_name",
        F.when(F.col("_k") > 1, F.concat_ws("_", "_s", F.col("_k").cast("string"))).otherwise(F.col("_s")).alias("safe_name"))


def label_remap(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace labels by name; of several entries for a name the last position wins."""
    last = mapping.groupBy("src").agg(F.max_by("dst", "pos").alias("_d"))
    return items.join(last.withColumnRenamed("src", "label"), "label", "left").withColumn(
        "label", F.coalesce("_d", "label")).drop("_d")


def merge_per_class_results(calls: DataFrame, keys=("image_id",)):
    """Union of the boxes each class-specific call returned for its own class.

    calls: keys, class_name, success, label and any payload, one row per detection.
    Returns (kept items relabeled to the class, kept and total counts per call).
    """
    good = calls.filter("success").withColumn("_hit", text.label_matches(F.col("label"), F.col("class_name")))
    counts = good.groupBy(*keys, "class_name").agg(F.count_if("_hit").alias("kept"), F.count("*").alias("total"))
    return good.filter("_hit").withColumn("label", F.col("class_name")).drop("_hit", "class_name", "success"), counts


def explode_detections(parsed: DataFrame, keys, order="xyxy", field=None) -> DataFrame:
    """One row per detection: keys, pos, label, score, bbox (array), missing where nothing parsed."""
    rows = parsed.select(*keys, F.posexplode("dets").alias("pos", "d"))
    return rows.select(*keys, "pos", F.col("d.label").alias("label"), F.col("d.score").alias("score"),
                       normalize_box_order(F.col("d"), order, field).alias("bbox"))


def canonical_boxes(responses: DataFrame, images: DataFrame, classes, order="xyxy", dedup_iou=0.75, coord_scale=1000.0, field=None) -> DataFrame:
    """Responses to pixel boxes: canonical labels, box order, cross-class duplicates, pixel scale.

    responses: image_id, response, and `document` where an image has several (they count in its order);
    images: image_id, width, height.
    """
    if "document" not in responses.columns:
        responses = responses.withColumn("document", F.lit(0))
    dets = explode_detections(parse_responses(responses, field=field), ["image_id", "document"], order, field)
    kept, _ = canonicalize_labels(dets, classes)
    boxed = kept.filter(F.size("bbox") == 4).select(
        "image_id", "document", "pos", F.struct("image_id", "document", "pos").alias("id"), "label", "score",
        *[F.col("bbox")[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])
    # Several passes follow; parsing must not be repeated for each.
    one = dedup_cross_class(cut(boxed), ["image_id"], dedup_iou)
    w, h = F.col("width"), F.col("height")
    return one.join(images.select("image_id", "width", "height"), "image_id").select(
        "image_id", "pos", "label", "score",
        *[geo.scale_coords(F.col(c), d, coord_scale).alias(c) for c, d in (("x1", w), ("y1", h), ("x2", w), ("y2", h))])
