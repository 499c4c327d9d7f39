"""Label conversion and the label side of augmentation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.operators.matching import mosaic_neighbors
from framelark.operators.responses import explode_detections, parse_responses
from framelark.operators.scale import computed_once, cut, filter_late, ordinal


def coco_to_seg_labels(images: DataFrame, anns: DataFrame, cats: DataFrame, rectangles=False):
    """(label lines, one-row summary).

    images: image_id, file_name, side, width, height; anns: ann_id, image_id, category_id, box as x, y, w,
    h, segmentation (array of polygons). Category ids become contiguous in id order. Boxes without a
    polygon are left out, or become rectangles; both ways they are counted. In stereo sets names carry
    the side in front.
    """
    ids = ordinal(cats.select("category_id").distinct(), [], ["category_id"], "class_id")
    stereo = ~images.filter("side = 'right'").isEmpty()
    side = F.coalesce("side", F.lit("left"))
    name = F.concat(side, F.lit("_"), F.col("file_name")) if stereo else F.col("file_name")
    im = images.select("image_id", text.stem(name).alias("stem"), "width", "height")
    real = F.filter(F.coalesce("segmentation", F.array().cast("array<array<double>>")), lambda p: F.size(p) > 0)
    rows = anns.join(ids, "category_id").withColumn("_p", real).withColumn("maskless", F.size("_p") == 0)
    if rectangles:
        rect = F.array(geo.bbox_to_polygon(*[F.col(c) for c in ("x", "y", "w", "h")]))
        rows = rows.withColumn("_p", F.when(F.col("maskless"), rect).otherwise(F.col("_p")))
    lines = rows.join(im, "image_id").select(
        "stem", "ann_id", "class_id", "width", "height", F.posexplode_outer("_p").alias("part", "poly"))
    usable = lines.filter((F.size("poly") >= 6) & (F.size("poly") % 2 == 0))
    points = geo.polygon_to_yolo(F.col("poly"), F.col("width"), F.col("height"))
    out = usable.select("stem", "ann_id", "part", F.concat_ws(" ", F.col("class_id").cast("string"), points).alias("line"))
    summary = rows.join(im.select("image_id"), "image_id", "left_semi").agg(F.count_if("maskless").alias("maskless")).select(
        im.agg(F.count("*")).scalar().alias("images"), out.agg(F.count("*")).scalar().alias("polygons"), "maskless")
    return out, summary


def vlm_to_annotations(results: DataFrame):
    """(images, annotations, categories) from per-image model results.

    results: file_name, width, height, response. Files go in name order; frame_idx counts unreadable
    ones too. Categories are numbered in order of first appearance.
    """
    ix = ordinal(results, [], ["file_name"], "frame_idx")
    # Parsing is the costly step; its result is written once for the passes below.
    parsed = cut(parse_responses(ix).filter("dets is not null"))
    im = ordinal(parsed.drop("dets", "raw", "parse_error", "response"), [], ["frame_idx"], "image_id", start=1)
    images = im.withColumn("timestamp_ns", text.source_id(F.col("file_name")).cast("long"))
    dets = explode_detections(parsed, ["frame_idx"]).select("frame_idx", "pos", F.trim("label").alias("label"), "bbox")
    good = dets.filter((F.length("label") > 0) & (F.size("bbox") == 4) & ~F.exists("bbox", lambda v: v.isNull()))
    first = good.groupBy("label").agg(F.min(F.struct("frame_idx", "pos")).alias("_f"))
    cats = ordinal(first, [], ["_f"], "category_id").select(F.col("category_id").cast("int").alias("category_id"), F.col("label").alias("name"))
    box = [F.col("bbox")[i] for i in range(4)]
    c, keep = geo.clip_box(box, F.col("width").cast("double"), F.col("height").cast("double"), reorder=True)
    rows = good.join(images.select("frame_idx", "image_id", "width", "height"), "frame_idx").filter(keep).select(
        "image_id", "pos", "label", *[v.alias(n) for v, n in zip(c, ("x1", "y1", "x2", "y2"))])
    anns = ordinal(rows, [], ["image_id", "pos"], "ann_id", start=1).join(cats.withColumnRenamed("name", "label"), "label").select(
        "ann_id", "image_id", "category_id", F.col("x1").alias("x"), F.col("y1").alias("y"),
        (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"),
        ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"))
    return images, anns, cats


def parse_labels(lines: DataFrame) -> DataFrame:
    """class_id, kind (det or seg) and coords of each label line; lines with bad numbers drop out."""
    p = text.tokens(F.col("line"))
    rows = computed_once(lines, {"_p": p})
    rows = computed_once(rows, {"kind": text.label_kind(F.col("_p")), "class_id": text.as_int(F.get("_p", F.lit(0))),
                                "coords": F.transform(F.slice("_p", 2, F.greatest(F.size("_p") - 1, F.lit(0))), text.as_float)})
    enough = F.when(F.col("kind") == "seg", F.size("coords") >= 6).otherwise(F.size("coords") >= 4)
    good = enough & F.col("class_id").isNotNull() & ~F.exists("coords", lambda v: v.isNull())
    return filter_late(rows, good).drop("_p")


def _with(coords, values):
    """coords with the first entries replaced."""
    return F.concat(F.array(*values), F.slice(coords, len(values) + 1, F.greatest(F.size(coords) - len(values), F.lit(0))))


def flip_labels(labels: DataFrame, axis="h") -> DataFrame:
    """Mirror parsed labels; boxes move their center only."""
    c = F.col("coords")
    xc, yc = geo.flip_center(F.get(c, F.lit(0)), F.get(c, F.lit(1)), axis)
    return labels.withColumn("coords", F.when(F.col("kind") == "seg", geo.flip_points(c, axis)).otherwise(_with(c, [xc, yc])))


def rotate_labels(labels: DataFrame, min_visible=0.01) -> DataFrame:
    """Rotate parsed labels about the image center by the row's `angle` (degrees); uses width, height.

    Boxes become the clipped box around their corners, polygons are clipped point by point; what is
    hardly visible afterwards drops out. Polygons carry 6 decimals.
    """
    c, w, h = F.col("coords"), F.col("width").cast("double"), F.col("height").cast("double")
    is_seg = F.col("kind") == "seg"
    dim = lambda i: F.when(i % 2 == 0, w).otherwise(h)
    px = F.transform(F.slice(c, 1, 2 * F.floor(F.size(c) / F.lit(2)).cast("int")), lambda v, i: v * dim(i))
    at = lambda i: F.get("coords", F.lit(i))
    corners = geo.center_to_xyxy(at(0) * w, at(1) * h, at(2) * w, at(3) * h)
    rows = labels.withColumns({
        "_cos": F.cos(F.radians("angle")), "_sin": F.sin(F.radians("angle")), "_px": F.when(is_seg, px),
        **{f"_b{i}": F.when(~is_seg, v) for i, v in enumerate(corners)},
    })
    cos, sin, b = F.col("_cos"), F.col("_sin"), [F.col(f"_b{i}") for i in range(4)]
    rows = rows.withColumns({
        "_rot": geo.rotate_polygon(F.col("_px"), cos, sin, w, h),
        **{f"_e{i}": geo.clamp(v, 0.0, (w, h)[i % 2]) for i, v in enumerate(geo.rotated_extent(b, cos, sin, w, h))},
    })
    e = [F.col(f"_e{i}") for i in range(4)]
    ew, eh = e[2] - e[0], e[3] - e[1]
    share = ew * eh / ((b[2] - b[0]) * (b[3] - b[1]))
    before = geo.polygon_area(F.col("_px"))
    rows = rows.withColumns({
        "_share": F.when(is_seg, geo.polygon_area(F.col("_rot")) / F.when(before > 0, before)).otherwise(share),
        "_det": F.when(~is_seg, _with(c, [(e[0] + e[2]) / 2 / w, (e[1] + e[3]) / 2 / h, ew / w, eh / h])),
        "_poly": F.transform("_rot", lambda v, i: F.bround(v / dim(i), 6)),
        "_some": is_seg | ((ew > 0) & (eh > 0)),
    })
    # A shape without area of its own has no share to lose.
    kept = filter_late(rows, F.col("_some") & (F.col("_share").isNull() | (F.col("_share") >= min_visible)))
    return kept.withColumn("coords", F.when(is_seg, F.col("_poly")).otherwise(F.col("_det"))).select(*labels.columns)


def mosaic_labels(images: DataFrame, labels: DataFrame, keys=()) -> DataFrame:
    """Labels of the 2 x 2 mosaics of neighboring images: half size plus the quadrant's offset."""
    keys = list(keys)
    slots = mosaic_neighbors(images, keys, "stem", "stem").withColumnRenamed("member", "stem")
    dx, dy = (F.col("quadrant") % 2) * 0.5, F.floor(F.col("quadrant") / 2) * 0.5
    moved = F.transform("coords", lambda v, i: v / 2.0 + F.when(i % 2 == 0, dx).otherwise(dy))
    c = F.col("coords")
    half = [F.get(c, F.lit(i)) / 2.0 for i in range(4)]
    det = _with(c, [half[0] + dx, half[1] + dy, half[2], half[3]])
    joined = labels.join(slots, [*keys, "stem"])
    return joined.withColumn("coords", F.when(F.col("kind") == "seg", moved).otherwise(det)).withColumn(
        "name", F.concat(F.col("image"), F.lit("_mosaic")))


def augmentation_plan(images: DataFrame, types, multiplier: int, seed=0, rotation=(-15.0, 15.0), brightness=(0.7, 1.3)) -> DataFrame:
    """Output names per image: the original, `multiplier` copies of a seeded random type, and the mosaic.

    mosaic is never drawn unless it is the only type. Rotations carry a drawn `angle` (degrees, as
    `rotate_labels` takes it), brightness and contrast a drawn `factor`. images: stem.
    """
    none = F.lit(None).cast("double")
    draw = [t for t in types if t != "mosaic"] or list(types)
    copies = images.select("stem", F.explode(F.sequence(F.lit(0), F.lit(multiplier - 1))).alias("copy")) if multiplier > 0 else None
    plan = images.select("stem", F.lit(-1).alias("copy"), F.lit("original").alias("type"), F.col("stem").alias("name"), none.alias("angle"), none.alias("factor"))
    if copies is not None:
        key = F.concat_ws("/", F.col("stem"), F.col("copy").cast("string"))
        h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("long")
        kind = F.get(F.array(*[F.lit(t) for t in draw]), (h % len(draw)).cast("int"))
        u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 9, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        within = lambda r: F.lit(float(r[0])) + u * F.lit(float(r[1]) - float(r[0]))
        drawn = copies.withColumn("type", kind).withColumns({
            "angle": F.when(F.col("type") == "rotate", within(rotation)),
            "factor": F.when(F.col("type").isin("brightness", "contrast"), within(brightness))})
        plan = plan.unionByName(drawn.withColumn(
            "name", F.concat(F.col("stem"), F.lit("_aug"), F.col("copy").cast("string"), F.lit("_"), F.col("type"))))
    if "mosaic" in types:
        firsts = mosaic_neighbors(images, [], "stem", "stem").filter("quadrant = 0").select(F.col("image").alias("stem"))
        plan = plan.unionByName(firsts.select(
            "stem", F.lit(-1).alias("copy"), F.lit("mosaic").alias("type"), F.concat("stem", F.lit("_mosaic")).alias("name"),
            none.alias("angle"), none.alias("factor")))
    return plan
