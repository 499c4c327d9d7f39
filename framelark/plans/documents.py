"""Sources and sinks over documents that Spark derives from the tables."""

from pyspark.sql import functions as F

from framelark.operators import datasets
from framelark.operators.scale import cut, scratch_path
from framelark.plans.registry import query
from framelark.sources import readers, writers

BOX = ["x1", "y1", "x2", "y2"]


def _coco_parts(t):
    images = t.fx_image.withColumn("position", F.col("image_id"))
    return images, t.fx_gt, t.region.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name"))


def _coco_docs(t):
    return cut(writers.coco_documents(*_coco_parts(t)))


@query("read_coco", "SELECT ann_id, image_id, category_id, x1, y1, x2, y2 FROM fx_gt")
def _(t):
    return readers.coco_tables(_coco_docs(t))[1].select("ann_id", "image_id", "category_id", *BOX)


@query("coco_documents_alone", "SELECT ann_id, image_id, file_name FROM fx_gt JOIN fx_image USING (image_id)")
def _(t):
    # Each document is read by itself: annotations meet the images of their own document only.
    images, anns, _cats = readers.coco_tables(_coco_docs(t))
    return anns.join(images.select("shard", "image_id", "file_name"), ["shard", "image_id"]).select("ann_id", "image_id", "file_name")


@query("coco_documents_sliced", "SELECT ann_id, image_id, file_name FROM fx_gt JOIN fx_image USING (image_id)")
def _(t):
    """Documents so small that most images are cut; every annotation still finds its image in its own."""
    images, anns, cats = _coco_parts(t)
    images, anns, _cats = readers.coco_tables(cut(writers.coco_documents(images, anns, cats, rows_per_doc=2)))
    return anns.join(images.select("shard", "image_id", "file_name"), ["shard", "image_id"]).select("ann_id", "image_id", "file_name")


@query("read_large_coco", "SELECT ann_id, image_id, category_id, x1, y1, x2, y2 FROM fx_gt")
def _(t):
    """Files of 20,000 images and annotations, each read by several tasks."""
    spark = t.fx_gt.sparkSession
    base = scratch_path(spark, "documents")
    writers.write_coco(writers.coco_documents(*_coco_parts(t), rows_per_doc=20_000), base)
    return readers.read_large_coco(spark, base)[1].select("ann_id", "image_id", "category_id", *BOX)


@query("export_coco", """SELECT image_id, row_number() OVER (ORDER BY timestamp_ns, image_id) - 1 AS position FROM fx_image
    WHERE image_id % 50 <> 7""")
def _(t):
    # Frames discarded in review leave the final set; positions follow time.
    images = t.fx_image.select("image_id", "file_name", "timestamp_ns", F.col("image_id").alias("frame_idx"), F.lit("left").alias("side"))
    anns = t.fx_gt
    gone = images.filter("image_id % 50 = 7").select("frame_idx")
    return datasets.export_tables(images, anns, anns.filter("category_id = 4"), gone, images.filter("image_id % 9 = 0"))[0].select("image_id", "position")


@query("export_coco_annotated", """SELECT image_id FROM fx_image i WHERE image_id % 50 <> 7 AND (image_id % 9 = 0 OR image_id IN (SELECT image_id FROM fx_gt WHERE category_id <> 4))""")
def _(t):
    images = t.fx_image.select("image_id", "file_name", "timestamp_ns", F.col("image_id").alias("frame_idx"), F.lit("left").alias("side"))
    gone = images.filter("image_id % 50 = 7").select("frame_idx")
    return datasets.export_tables(images, t.fx_gt, t.fx_gt.filter("category_id = 4"), gone, images.filter("image_id % 9 = 0"))[2]


@query("export_documents", """SELECT image_id, timestamp_ns FROM fx_image i WHERE image_id % 50 <> 7 AND (image_id % 9 = 0 OR image_id IN (SELECT image_id FROM fx_gt WHERE category_id <> 4))""")
def _(t):
    # What the documents themselves say is annotated, each read alone.
    images = t.fx_image.select("image_id", "file_name", "timestamp_ns", F.col("image_id").alias("frame_idx"), F.lit("left").alias("side"))
    cats = t.region.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name"))
    gone = images.filter("image_id % 50 = 7").select("frame_idx")
    docs = writers.export_documents(images, t.fx_gt, cats, t.fx_gt.filter("category_id = 4"), gone, images.filter("image_id % 9 = 0"))
    said = docs.select(F.from_json("doc", "images ARRAY<STRUCT<id:BIGINT,timestamp_ns:BIGINT>>, annotated_image_ids ARRAY<BIGINT>, annotated_timestamps ARRAY<BIGINT>").alias("d"))
    rows = said.select("d.annotated_image_ids", "d.annotated_timestamps", F.explode("d.images").alias("i"))
    rows = rows.filter(F.array_contains("annotated_image_ids", F.col("i.id")) & F.array_contains("annotated_timestamps", F.col("i.timestamp_ns")))
    return rows.select(F.col("i.id").alias("image_id"), F.col("i.timestamp_ns").alias("timestamp_ns"))


@query("read_label_lines", "SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY line_num) * 2 - 1 AS line_num, line FROM fx_label_line")
def _(t):
    # Label files with a blank line after each label.
    docs = datasets.bounded_lists(t.fx_label_line, ["stem"], ["line_num"], F.col("line"), "ls")
    return readers.label_lines(docs.select("stem", F.array_join("ls", "\n\n").alias("body")))


@query("list_images", """SELECT split || '/' || image_id || CASE image_id % 3 WHEN 0 THEN '.JPG' ELSE '.png' END AS path, image_id::VARCHAR AS stem FROM fx_image WHERE image_id % 3 <> 2""")
def _(t):
    ext = F.when(F.col("image_id") % 3 == 0, ".JPG").when(F.col("image_id") % 3 == 1, ".png").otherwise(".txt")
    return readers.image_listing(t.fx_image.select(F.concat("split", F.lit("/"), "image_id", ext).alias("path"))).select("path", "stem")


@query("read_class_names", "SELECT image_id, ann_id, category_id AS class_id, CASE WHEN category_id < 3 THEN n_name ELSE 'class_' || category_id END AS class_name FROM fx_gt LEFT JOIN nation ON n_nationkey = category_id")
def _(t):
    lines = t.nation.filter("n_nationkey < 3").select(F.col("n_nationkey").alias("pos"), F.concat(F.lit(" "), "n_name").alias("value"))
    rows = t.fx_gt.select("image_id", "ann_id", F.col("category_id").alias("class_id"))
    return readers.with_class_names(rows, readers.class_names(lines))


@query("read_vlm_results", """SELECT image_id, 'm1' AS model, response FROM fx_vlm WHERE image_id % 11 <> 0""")
def _(t):
    good = F.to_json(F.struct(F.col("image_id").cast("string").alias("image"), F.lit("m1").alias("model"), F.col("response").alias("raw_response")))
    docs = t.fx_vlm.select("image_id", F.when(F.col("image_id") % 11 == 0, F.substring(good, 1, 20)).otherwise(good).alias("doc"), F.col("image_id").alias("file_name"))
    return readers.vlm_results(docs)[0].select("image_id", "model", F.col("raw_response").alias("response"))


@query("read_predictions", "SELECT pred_id, image_id::VARCHAR AS image_id, category_id AS class_id, confidence, x1, y1, x2, y2 FROM fx_pred")
def _(t):
    p = F.struct(F.col("image_id"), F.col("category_id").alias("class_id"), F.when(F.col("pred_id") % 2 == 0, F.array(*BOX)).alias("bbox"),
                 F.when(F.col("pred_id") % 2 == 1, F.array(*BOX)).alias("bbox_2d"), F.col("confidence").alias("score"))
    keys = ["predictions", "results", "data", "bboxes", "parsed_output"]
    doc = F.to_json(F.array(p))
    for i, k in enumerate(keys):
        doc = F.when(F.col("pred_id") % 6 == i, F.to_json(F.struct(F.array(p).alias(k)))).otherwise(doc)
    return readers.predictions(t.fx_pred.select("pred_id", doc.alias("doc"))).drop("pos", "label")


@query("discover_splits", """SELECT image_id::VARCHAR AS stem, CASE WHEN image_id % 3 = 2 THEN 'all' ELSE split END AS split FROM fx_image""")
def _(t):
    alias = F.when((F.col("split") == "val") & (F.col("image_id") % 2 == 0), "valid").otherwise(F.col("split"))
    p = F.when(F.col("image_id") % 3 == 0, F.concat(F.lit("/d/"), alias, F.lit("/labels/"))).when(F.col("image_id") % 3 == 1, F.concat(F.lit("/d/labels/"), alias, F.lit("/"))).otherwise(F.lit("/d/labels/"))
    return readers.require_splits(readers.discover_splits(t.fx_image.select(F.concat(p, "image_id", F.lit(".txt")).alias("path")))).select("stem", "split")


@query("read_keyframe_boxes", """SELECT video_id, frame_idx, ann_id AS id, category_id, x + w / 2 AS cx, y + h / 2 AS cy FROM fx_keybox WHERE h > 24 AND frame_idx % 10 = 0""")
def _(t):
    k = t.fx_keybox.select("video_id", "frame_idx", "ann_id", "category_id", "x", "y", "w", F.when(F.col("h") > 24, F.col("h")).otherwise(0.0).alias("h"), F.col("frame_idx").alias("image_id"))
    images = k.select("video_id", "image_id").distinct().select("*", F.concat(F.lit("/data/"), "image_id", F.lit(".jpg")).alias("file_name"))
    man = images.filter("image_id % 10 = 0").select("video_id", F.col("image_id").alias("frame_idx"), F.concat("image_id", F.lit(".jpg")).alias("file_name"))
    return readers.keyframe_boxes(images, k.drop("frame_idx"), man, ["video_id"]).select("video_id", "frame_idx", "id", "category_id", "cx", "cy")


@query("read_session_marks", """SELECT session, kind, frame_idx FROM (
      SELECT o_custkey AS session, CASE o_orderstatus WHEN 'F' THEN 'reviewed' WHEN 'O' THEN 'keyframes' ELSE 'discarded' END AS kind, o_orderkey AS frame_idx FROM orders)""")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("session"), "o_orderkey", F.when(F.col("o_orderstatus") == "F", "reviewed").when(F.col("o_orderstatus") == "O", "keyframes").otherwise("discarded").alias("kind"))
    lists = datasets.bounded_lists(rows, ["session", "kind"], ["o_orderkey"], F.col("o_orderkey"), "ix")
    doc = F.to_json(F.create_map(F.col("kind"), F.col("ix")))
    return readers.session_marks(lists.select("session", doc.alias("doc")))


@query("read_per_class_annotations", """SELECT image_id AS image, category_id::VARCHAR AS class_name, ann_id, greatest(0, least(x1, 90)) AS x1, greatest(0, least(x2, 90)) AS x2 FROM fx_gt
    WHERE greatest(0, least(x2, 90)) > greatest(0, least(x1, 90)) AND least(y2, 70) > y1""")
def _(t):
    docs = t.fx_gt.select(F.col("image_id").alias("image"), "ann_id", F.to_json(F.struct(F.col("category_id").cast("string").alias("class_name"), F.array(F.array(*BOX)).alias("bboxes"))).alias("doc"))
    images = t.fx_image.select(F.col("image_id"), F.lit(90).alias("width"), F.lit(70).alias("height"))
    keyed = docs.withColumn("image", F.concat_ws("/", F.col("image").cast("string"), F.col("ann_id").cast("string"))).drop("ann_id")
    dims = t.fx_gt.join(images, "image_id").select(F.concat_ws("/", F.col("image_id").cast("string"), F.col("ann_id").cast("string")).alias("image"), "width", "height")
    got = readers.per_class_annotations(keyed, dims)
    return got.select(F.split("image", "/")[0].cast("long").alias("image"), "class_name", F.split("image", "/")[1].cast("long").alias("ann_id"), "x1", "x2")


_N = "printf('%.6f', {v})"


@query("write_yolo_labels", f"""SELECT split, i.image_id::VARCHAR AS stem, ann_id, category_id || ' ' || {_N.format(v='(x1 + x2) / 2 / 640::DOUBLE')} || ' ' || {_N.format(v='(y1 + y2) / 2 / 480::DOUBLE')}
      || ' ' || {_N.format(v='(x2 - x1) / 640::DOUBLE')} || ' ' || {_N.format(v='(y2 - y1) / 480::DOUBLE')} AS line FROM fx_image i LEFT JOIN fx_gt g ON g.image_id = i.image_id""")
def _(t):
    images = t.fx_image.select("image_id", F.col("image_id").cast("string").alias("stem"), "split", "width", "height")
    return writers.yolo_lines(t.fx_gt.withColumn("class_id", F.col("category_id")), images)


@query("write_label_files", f"""SELECT split, i.image_id::VARCHAR AS stem, coalesce(string_agg(g.category_id || ' ' || {_N.format(v='(x1 + x2) / 2 / 640::DOUBLE')}, chr(10) ORDER BY ann_id), '') AS body
    FROM fx_image i LEFT JOIN fx_gt g ON g.image_id = i.image_id GROUP BY ALL""")
def _(t):
    images = t.fx_image.select("image_id", F.col("image_id").cast("string").alias("stem"), "split", "width", "height")
    out = scratch_path(images.sparkSession, "labels")
    files = writers.write_label_files(writers.yolo_lines(t.fx_gt.withColumn("class_id", F.col("category_id")), images), out)
    found = readers.read_label_files(files, out).withColumn("lines", F.split(F.regexp_replace("body", "\n$", ""), "\n"))
    two = F.array_join(F.transform("lines", lambda v: F.substring_index(v, " ", 2)), "\n")
    return found.select("split", "stem", two.alias("body"))


@query("write_stats_csv", "SELECT event_type, count(*) AS n, printf('%.2f', avg(value)) AS mean, printf('%.4f', max(value)) AS top FROM events GROUP BY 1")
def _(t):
    s = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("top"))
    two = writers.format_numbers(s.select("event_type", "n", "mean"), 2)
    return two.join(writers.format_numbers(s.select("event_type", "top"), 4), "event_type")


@query("write_per_class_annotations", """SELECT image_id AS image, 'class ' || category_id AS class_name, 'class_' || category_id AS safe_name, count(*) AS n, sum(least(trunc(x2), 90) - least(trunc(x1), 90))::BIGINT AS width
    FROM fx_gt GROUP BY ALL""")
def _(t):
    boxes = t.fx_gt.select(F.col("image_id").alias("image"), F.concat(F.lit("class "), "category_id").alias("class_name"), F.col("ann_id").alias("pos"), *BOX)
    images = t.fx_image.select(F.col("image_id").alias("image"), F.lit(90).alias("width"), F.lit(70).alias("height"))
    d = writers.per_class_documents(boxes, images).select("image", "class_name", "safe_name", F.explode("bboxes").alias("b"))
    return d.groupBy("image", "class_name", "safe_name").agg(F.count("*").alias("n"), F.sum(F.col("b")[2] - F.col("b")[0]).alias("width"))


@query("prediction_summary", """SELECT i.image_id, count(p.pred_id) AS n, coalesce(string_agg(p.pred_id::VARCHAR, ',' ORDER BY pred_id), '') AS ids FROM fx_image i LEFT JOIN fx_pred p ON p.image_id = i.image_id GROUP BY 1""")
def _(t):
    s = writers.prediction_summary(t.fx_image, t.fx_pred.withColumn("class_id", F.col("category_id")))
    return s.select("image_id", F.size("predictions").cast("long").alias("n"), F.array_join(F.transform("predictions", lambda p: p["pred_id"].cast("string")), ",").alias("ids"))


@query("write_manifest", "SELECT count(*) FILTER (split = 'train') AS selected, count(*) AS total FROM fx_image")
def _(t):
    return writers.manifest(t.fx_image.filter("split = 'train'"), t.fx_image)[1]
