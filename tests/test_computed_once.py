"""Costly parts of a row are computed once, and shared tables are written once: read off the plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.operators import convert, quality, responses, scale, suppress
from framelark.plans.fixtures import Tables
from framelark.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([("a", 1, "0 0.5 0.5 0.1 0.1"), ("a", 2, "x 0.5"), ("a", 3, "1 2 0.5 0.1 0.1")], "stem string, line_num int, line string")


def test_label_lines_are_split_once(lines):
    checked = quality.label_messages(quality.check_label_lines(lines))
    assert plan(checked).count("split(") == 1
    assert sorted((r.line_num, r.code) for r in checked.collect()) == [(2, "tokens"), (3, "center")]
    assert plan(convert.parse_labels(lines)).count("split(") == 1


def test_lines_of_statistics_are_split_once(spark, lines):
    split = lines.withColumn("split", F.lit("train"))
    files = split.select("split", "stem").distinct()
    names = spark.createDataFrame([(0, "n")], "class_id int, name string")
    one = quality.dataset_statistics(split, files, names)
    # Two branches read the lines.
    assert plan(one).count("split(") <= 3
    assert one.filter("class = 'n'").first()["instances"] == 1


def test_responses_are_parsed_once(spark):
    df = spark.createDataFrame([(1, '```json\n[{"label": "robot", "bbox": [1, 2, 3, 4]}]\n```')], "image_id long, response string")
    items = responses.explode_detections(responses.parse_responses(df), ["image_id"])
    assert plan(items).count("from_json") == 1
    kept, dropped = responses.canonicalize_labels(items, ["robot", "map"])
    assert kept.count() == 1 and dropped.count() == 0


def test_predictions_are_parsed_once_by_shape(spark):
    df = spark.createDataFrame([(1, '{"results": [{"image_id": "7", "bbox": [1, 2, 3, 4]}]}'), (2, '[{"image_id": "8", "bbox": [1, 2, 3, 4]}]')], "n int, doc string")
    got = readers.predictions(df)
    assert sorted(r.image_id for r in got.collect()) == ["7", "8"]
    assert got._jdf.queryExecution().analyzed().toString().count("from_json") == 2


def test_boxes_are_written_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    assert "Window" not in plan(t.fx_pred) and "Window" not in plan(t.fx_label_line)


def test_lines_and_polygons_in_steps(spark):
    one = spark.createDataFrame([(1, 1, "0", 1.0, 2.0, 3.0, 4.0)], "image_id int, ann_id int, class_id string, x1 double, y1 double, x2 double, y2 double")
    images = spark.createDataFrame([(1, "a", "train", 10, 10)], "image_id int, stem string, split string, width int, height int")
    drawn = writers.yolo_lines(one, images)
    assert drawn.first()["line"] == "0 0.200000 0.300000 0.200000 0.200000"
    assert plan(drawn).count("134217729") <= 2
    polys = F.array(F.array(*[F.lit(v) for v in (0.0, 0.0, 1.0, 0.0, 1.0, 1.0)]), F.array(*[F.lit(v) for v in (0.0, 0.0, 9.0, 0.0, 9.0, 9.0)]))
    assert one.select(geo.filter_polygons(polys, 100.0).alias("p")).first()["p"] == [[0.0, 0.0, 9.0, 0.0, 9.0, 9.0]]
    boxes = spark.createDataFrame([("# no\n[a, 1, 2, 3, 4]\n[b,1,x,3,4]\nc,1\n",)], "r string").select(text.bbox_lines(F.col("r")).alias("b"))
    assert [(b["class"], b["bbox"]) for b in boxes.first()["b"]] == [("a", [1.0, 2.0, 3.0, 4.0])]
    assert plan(boxes).count("translate(") == 1


def test_numbering_without_a_group_moves_rows_once(spark):
    """Rows are dealt by ranges to be sorted and not dealt again by slice."""
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    out = scale.ordinal(rows, [], [F.col("k").desc()], "n", start=1)
    assert out.columns == ["k", "v", "n"]
    assert all(r.k + r.n == 5000 for r in out.collect())
    rows_side, *summary = out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")
    assert summary and "Exchange" not in rows_side  # the rows stay, the summary comes to them
    assert scale.ordinal(rows.filter("false"), [], ["k"], "n").count() == 0


def test_records_carry_a_mask_once(spark):
    """Of the first record and of the donor, only the donor's struct has the polygon; masks end where they did."""
    ring = lambda v: [[float(v)] * 6]
    anns = spark.createDataFrame(
        [(1, 1, 0, 0.0, 0.0, 9.0, 9.0, None, None), (2, 1, 0, 0.0, 0.0, 9.0, 9.0, None, ring(2)), (3, 1, 0, 0.0, 0.0, 9.0, 9.0, None, ring(3)),
         (4, 1, 0, 50.0, 0.0, 9.0, 9.0, None, ring(4)), (5, 1, 0, 50.0, 0.0, 9.0, 9.0, None, ring(5)), (6, 1, 0, 90.0, 0.0, 9.0, 9.0, None, None)],
        "ann_id long, image_id long, category_id int, x double, y double, w double, h double, track_text string, segmentation array<array<double>>")
    images = spark.createDataFrame([(1, "a.jpg", "left")], "image_id long, file_name string, side string")
    cats = spark.createDataFrame([(0, "c")], "category_id int, name string")
    live = anns.filter("false").drop("track_text").withColumn("track_id", F.lit(1).cast("long"))
    merged, _, _ = suppress.import_records(anns, images, cats, live, images, cats)
    assert sorted((r.x, r.segmentation, r.donor) for r in merged.collect()) == [(0.0, ring(2), 2), (50.0, ring(4), None), (90.0, None, None)]
    assert re.search(r"don#\d+\.mask", plan(merged)) and not re.search(r"rec#\d+\.mask", plan(merged))


def test_insertion_moves_an_image_once(spark):
    """Arrays by image decide as joins by class do; the rows of an image meet in one shuffle."""
    rng = random.Random(16)
    box = lambda: (float(rng.randrange(40)), float(rng.randrange(30)), float(rng.randrange(41, 70)), float(rng.randrange(31, 60)))
    image = lambda: rng.choice([None, *range(40)])
    rows = [(image(), i, rng.choice([None, 0, 0, 1]), rng.choice([None, rng.random()]), *(box() if rng.random() < 0.9 else (1.0, 1.0, 2.0, 9.0))) for i in range(900)]
    rows += [(99, 1000 + i, 0, rng.random(), *box()) for i in range(150)]  # more than an array takes
    dets = spark.createDataFrame(rows, "image_id long, det_id long, category_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    live = spark.createDataFrame([(image(), rng.randrange(2), *box()) for _ in range(120)], "image_id long, category_id int, x1 double, y1 double, x2 double, y2 double")
    images = spark.createDataFrame([(i, 60, 50) for i in range(30)] + [(30, None, None)], "image_id long, width int, height int")
    key = lambda df: sorted(map(repr, df.collect()))
    want = suppress._insert_by_class(dets, live, images, 0.4, 0.5)
    got = suppress.insert_detections(dets, live, images, 0.4, 0.5)
    assert got.columns == want.columns and key(got) == key(want)
    assert {r.status for r in got.select("status").distinct().collect()} == {"no_category", "suppressed", "too_small", "added", "duplicate"}
    small = dets.filter("image_id < 40")
    moved = suppress.insert_detections(small, live.filter("image_id < 40"), images)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", moved)) == 1


def test_import_moves_what_is_numbered_only(spark):
    """A record stays where it is written: the merge by box carries its number, mask flag and track. Counters over slices go on."""
    rng = random.Random(24)
    rows = [(i, i % 5, 0, float(rng.randrange(60)), 0.0, 9.0, 9.0, rng.choice([None, None, "x", str(rng.randrange(400))]), rng.random() < 0.5) for i in rng.sample(range(10_000), 300)]
    anns = spark.createDataFrame(rows, "ann_id long, image_id long, category_id int, x double, y double, w double, h double, track_text string, has_mask boolean").repartition(7)
    images = spark.createDataFrame([(i, f"{i}.jpg", "left") for i in range(4)], "image_id long, file_name string, side string")
    cats = spark.createDataFrame([(0, "c")], "category_id int, name string")
    live = spark.createDataFrame([(7, 1, 0, 3.0, 0.0, 9.0, 9.0, 20, False)], "ann_id long, image_id long, category_id int, x double, y double, w double, h double, track_id long, has_mask boolean")
    merged, _ = suppress.import_annotations(anns, images, cats, live, images, cats)
    want, boxes, at = [], {(1, 3.0): None}, 21
    for r in sorted(rows):
        if r[1] < 4 and (r[1], r[3]) not in boxes:
            own = int(r[7]) if r[7] and r[7] != "x" else None
            boxes[r[1], r[3]] = [7 + len(boxes), r[1], r[3], at if own is None else own, r[8]]
            at = at + 1 if own is None else max(at, own + 1)
        elif r[1] < 4 and r[8] and boxes[r[1], r[3]]:
            boxes[r[1], r[3]][4] = True
    want = sorted(tuple(b) for b in boxes.values() if b)
    got = merged.filter("origin = 'imported'")
    assert sorted((r.ann_id, r.image_id, r.x, r.track_id, r.has_mask) for r in got.collect()) == want
    assert not re.search(r"rec#\d+\.x", plan(merged.select("ann_id", "x")))
