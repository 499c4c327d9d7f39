"""Small cases with known results."""

import pytest
from pyspark.sql import functions as F

import loops
from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.operators import convert, datasets, frames, quality, responses, stats, suppress
from framelark.sources import readers, writers


def test_python_rounding_of_decimal_text(spark):
    vals = [0.4453125, 57 / 640, 0.0203125, 1 / 3, 0.1234565, 2.5e-7, 0.9999995, 1.0, 0.0, -0.0890625, 123.4567895]
    rows = spark.createDataFrame([(v,) for v in vals], "v double").select("v", geo.fixed(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in rows] == [f"{v:.6f}" for v in vals]
    assert spark.createDataFrame([(vals,)], "v array<double>").select(geo.fixed_all(F.col("v"))).first()[0] == [f"{v:.6f}" for v in vals]


def test_insert_detections(spark):
    dets = spark.createDataFrame([
        (1, 1, 1, 0.9, 10.0, 10.0, 40.0, 30.0), (1, 2, 1, 0.8, 50.0, 20.0, 90.0, 60.0),
        (1, 3, None, 0.7, 0.0, 0.0, 9.0, 9.0), (1, 4, 1, 0.6, 70.0, 10.0, 71.0, 30.0)],
        "image_id long, det_id long, category_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    none = dets.limit(0).select("image_id", "category_id", "x1", "y1", "x2", "y2")
    images = spark.createDataFrame([(1, 100, 80)], "image_id long, width int, height int")
    got = {r["det_id"]: r["status"] for r in suppress.insert_detections(dets, none, images).collect()}
    assert got == {1: "added", 2: "added", 3: "no_category", 4: "too_small"}
    again = spark.createDataFrame([(1, 9, 1, 0.9, 11.0, 11.0, 41.0, 31.0)], dets.schema)
    live = dets.filter("det_id = 1").select("image_id", "category_id", "x1", "y1", "x2", "y2")
    assert suppress.insert_detections(again, live, images).first()["status"] == "duplicate"


@pytest.mark.parametrize("same, t, want", [(True, 0.5, 1), (False, 0.5, 2), (True, 1.0, 2)])
def test_nms_pair(spark, same, t, want):
    rows = [(1, 1, 1, 0.9, 55.0, 5.0, 95.0, 25.0), (1, 2, 1 if same else 2, 0.6, 56.0, 6.0, 96.0, 26.0)]
    df = spark.createDataFrame(rows, "image_id long, pred_id long, category_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    assert suppress.nms(df, ["image_id", "category_id"], t).count() == want


def test_combine(spark):
    images = spark.createDataFrame([(0, 0, 7, "a.png", "left", 1000), (0, 1, 8, "b.png", "left", 2000), (1, 0, 1, "c.png", "left", 3000)],
                                   "part int, pos int, image_id long, file_name string, side string, timestamp_ns long")
    anns = spark.createDataFrame([(0, 0, 5, 7, 3), (1, 0, 1, 1, 0), (1, 1, 2, 1, 1), (1, 2, 3, 99, 1)], "part int, pos int, ann_id long, image_id long, category_id int")
    cats = spark.createDataFrame([(0, 0, 3, "box"), (1, 0, 0, "box"), (1, 1, 1, "lid")], "part int, pos int, category_id int, name string")
    im, an, ca, dropped = datasets.combine_datasets(images, anns, cats)
    assert sorted(r["image_id"] for r in im.collect()) == [1, 2, 3]
    assert [(r["ann_id"], r["category_id"]) for r in an.orderBy("ann_id").collect()] == [(1, 0), (2, 0), (3, 1)]
    assert {r["name"]: r["category_id"] for r in ca.collect()} == {"box": 0, "lid": 1}
    assert [(r["part"], r["dropped"]) for r in dropped.collect()] == [(1, 1)]
    assert sorted(r[0] for r in datasets.annotated_timestamps(im, an).collect()) == [1000, 3000]
    with pytest.raises(ValueError):
        datasets.combine_datasets(images.union(images), anns, cats)
    with pytest.raises(ValueError):
        datasets.merge_stereo(images.drop("part"), anns.drop("part").withColumn("side", F.lit("left")), cats.drop("part").withColumn("side", F.lit("left")))


def test_stereo_pairs(spark):
    mk = lambda ts: spark.createDataFrame([(t, f"{t}.jpg") for t in ts], "timestamp_ns long, file_name string")
    left, right = mk([100, 200, 300, 400]), mk([200, 300, 400, 500])
    got = frames.pair_stereo(left, right).orderBy("timestamp_ns").collect()
    assert [(r["timestamp_ns"], r["pair_idx"]) for r in got] == [(200, 0), (300, 1), (400, 2)]
    assert tuple(frames.stereo_counts(left, right).first()) == (3, 1, 1)


def test_poses(spark):
    base = 1785987148689014000
    nan = float("nan")
    poses = spark.createDataFrame([
        (101, "1.jpg", base, 1.0, 2.0, 3.0, 0.0, 0.0, 0.0), (102, "2.jpg", base + 100_000_000, 4.0, 5.0, 6.0, 0.0, 0.0, 0.0),
        (103, "3.jpg", base + 200_000_000, nan, nan, nan, 7.0, 8.0, 9.0)],
        "pose_id long, filename string, timestamp_ns long, cam_x double, cam_y double, cam_z double, lidar_x double, lidar_y double, lidar_z double")
    q = spark.createDataFrame([("3.jpg", base), ("x.jpg", base + 90_000_000), ("y.jpg", base + 20_000_000_000), ("102.png", 0), ("z.jpg", base + 50_000_000)],
                              "file_name string, timestamp_ns long")
    got = {r["file_name"]: r for r in frames.pose_lookup(q, poses).collect()}
    assert got["3.jpg"]["matched_by"] == "filename" and tuple(got["3.jpg"]["pos"]) == (7.0, 8.0, 9.0)
    assert got["x.jpg"]["pose_id"] == 102 and got["y.jpg"]["pose_id"] is None
    assert got["102.png"]["matched_by"] == "filename_id" and got["z.jpg"]["pose_id"] == 101
    with pytest.raises(ValueError):
        readers.read_pose_table(poses.filter("pose_id = 103"))


def test_ground_plane(spark):
    import math
    import random

    r = random.Random(4)
    slope = math.tan(math.radians(15))
    pts = [("tilted", x, y, slope * x + r.uniform(-0.05, 0.05)) for x, y in [(r.uniform(-3, 3), r.uniform(-3, 3)) for _ in range(3000)]]
    pts += [("flat", x, y, r.uniform(-0.05, 0.05)) for x, y in [(r.uniform(-5, 5), r.uniform(-5, 5)) for _ in range(2000)]] + [("few", 0.0, 0.0, float(i)) for i in range(20)]
    got = {g["cloud"]: g for g in stats.ground_plane_fit(spark.createDataFrame(pts, "cloud string, x double, y double, z double")).collect()}
    assert set(got) == {"tilted", "flat"}
    for cloud in got:
        tilt, inliers = loops.ground_tilt([p[1:] for p in pts if p[0] == cloud])
        assert got[cloud]["tilt"] == pytest.approx(tilt, abs=1e-4) and got[cloud]["inliers"] == inliers
        assert got[cloud]["level"] == (tilt < 1)


def test_flips_and_rotation(spark):
    lines = spark.createDataFrame([("a", 1, "0 0.25 0.5 0.1 0.2"), ("a", 2, "1 0.125 0.125 0.375 0.125 0.375 0.375"), ("a", 3, "2 0.5 0.5 0.2 0.4")], "stem string, line_num int, line string")
    lab = convert.parse_labels(lines)
    h = {r["line_num"]: r["coords"] for r in convert.flip_labels(lab, "h").collect()}
    assert h[1] == pytest.approx([0.75, 0.5, 0.1, 0.2]) and h[2][0] == pytest.approx(1 - 8 / 64)
    rot = convert.rotate_labels(lab.withColumns({"width": F.lit(100), "height": F.lit(100), "angle": F.lit(90.0)}))
    got = {r["line_num"]: r["coords"] for r in rot.collect()}
    assert got[3] == pytest.approx([0.5, 0.5, 0.4, 0.2])
    assert got[1] == pytest.approx([0.5, 0.75, 0.2, 0.1])


def test_label_report(spark):
    lines = spark.createDataFrame([("a", 1, "0 0.5 0.5 0.2 0.2"), ("a", 2, "0 500 500 0.2 0.2"), ("b", 1, "0 nan 0.5 0.1 0.1"), ("c", 1, "9 0.5 0.5 0.0001 0.1"), ("d", 1, "1.0 0.5 0.5 0.1 0.1"), ("e", 1, "1d 1_0 1 1 1")],
                                  "stem string, line_num int, line string")
    rep = {r["stem"]: (r["valid"], r["objects"], r["warnings"]) for r in quality.label_file_report(quality.check_label_lines(lines, 5)).collect()}
    assert rep == {"a": (False, 1, 0), "b": (False, 0, 0), "c": (True, 1, 2), "d": (False, 0, 0), "e": (False, 0, 0)}
    fixed = quality.check_label_lines(lines, fix=True).filter("stem = 'a' and line_num = 2").first()
    assert fixed["fixed_line"] == "0 0.500000 0.500000 0.200000 0.200000"
    v = quality.check_seg_lines(lines, spark.createDataFrame([("a", True), ("z", False)], "stem string, has_file boolean"), 5)
    with pytest.raises(ValueError):
        quality.require_valid(v)


def test_statistics(spark):
    lines = spark.createDataFrame([("train", "1", "0 .1 .1 .1 .1"), ("train", "1", "1 .1 .1 .2 .2 .3 .3"), ("train", "2", "1 .1 .1 .1 .1")], "split string, stem string, line string")
    files = spark.createDataFrame([("train", s) for s in "123"], "split string, stem string")
    names = spark.createDataFrame([(0, "cat"), (1, "dog")], "class_id int, name string")
    got = {r["class"]: r for r in quality.dataset_statistics(lines, files, names).collect()}
    assert (got["all"]["files"], got["all"]["images"], got["all"]["background"], got["all"]["instances"]) == (3, 2, 1, 3)
    assert got["dog"]["instances_pct"] == pytest.approx(66.67, abs=0.01)


def test_range_checks(spark):
    f = spark.range(10).select(F.col("id").alias("frame_idx"))
    with pytest.raises(ValueError):
        frames.split_ranges(f, [("a", 0, 4), ("b", 4, 8)], 10)
    with pytest.raises(ValueError):
        frames.split_ranges(f, [("a", 0, 10)], 10)
    with pytest.raises(ValueError):
        stats.sample_n(f, "frame_idx", 11)
    assert stats.sample_n(f, "frame_idx", 11, strict=False).count() == 10
    parts = frames.divide_evenly(f, 3).groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in parts] == [4, 3, 3]


def test_repeated_import_is_a_no_op(spark):
    im = spark.createDataFrame([(1, "a.png", "left")], "image_id long, file_name string, side string")
    cats = spark.createDataFrame([(1, "object")], "category_id int, name string")
    anns = spark.createDataFrame([(1, 1, 1, 8.0, 8.0, 16.0, 16.0, "41", True), (2, 1, 9, 1.0, 1.0, 2.0, 2.0, None, False)],
                                 "ann_id long, image_id long, category_id int, x double, y double, w double, h double, track_text string, has_mask boolean")
    live = spark.createDataFrame([], "ann_id long, image_id long, category_id int, x double, y double, w double, h double, track_id long, has_mask boolean")
    after, fates = suppress.import_annotations(anns, im, cats, live, im, cats)
    assert {r["ann_id"]: r["fate"] for r in fates.collect()} == {1: "imported", 2: "dangling"}
    assert after.first()["track_id"] == 41
    again, fates = suppress.import_annotations(anns, im, cats, after.drop("origin"), im, cats)
    assert again.count() == 1 and {r["fate"] for r in fates.collect()} == {"duplicate", "dangling"}


def test_masks_are_given_to_boxes_without(spark):
    schema = "ann_id long, image_id long, category_id int, x double, y double, w double, h double"
    im = spark.createDataFrame([(10, "in/a.png", None), (11, "in/b.png", "right"), (12, "zzz.png", None)], "image_id long, file_name string, side string")
    live_im = spark.createDataFrame([(1, "a.png", "left", 0), (2, "a.png", "right", 0), (3, "b.png", "left", 4)], "image_id long, file_name string, side string, frame_idx long")
    cats = spark.createDataFrame([(7, "known"), (8, "0"), (9, "new")], "category_id int, name string")
    live_cats = spark.createDataFrame([(0, "zero"), (4, "known")], "category_id int, name string")
    poly = lambda v: [[float(v)] * 6]
    rows = [
        (1, 10, 7, 1.0, 1.0, 4.0, 4.0, "41", None, None, None, "p"),  # repeats a live box, no mask to give
        (2, 10, 7, 1.01, 1.0, 4.0, 4.0, "x", poly(2), 9.0, 1, "q"),  # the first that gives
        (3, 10, 7, 1.0, 1.0, 4.0, 4.0, None, poly(3), None, None, "r"),
        (4, 10, 8, 1.0, 1.0, 4.0, 4.0, None, None, None, None, "s"),  # category by number: new there
        (5, 10, 8, 1.0, 1.0, 4.0, 4.0, "77", poly(5), 3.0, None, "t"),  # gives to the one before
        (6, 11, 9, 2.0, 2.0, 5.0, 5.0, "90", poly(6), 20.0, 1, "u"),  # other side is known by name only
        (7, 12, 7, 0.0, 0.0, 1.0, 1.0, None, None, None, None, "v"),
        (8, 11, 99, 0.0, 0.0, 1.0, 1.0, None, None, None, None, "w"),
    ]
    anns = spark.createDataFrame(rows, f"{schema}, track_text string, segmentation array<array<double>>, area double, iscrowd int, note string")
    live = spark.createDataFrame([(100, 1, 4, 1.0, 1.0, 4.0, 4.0, 5, None, "old")], f"{schema}, track_id long, segmentation array<array<double>>, note string")
    merged, fates, counts = suppress.import_records(anns, im, cats, live, live_im, live_cats, ["note"])
    got = {r["ann_id"]: (r["image_id"], r["category_id"], r["area"], r["iscrowd"], r["track_id"], r["segmentation"], r["donor"], r["note"]) for r in merged.collect()}
    assert got == {100: (1, 4, 16.0, 0, 5, poly(2), 2, "old"), 101: (1, 0, 16.0, 0, 6, poly(5), 5, "s"), 102: (3, 5, 20.0, 1, 90, poly(6), None, "u")}
    assert {r["ann_id"]: (r["fate"], r["donates"]) for r in fates.collect()} == {
        1: ("duplicate", False), 2: ("duplicate", True), 3: ("duplicate", False), 4: ("imported", False), 5: ("duplicate", True), 6: ("imported", False), 7: ("foreign", False), 8: ("dangling", False)}
    assert tuple(counts.first()) == (2, 2, 5, 2)
    again, fates, counts = suppress.import_records(anns, im, cats, merged.drop("donor", "origin"), live_im, live_cats.union(spark.createDataFrame([(5, "new")], live_cats.schema)), ["note"])
    assert again.count() == 3 and tuple(counts.first()) == (0, 0, 7, 0)


def test_files_round_trip(spark, tmp_path):
    base = str(tmp_path)
    images = spark.createDataFrame([(1, "a.png", 64, 48, 0), (2, "b.png", 64, 48, 1)], "image_id long, file_name string, width int, height int, position long")
    anns = spark.createDataFrame([(1, 1, 1, 8.0, 8.0, 24.0, 24.0)], "ann_id long, image_id long, category_id int, x1 double, y1 double, x2 double, y2 double")
    cats = spark.createDataFrame([(1, "object")], "category_id int, name string")
    writers.write_coco(writers.coco_documents(images, anns, cats), f"{base}/coco")
    im, an, ca = readers.read_coco(spark, f"{base}/coco")
    assert im.count() == 2 and ca.count() == 1 and tuple(an.select("x1", "y1", "x2", "y2").first()) == (8.0, 8.0, 24.0, 24.0)
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_text("0 0.5 0.5 0.1 0.1\n\n1 0.2 0.2 0.1 0.1\n")
    (tmp_path / "labels" / "b.txt").write_text("")
    got = readers.read_label_lines(spark, f"{base}/labels").orderBy("line_num").collect()
    assert [(r["stem"], r["line_num"]) for r in got] == [("a", 1), ("a", 3)]
    (tmp_path / "classes.txt").write_text("cat\ndog\n")
    (tmp_path / "data.yaml").write_text("path: .\nnames:\n  0: cat\n  1: 'dog'\nnc: 2\n")
    (tmp_path / "flow.yaml").write_text("names: [cat, \"dog\"]\n")
    for f in ("classes.txt", "data.yaml", "flow.yaml"):
        assert {r["class_id"]: r["name"] for r in readers.read_class_names(spark, f"{base}/{f}").collect()} == {0: "cat", 1: "dog"}, f
    (tmp_path / "odd.json").write_text('{"images": [{"id": "7", "file_name": "q.png", "weather": "rain"}], "annotations": [], "categories": []}')
    odd = readers.read_coco(spark, f"{base}/odd.json")[0].first()
    assert odd["image_id"] == 7 and odd["side"] == "left" and odd["extra"] == {"weather": "rain"}
    (tmp_path / "bad.json").write_text('{"images": []}')
    with pytest.raises(ValueError):
        readers.read_coco(spark, f"{base}/bad.json")
    (tmp_path / "res").mkdir()
    (tmp_path / "res" / "a_result.json").write_text('{"image": "a.jpg",\n "parsed_output": [{"label": "x"}]}')
    (tmp_path / "res" / "b_result.json").write_text("{broken")
    good, bad = readers.read_vlm_results(spark, f"{base}/res")
    assert good.first()["image"] == "a.jpg" and [r[0] for r in bad.collect()] == ["b_result.json"]
    (tmp_path / "tree" / "im1").mkdir(parents=True)
    (tmp_path / "tree" / "im1" / "cat.json").write_text('{"class_name": "cat", "image": "im1.jpg", "bboxes": [[1, 2, 30, 40], [9, 9, 3, 3]]}')
    dims = spark.createDataFrame([("im1", 20, 20)], "image string, width int, height int")
    rows = readers.read_per_class_annotations(spark, f"{base}/tree", dims).collect()
    assert [(r["class_name"], r["x2"], r["y2"]) for r in rows] == [("cat", 20.0, 20.0)]
    (tmp_path / "pics").mkdir()
    (tmp_path / "pics" / "a.PNG").write_bytes(b"x")
    (tmp_path / "pics" / "note.txt").write_text("x")
    assert [r["stem"] for r in readers.list_images(spark, f"{base}/pics").collect()] == ["a"]


def test_label_matching(spark):
    df = spark.createDataFrame([("Ceiling_light", "ceiling light"), (None, "x"), (" ", "x"), ("a map on the wall", "map"), ("robot", "exit sign")], "a string, b string")
    got = [r[0] for r in df.select(text.label_matches(F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, True, True, False]


def test_box_order(spark):
    df = spark.sql("SELECT from_json('[{\"label\": \"a\", \"box_2d\": [1, 2, 3, 4]}]', 'array<struct<label:string,bbox_2d:array<double>,box_2d:array<double>,bbox:array<double>,score:double>>')[0] AS d")
    assert df.select(responses.normalize_box_order(F.col("d"), "yxyx")).first()[0] == [2, 1, 4, 3]
    assert df.select(responses.normalize_box_order(F.col("d"), "xyxy")).first()[0] == [1, 2, 3, 4]
