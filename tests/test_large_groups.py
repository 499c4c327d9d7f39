"""The ways for bounded and for oversized groups give the same rows as plain loops."""

import os
import random

import pytest
from pyspark.sql import functions as F

import loops
from framelark.operators import evaluate, matching, responses, scale, suppress, tracks
from framelark.sources import readers, writers

SCHEMA = "image_id long, pred_id long, category_id int, confidence double, x1 double, y1 double, x2 double, y2 double"


def table(spark, boxes, image=1):
    return spark.createDataFrame([(image, i, c, s, *b) for i, c, s, b in boxes], SCHEMA)


@pytest.fixture(params=["bounded", "oversized"])
def way(request):
    if request.param == "oversized":
        request.getfixturevalue("tiny_limits")
    return request.param


@pytest.mark.parametrize("t", [0.3, 0.5, 0.7])
def test_nms(spark, way, t):
    boxes = loops.random_boxes(120, 5)
    got = suppress.nms(table(spark, boxes), ["image_id"], t).select("pred_id").collect()
    assert {r[0] for r in got} == loops.nms(boxes, t)


def test_nms_keeps_boxes_without_area_and_ties(spark, way):
    boxes = [(i, 0, 0.5, (0.0, 0.0, 10.0, 10.0)) for i in range(6)] + [(10 + i, 0, 0.5, (3.0, 3.0, 3.0, 9.0)) for i in range(4)]
    got = suppress.nms(table(spark, boxes), ["image_id"], 0.5).select("pred_id").collect()
    assert {r[0] for r in got} == loops.nms(boxes, 0.5) == {0, 10, 11, 12, 13}


def test_matching(spark, way):
    preds, gts = loops.random_boxes(60, 1), loops.random_boxes(50, 2)
    g = table(spark, gts).withColumnRenamed("pred_id", "ann_id")
    got = matching.match_predictions(table(spark, preds), g, min_iou=0.3)
    rows = got.filter("pred_id is not null and ann_id is not null").select("pred_id", "ann_id").collect()
    want = loops.match(preds, gts, 0.3)
    assert {r[0]: r[1] for r in rows} == want
    assert got.filter("outcome = 'fn'").count() == len(gts) - len(want)
    assert got.filter("outcome = 'fp'").count() == len(preds) - len(want)


def test_matching_among_copies(spark, way):
    one, two = (0.0, 0.0, 10.0, 10.0), (1.0, 0.0, 11.0, 10.0)
    preds = [(i, 0, 0.5, one if i % 3 else two) for i in range(40)]
    gts = [(i, 0, 0.5, two if i % 2 else one) for i in range(30)]
    got = matching.match_predictions(table(spark, preds), table(spark, gts).withColumnRenamed("pred_id", "ann_id"))
    rows = got.filter("pred_id is not null and ann_id is not null").select("pred_id", "ann_id").collect()
    assert {r[0]: r[1] for r in rows} == loops.match(preds, gts, 0.5)


def test_exclusive_assignment(spark, way):
    ins, dets = loops.random_boxes(40, 21), loops.random_boxes(40, 22)
    i, d = table(spark, ins).withColumnRenamed("pred_id", "input_id"), table(spark, dets).withColumnRenamed("pred_id", "det_id")
    got = {r["input_id"]: r["det_id"] for r in matching.assign_exclusive(i, d).collect() if r["det_id"] is not None}
    want = {k: v for k, v in loops.match(ins, dets, 0.1 + 1e-12).items()}
    assert got == want


def test_cross_class(spark, way):
    boxes = [(i, c, None if i % 7 == 0 else s, b) for i, c, s, b in loops.random_boxes(90, 3, spread=40)]
    df = table(spark, boxes).select("image_id", F.col("pred_id").alias("id"), F.col("category_id").alias("label"), F.col("confidence").alias("score"), "x1", "y1", "x2", "y2")
    got = suppress.dedup_cross_class(df, min_iou=0.4).select("id", "slot").collect()
    assert {(r[0], r[1]) for r in got} == loops.cross_class(boxes, 0.4)


def test_best_assignment_needs_no_threshold(spark, way):
    ins, dets = loops.random_boxes(20, 8), loops.random_boxes(15, 9)
    i = table(spark, ins).withColumnRenamed("pred_id", "input_id")
    d = table(spark, dets).withColumnRenamed("pred_id", "det_id").withColumn("mask_area", F.lit(1.0))
    got = {r["input_id"]: r["chosen_id"] for r in matching.assign_best(i, d, ["image_id"]).collect()}
    want = {a[0]: min((-loops.iou(a[3], b[3]), b[0]) for b in dets)[1] for a in ins}
    assert got == want


def test_nearest_centers(spark, way):
    a = [(i, float(i * 7 % 31), float(i * 5 % 17)) for i in range(25)]
    b = [(100 + i, float(i * 11 % 29), float(i * 3 % 19)) for i in range(25)]
    mk = lambda rows: spark.createDataFrame([(1, *r) for r in rows], "g int, id long, cx double, cy double")
    got = matching.match_nearest_center(mk(a), mk(b), ["g"], 6.0).collect()
    assert {(r["a_id"], r["b_id"]) for r in got} == loops.nearest_centers(a, b, 6.0)


def test_nearest_centers_among_copies(spark, way):
    """Spots with many members, some just as far from two others."""
    rng = random.Random(5)
    spots = [(0.0, 0.0), (3.0, 0.0), (6.0, 0.0), (6.0, 4.0), (40.0, 1.0), (-0.0, 0.5)]
    a = [(i, *rng.choice(spots)) for i in range(40)]
    b = [(100 + i, *rng.choice(spots[1:])) for i in range(30)]
    mk = lambda rows: spark.createDataFrame([(1, *r) for r in rows], "g int, id long, cx double, cy double")
    got = matching.match_nearest_center(mk(a), mk(b), ["g"], 6.0).collect()
    assert {(r["a_id"], r["b_id"]) for r in got} == loops.nearest_centers(a, b, 6.0)


def test_twenty_thousand_centers_on_one_spot(spark):
    side = lambda n, first, x: spark.range(n).select(F.lit(1).alias("g"), (F.col("id") + first).alias("id"), F.lit(x).alias("cx"), F.lit(5.0).alias("cy"))
    got = matching.match_nearest_center(side(20_000, 0, 5.0), side(15_000, 50_000, 6.0), ["g"], 8.0)
    assert got.filter("b_id - a_id = 50000 and dist = 1").count() == got.count() == 15_000


def same_rows(a, b):
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_precision_and_sweep_do_not_depend_on_the_limit(spark):
    preds, gts = loops.random_boxes(120, 11), loops.random_boxes(100, 12)
    preds += [(500 + i, 1, 0.3 + i % 7 / 10, (10.0, 10.0, 40.0, 40.0)) for i in range(25)]
    gts += [(500 + i, 1, 0.0, (10.0 + i % 2, 10.0, 40.0, 40.0)) for i in range(20)]
    p, g = table(spark, preds), table(spark, gts).withColumnRenamed("pred_id", "ann_id")
    ways = []
    for limit in (1000, 2):
        spark.conf.set("framelark.foldRows", str(limit))
        try:
            ways.append((scale.cut(evaluate.average_precision(p, g)), scale.cut(evaluate.threshold_sweep(p, g, [0.2, 0.5], [0.3, 0.5, 0.75]))))
        finally:
            spark.conf.unset("framelark.foldRows")
    (ap, sweep), (ap_hot, sweep_hot) = ways
    same_rows(ap, ap_hot)
    same_rows(sweep, sweep_hot)


def test_fifty_thousand_copies_of_one_box(spark):
    box = [F.lit(v).alias(c) for c, v in zip(("x1", "y1", "x2", "y2"), (0.0, 0.0, 10.0, 10.0))]
    p = spark.range(50_000).select(F.lit(1).alias("image_id"), F.col("id").alias("pred_id"), F.lit(0).alias("category_id"), (F.col("id") % 10 / 10).alias("confidence"), *box)
    g = spark.range(40_000).select(F.lit(1).alias("image_id"), F.col("id").alias("ann_id"), F.lit(0).alias("category_id"), *box)
    row = evaluate.average_precision(p, g).first()
    assert row["ap50"] == row["ap50_95"] == 1.0
    got = {(r["min_conf"], r["tp"], r["fp"], r["fn"]) for r in evaluate.threshold_sweep(p, g, [0.0, 0.5], [0.5, 0.95]).collect()}
    assert got == {(0.0, 40_000, 10_000, 0), (0.5, 25_000, 0, 15_000)}


def test_running_and_ordinal(spark, way):
    rows = [(i % 2, (i * 37) % 101, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, k int, v double").repartition(5)
    out = scale.running(df, ["g"], ["k"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, before=True)
    for g in (0, 1):
        part = sorted(r for r in rows if r[0] == g)
        part.sort(key=lambda r: r[1])
        got = [(r["k"], r["s"], r["m"]) for r in out.filter(F.col("g") == g).orderBy("k").collect()]
        want = [(r[1], sum(x[2] for x in part[:i]) if i else None, max((x[2] for x in part[:i]), default=None)) for i, r in enumerate(part)]
        assert got == want
    ids = scale.ordinal(df, [], ["k"], "n", start=1).orderBy("k").collect()
    assert [r["n"] for r in ids] == list(range(1, 101))


def test_nearest_both_ways(spark, way):
    marks = spark.createDataFrame([(1, t) for t in (10, 20, 20, 40)], "g int, at int").withColumn("name", F.monotonically_increasing_id())
    rows = spark.createDataFrame([(1, t) for t in (5, 10, 15, 20, 30, 50)], "g int, at int")
    near = scale.nearest(rows, marks, ["g"], "at", ["name"]).orderBy("at").collect()
    assert [(r["prev"] and r["prev"]["at"], r["next"] and r["next"]["at"]) for r in near] == [
        (None, 10), (10, 10), (10, 20), (20, 20), (20, 40), (40, None)]
    strict = scale.nearest(rows, marks, ["g"], "at", ["name"], strict=True).orderBy("at").collect()
    assert [(r["prev"] and r["prev"]["at"], r["next"] and r["next"]["at"]) for r in strict] == [
        (None, 10), (None, 20), (10, 20), (10, 40), (20, 40), (40, None)]


def test_quantiles(spark, way):
    import numpy as np

    vals = [float((i * 53) % 97) / 3 for i in range(50)]
    df = spark.createDataFrame([(1, v) for v in vals], "g int, v double")
    r = scale.exact_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95, "c": 0.15}).first()
    assert [r["a"], r["b"], r["c"]] == pytest.approx(list(np.percentile(vals, [50, 95, 15])))


def test_kalman(spark, way):
    n = 12
    steps = [None if p in (3, 7) else 1.5 + (p % 3) * 0.4 for p in range(1, n + 1)]
    pairs = spark.createDataFrame([(1, 0, n, 5, 6, 10.0, 20.0, 30.0, 30.0, 40.0, 21.0, 30.0, 30.0)],
                                  "v int, a long, b long, a_id long, b_id long, acx double, acy double, aw double, ah double, bcx double, bcy double, bw double, bh double")
    st = spark.createDataFrame([(1, 0, 5, p + 1, s, None if s is None else 0.0) for p, s in enumerate(steps)], "v int, a long, a_id long, p long, dx double, dy double")
    got = tracks.smooth_kalman(pairs, st, ["v"]).orderBy("p").collect()
    want = loops.kalman(10.0, steps, 40.0, n)
    assert [(r["x1"] + r["x2"]) / 2 for r in got] == pytest.approx(want)
    assert got[2]["confidence"] == pytest.approx(round(0.6 * 9 / 11, 3))


def test_composed_motion(spark, way):
    import numpy as np

    ms = [np.array([[1, 0.01 * p, p], [-0.02, 1, 2], [0, 0, 1.0]]) for p in range(1, 8)]
    tr = spark.createDataFrame([(1, p + 1, m.flatten().tolist()) for p, m in enumerate(ms)], "v int, p int, m array<double>")
    an = spark.createDataFrame([(1, 3.0, 4.0)], "v int, cx double, cy double")
    cur, want = np.eye(3), []
    for m in ms:
        cur = m @ cur
        want.append((cur @ np.array([3.0, 4.0, 1.0]))[:2])
    got = tracks.compose_motion(tr, an, ["v"]).orderBy("p").collect()
    assert [(r["cam_x"], r["cam_y"]) for r in got] == [pytest.approx(tuple(w)) for w in want]


@pytest.mark.parametrize("preset", [False, True])
def test_inherited_track_ids(spark, way, preset):
    rows, ann = [], 0
    for frame in range(9):
        for side in ("left", "right"):
            for _ in range((frame * 5 + (side == "left") * 3) % 4):
                ann += 1
                rows.append((side, frame, ann, 50 + ann if preset and ann % 6 == 0 else None))
    df = spark.createDataFrame([("s", *r) for r in rows], "session string, side string, frame_idx long, ann_id long, track_id long")
    got = {r["ann_id"]: r["track_id"] for r in tracks.inherit_track_ids(df).collect()}
    assert got == loops.inherit(rows)


@pytest.mark.parametrize("seed", range(4))
def test_inherited_track_ids_that_clash(spark, seed):
    """Few given ids, repeated within and across frames, so that lanes lose and regain them."""
    rng, rows, ann = random.Random(seed), [], 0
    for frame in range(60):
        for side in ("left", "right"):
            for _ in range(rng.choice([0, 2, 3, 5, 6])):
                ann += 1
                rows.append((side, frame, ann, rng.randrange(1, 5) if rng.random() < 0.15 else None))
    df = spark.createDataFrame([("s", *r) for r in rows], "session string, side string, frame_idx long, ann_id long, track_id long").repartition(5)
    got = {r["ann_id"]: r["track_id"] for r in tracks.inherit_track_ids(df).collect()}
    assert got == loops.inherit(rows)


def test_one_frame_with_most_boxes_keeps_given_ids(spark, tiny_limits):
    rows = [("left", f, 1000 * f + i, i % 50 if f == 1 and i % 3 == 0 else None) for f, n in ((0, 40), (1, 400), (2, 30)) for i in range(n)]
    df = spark.createDataFrame([("s", *r) for r in rows], "session string, side string, frame_idx long, ann_id long, track_id long")
    assert {r["ann_id"]: r["track_id"] for r in tracks.inherit_track_ids(df).collect()} == loops.inherit(rows)


def kalman_input(spark, n, steps):
    """One pair whose steps are `steps` (an expression over p), all on one axis."""
    pairs = spark.createDataFrame([(1, 0, n, 5, 6, 10.0, 20.0, 30.0, 30.0, 40.0, 20.0, 30.0, 30.0)],
                                  "v int, a long, b long, a_id long, b_id long, acx double, acy double, aw double, ah double, bcx double, bcy double, bw double, bh double")
    st = spark.range(1, n + 1).select(F.lit(1).alias("v"), F.lit(0).cast("long").alias("a"), F.lit(5).cast("long").alias("a_id"), F.col("id").alias("p"), F.expr(steps).alias("dx"))
    return pairs, st.withColumn("dy", F.when(F.col("dx").isNotNull(), 0.0))


def test_a_long_session_is_a_scan(spark):
    """Thousands of frames in stretches of 40: as the loop, and no more written tables than for fewer frames."""
    jobs = {}
    for n in (1800, 6000):
        pairs, st = kalman_input(spark, n, "case when id % 7 <> 3 and id % 1000 > 20 then (id % 5) - 1.9 end")
        steps = [None if p % 7 == 3 or p % 1000 <= 20 else (p % 5) - 1.9 for p in range(1, n + 1)]
        spark.conf.set("framelark.foldRows", "80")
        try:
            scale.release(spark)
            got = tracks.smooth_kalman(pairs, st, ["v"]).orderBy("p").collect()
            jobs[n] = len(os.listdir(scale.shared_folder(spark)))
        finally:
            spark.conf.unset("framelark.foldRows")
        want = loops.kalman(10.0, steps, 40.0, n)
        assert max(abs((r["x1"] + r["x2"]) / 2 - w) for r, w in zip(got, want, strict=True)) < 1e-9
    assert jobs[1800] == jobs[6000]


def test_nothing_matches_without_overlap(spark, way):
    box = "x1 double, y1 double, x2 double, y2 double"
    pred = spark.createDataFrame([(1, i, 0, 10.0 * i, 0.0, 10.0 * i + 5, 5.0) for i in range(4)], f"image_id long, pred_id long, category_id int, {box}")
    gt = spark.createDataFrame([(1, i, 0, 10.0 * i, 50.0, 10.0 * i + 5, 55.0) for i in range(4)], f"image_id long, ann_id long, category_id int, {box}")
    got = matching.match_predictions(pred, gt, min_iou=0.0).groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in got} == {"fp": 4, "fn": 4}


def test_response_rows_of_one_image(spark, way):
    item = '{"label": "%s", "bbox_2d": [%d, 0, %d, 100], "score": %s}'
    docs = [(1_700_000_000_000_000_000, 0, "[" + item % ("robot", 0, 100, "0.4") + "]"), (1_700_000_000_000_000_000, 1, "[" + item % ("map", 2, 100, "0.9") + "]")]
    images = spark.createDataFrame([(1_700_000_000_000_000_000, 1000, 1000)], "image_id long, width int, height int")
    got = responses.canonical_boxes(spark.createDataFrame(docs, "image_id long, document int, response string"), images, ["robot", "map"])
    assert [r["label"] for r in got.collect()] == ["map"]


def test_documents_stand_alone(spark):
    rng = random.Random(4)
    images = spark.createDataFrame([(i, f"{i}.png", i) for i in range(300)], "image_id long, file_name string, position long")
    rows = [(k, rng.randrange(300), 0, 0.0, 0.0, 5.0, 5.0) for k in range(600)] + [(900 + k, 7, 0, 0.0, 0.0, 5.0, 5.0) for k in range(120)]
    anns = spark.createDataFrame(rows, "ann_id long, image_id long, category_id int, x1 double, y1 double, x2 double, y2 double")
    docs = writers.coco_documents(images, anns, spark.createDataFrame([(0, "c")], "category_id int, name string"), rows_per_doc=50)
    im, an, _ = readers.coco_tables(docs)
    assert readers.unite_images(im).count() == 300 and docs.count() > 10
    assert an.join(im.select("shard", "image_id"), ["shard", "image_id"]).count() == len(rows)


def test_an_image_with_most_annotations_is_cut_into_documents(spark, tiny_limits):
    images = spark.createDataFrame([(i, f"{i}.png", i) for i in range(40)], "image_id long, file_name string, position long")
    rows = [(k, 7 if k % 3 else k % 40, 0, 0.0, 0.0, 5.0, 5.0) for k in range(900)]
    anns = spark.createDataFrame(rows, "ann_id long, image_id long, category_id int, x1 double, y1 double, x2 double, y2 double")
    seen = images.select("image_id").filter("image_id in (7, 9)")
    docs = writers.coco_documents(images, anns, spark.createDataFrame([(0, "c")], "category_id int, name string"), 50, seen)
    im, an, ca = (scale.cut(d) for d in readers.coco_tables(docs))
    assert an.groupBy("shard").count().agg(F.max("count")).first()[0] <= 100 and ca.count() == docs.count() > 12
    assert sorted(r[0] for r in an.select("ann_id").collect()) == [r[0] for r in rows]
    assert an.join(im.select("shard", "image_id"), ["shard", "image_id"]).count() == len(rows)
    assert readers.unite_images(im).count() == 40
    mark = [r for r in docs.collect() if '"annotated_image_ids":[7' in r["doc"]]
    assert len(mark) == im.filter("image_id = 7").count() > 5


def test_large_documents_are_read_in_parts(spark, tmp_path):
    """Strings with braces and quotes, nested objects, parts in any order, against the reader of whole documents."""
    import json

    rng = random.Random(3)
    odd = ['a}b', '{"images": [', '\\', '"', '\\"}', "é{[", "]}", '"annotations": [{', ""]
    images = [{"id": str(i) if i % 2 else i, "file_name": rng.choice(odd) + f"{i}.png", "width": i, "note": {"images": [{"x": rng.choice(odd)}], "deep": {"a": {"b": 1}}}} for i in range(150)]
    anns = [{"image_id": rng.randrange(150), "id": i, "category_id": 1, "bbox": [1, 2.5, 3, 4], "segmentation": [[1, 2, 3, 4, 5, 6]], "track_id": "7", "source": rng.choice(odd), "categories": [{"q": 1}], "more": rng.choice(odd)} for i in range(400)]
    cats = [{"id": 1, "name": "c}"}, {"name": "d", "id": 2}]
    info = {"images": {"a": [{"b": {}}]}, "annotations": [{"x": 1}, {"y": {"z": []}}], "text": rng.choice(odd)}
    docs = [
        json.dumps({"info": info, "images": images, "annotations": anns, "categories": cats, "licenses": [{"id": 9, "url": {"u": 1}}]}),
        json.dumps({"licenses": [], "categories": cats, "annotations": anns[:50], "extra": {"a": {"b": {"c": 1}}}, "images": images[:3]}, indent=2),
        json.dumps({"annotations": [], "images": [], "categories": []}),
        json.dumps({"images": images[:1], "annotations": [], "info": info, "categories": []}, separators=(",", ":"), ensure_ascii=False),
    ]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(d, encoding="utf-8")
    whole = readers.read_coco(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        # The path and a field of annotations are both called source.
        plain = lambda d: d.toDF(*[f"c{i}" for i in range(len(d.columns))])
        parts = [scale.cut(plain(t)) for t in readers.read_large_coco(spark, str(tmp_path))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for a, b in zip(map(plain, whole), parts):
        text = lambda d: d.select(*[F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c)))).alias(c) if t.startswith("map") else F.col(c) for c, t in d.dtypes])
        assert sorted(map(str, text(a).collect())) == sorted(map(str, text(b).collect()))
    (tmp_path / "bad.json").write_text('{"images": [{"id": 1}], "note": {"annotations": []}, "categories": []}')
    with pytest.raises(ValueError):
        readers.read_large_coco(spark, str(tmp_path))


def test_strings_that_begin_like_lists_hide_no_bracket(spark, tmp_path):
    """A string that starts with a colon and a bracket, after a list that ends, is no key of a list."""
    import json

    anns = [{"id": i, "image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4], "more": [["a"], ":[b", ["c"], ":{d"]} for i in range(3)]
    (tmp_path / "a.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a"}], "annotations": anns, "categories": [{"id": 1, "name": "c"}]}))
    images, anns, cats = readers.read_large_coco(spark, str(tmp_path))
    assert sorted(r[0] for r in anns.select("ann_id").collect()) == [0, 1, 2]
    assert images.count() == 1 and cats.count() == 1


def _metrics_by_parts(pred, gt, classes, min_iou):
    """The table out of the operators it sums up: every prediction and box with its outcome."""
    out = evaluate.match_predictions(pred, gt, ["split", "image_id"], min_iou)
    ap = {(r["split"], r["category_id"]): (r["ap50"], r["ap50_95"]) for r in evaluate.average_precision(pred, gt, ["image_id"], ["split"]).collect()}
    n = {(r["split"], r["category_id"]): r["count"] for r in gt.groupBy("split", "category_id").count().collect()}
    names, rows = dict(classes.collect()), []
    for r in evaluate.per_class_scores(out, ["split"]).collect():
        k = (r["split"], r["class_id"])
        rows.append((r["split"], str(k[1]), names.get(k[1], f"class_{k[1]}"), n.get(k, 0), r["precision"], r["recall"], *ap.get(k, (0.0, 0.0))))
    for r in evaluate.detection_scores(out, ["split"]).collect():
        mine = [v for k, v in ap.items() if k[0] == r["split"]]
        mean = [sum(c) / len(mine) for c in zip(*mine)] or [0.0, 0.0]
        rows.append((r["split"], "all", "all", sum(v for k, v in n.items() if k[0] == r["split"]), r["precision"], r["recall"], *mean))
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)


def test_metrics_read_boxes_once(spark, monkeypatch):
    """Images are scored in their arrays; those beyond the limit by the ways of any size, with the same result."""
    rng = random.Random(42)
    box = lambda: (lambda x, y: (float(x), float(y), x + rng.choice([8.0, 9.0, 10.0]), y + rng.choice([8.0, 9.0])))(rng.randrange(12), rng.randrange(12))
    place = lambda: (rng.choice(["train", "val", None]), rng.choice([None, *range(12)]))
    preds = [(*place(), i, rng.randrange(4), rng.choice([0.2, 0.5, 0.5, 0.9]), *box()) for i in range(400)]
    gts = [(*place(), i, rng.choice([0, 1, 2, 7]), *box()) for i in range(300)]
    preds += [("test", 1, 900, 1, 0.5, 0.0, 0.0, 9.0, 9.0), ("val", 5, 901, 0, None, 0.0, 0.0, 9.0, 9.0)]  # a split without boxes
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    kinds = "category_id int, confidence double, x1 double, y1 double, x2 double, y2 double"
    pred = spark.createDataFrame(preds, f"split string, image_id long, pred_id long, {kinds}")
    gt = spark.createDataFrame(gts, f"split string, image_id long, ann_id long, {kinds.replace(' confidence double,', '')}")
    classes = spark.createDataFrame([(0, "zero"), (1, "one")], "class_id int, name string")
    for min_iou in (0.5, 0.3, 0.0):
        got = evaluate.metrics_table(pred.mapInArrow(counted, pred.schema), gt.mapInArrow(counted, gt.schema), classes, min_iou).filter("split is not null")
        key = lambda d: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in d.select("split", "class_id", "class_name", "instances", "precision", "recall", "ap50", "ap50_95").collect())
        want = [r for r in _metrics_by_parts(pred, gt, classes, min_iou) if not r.startswith("[None")]
        assert key(got) == want
        assert len(want) > 9
    seen.value = 0
    key(evaluate.metrics_table(pred.mapInArrow(counted, pred.schema), gt.mapInArrow(counted, gt.schema), classes))
    assert seen.value == len(preds) + len(gts)
    monkeypatch.setattr(evaluate, "ARRAY_ROWS", 12)  # some images go beyond it
    assert key(evaluate.metrics_table(pred, gt, classes).filter("split is not null")) == [r for r in _metrics_by_parts(pred, gt, classes, 0.5) if not r.startswith("[None")]


def test_text_of_documents_moves_nowhere(spark, tmp_path):
    """Elements come out of the task that reads them; keys of parts deeper down or at the end of a string are no parts."""
    import json

    anns = [{"id": i, "image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4], "source": "}{" * (i % 3), "m": {"images": [{"id": 5}]}} for i in range(40)]
    doc = {"info": {"images": [{"x": 1}], "annotations": [{"id": 8}]}, "images": [{"id": 1, "file_name": "a"}, {"id": 2, "file_name": "b}"}],
           "a}annotations": [{"id": 9}], "annotations": anns, "licenses": [{"id": 3}] * 9, "categories": [{"id": 1, "name": "c"}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text(json.dumps(doc, indent=1))
    ids = lambda tables: [sorted(map(tuple, t.select("pos", k).collect())) for t, k in zip(tables, ("image_id", "ann_id", "category_id"))]
    whole = readers.read_large_coco(spark, str(tmp_path))
    assert ids(whole) == ids(readers.read_coco(spark, str(tmp_path))) and len(ids(whole)[1]) == 80
    assert "Exchange" not in whole[1]._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("600", "2500"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            cuts = [scale.cut(t.select("pos", k)) for t, k in zip(readers.read_large_coco(spark, str(tmp_path)), ("image_id", "ann_id", "category_id"))]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert ids(cuts) == ids(whole)


def test_ranks_by_counting(spark):
    vals = [0.0] * 500 + [1e9, 1e9 + 1] + [i / 7 for i in range(300)] + [-5.0] * 3
    df = spark.createDataFrame([(1, v) for v in vals] + [(2, 4.0)] * 9, "g int, v double")
    n = df.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    wanted = n.select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(8).cast("long"))).alias("_pos"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"))
    got = {(r["g"], r["_pos"]): r["v"] for r in scale.values_at(df, ["g"], "v", wanted).collect()}
    want = {1: sorted(vals), 2: [4.0] * 9}
    assert got == {(g, p): vs[p] for g, vs in want.items() for p in range(0, len(vs), 8)}


def test_label_files(spark, tmp_path):
    rows = [("train", "a", 2, "0 b"), ("train", "a", 1, "0 a"), ("val", "empty", None, None), ("val", "c", 5, "1 c")]
    files = writers.write_label_files(spark.createDataFrame(rows, "split string, stem string, ann_id long, line string"), str(tmp_path))
    assert sorted(tuple(r) for r in files.collect()) == [("train", "a", 2), ("val", "c", 1), ("val", "empty", 0)]
    assert {r["stem"]: r["body"] for r in readers.read_label_files(files, str(tmp_path)).collect()} == {"a": "0 a\n0 b\n", "empty": "", "c": "1 c\n"}


def test_tables_are_deleted(spark):
    folder = scale.shared_folder(spark)
    scale.cut(spark.range(3)).count()
    assert os.listdir(folder)
    scale.release(spark)
    assert not os.path.exists(folder) and scale.cut(spark.range(3)).count() == 3


def test_box_under_another_key(spark):
    docs = spark.createDataFrame([(1, '[{"label": "robot", "rect": [100, 200, 300, 400]}]')], "image_id long, response string")
    images = spark.createDataFrame([(1, 1000, 1000)], "image_id long, width int, height int")
    row = responses.canonical_boxes(docs, images, ["robot"], field="rect").first()
    assert (row["x1"], row["y1"], row["x2"], row["y2"]) == (100, 200, 300, 400)


def test_image_sizes(spark, tmp_path):
    import struct

    heads = {
        "a.png": b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 640, 480),
        "b.jpg": b"\xff\xd8\xff\xe0\0\x10" + b"\0" * 14 + b"\xff\xc0\0\x11\x08" + struct.pack(">HH", 48, 64) + b"\0" * 9,
        "c.bmp": b"BM" + b"\0" * 16 + struct.pack("<ii", 7, -5),
        "d.webp": b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"),
        "e.png": b"broken",
    }
    for name, head in heads.items():
        (tmp_path / name).write_bytes(head)
    got = readers.with_image_size(readers.list_images(spark, str(tmp_path)))
    assert {r["file_name"]: (r["width"], r["height"]) for r in got.collect()} == {
        "a.png": (640, 480), "b.jpg": (64, 48), "c.bmp": (7, 5), "d.webp": (100, 50), "e.png": (None, None)}


def test_labels_by_split(spark, tmp_path):
    for folder, name, text in (("train/labels", "a", "0 1\n"), ("valid/labels", "a", "1 2\n\n1 3\n"), ("labels", "z", "9 9\n")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / f"{name}.txt").write_text(text)
    got = readers.read_split_labels(spark, str(tmp_path)).collect()
    assert sorted((r["split"], r["stem"], r["line_num"]) for r in got) == [("train", "a", 1), ("val", "a", 1), ("val", "a", 3)]
