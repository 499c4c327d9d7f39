"""Row-level geometry and text on the derived tables."""

from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.plans.evaluation import iou_sql
from framelark.plans.registry import query, r6


def text6(arr):
    """Array of doubles as text with 6 places, to compare element by element."""
    return F.array_join(geo.fixed_all(arr), ",")


def sql6(arr):
    return f"array_to_string(list_transform({arr}, lambda v: printf('%.6f', v)), ',')"


POLY = "[x1, y1, x2, y1, x2, y2, (x1 + x2) / 2, y2 + 7.5::DOUBLE, x1, y2]"


def poly():
    x1, y1, x2, y2 = geo.box()
    return F.array(x1, y1, x2, y1, x2, y2, (x1 + x2) / 2, y2 + 7.5, x1, y2)


SHOELACE = """abs(list_sum(list_transform(range(len({p}) // 2), lambda i:
    {p}[2*i+1] * {p}[(2*(i+1)) % len({p}) + 2] - {p}[(2*(i+1)) % len({p}) + 1] * {p}[2*i+2]))) / 2"""


@query("iou", f"SELECT p.pred_id, round({iou_sql('p', 'g')}, 6) AS iou FROM fx_pred p JOIN fx_gt g ON g.ann_id = p.pred_id // 2")
def _(t):
    p, g = t.fx_pred.withColumn("ann_id", F.floor(F.col("pred_id") / 2)).alias("p"), t.fx_gt.alias("g")
    return p.join(g, F.col("p.ann_id") == F.col("g.ann_id")).select("pred_id", r6(geo.iou(geo.box("p."), geo.box("g.")), "iou"))


@query("box_convert", """SELECT ann_id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy,
    x1 + (x2 - x1) AS bx2, (y1 + y2) / 2 + (y2 - y1) / 2 AS by2 FROM fx_gt""")
def _(t):
    x, y, w, h = geo.xyxy_to_xywh(*geo.box())
    cx, cy, cw, ch = geo.xyxy_to_center(*geo.box())
    return t.fx_gt.select(
        "ann_id", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), cx.alias("cx"), cy.alias("cy"),
        geo.xywh_to_xyxy(x, y, w, h)[2].alias("bx2"), geo.center_to_xyxy(cx, cy, cw, ch)[3].alias("by2"))


_TOK = "string_split(trim(line), ' ')"
_NUM = "TRY_CAST(tok[{i}] AS DOUBLE)"


@query("yolo_to_pixels", f"""
    SELECT l.stem, line_num, round(({_NUM.format(i=2)} - {_NUM.format(i=4)} / 2) * width, 6) AS x1, round(({_NUM.format(i=3)} - {_NUM.format(i=5)} / 2) * height, 6) AS y1,
      round(({_NUM.format(i=2)} + {_NUM.format(i=4)} / 2) * width, 6) AS x2, round(({_NUM.format(i=3)} + {_NUM.format(i=5)} / 2) * height, 6) AS y2
    FROM (SELECT *, {_TOK} AS tok FROM fx_label_line) l JOIN fx_image i ON i.image_id::VARCHAR = l.stem WHERE len(tok) = 5""")
def _(t):
    lines = t.fx_label_line.withColumn("tok", text.tokens(F.col("line"))).filter(F.size("tok") == 5)
    dims = t.fx_image.select(F.col("image_id").cast("string").alias("stem"), "width", "height")
    n = [text.as_float(F.get("tok", F.lit(i))) for i in range(1, 5)]
    c = geo.yolo_to_pixels(*n, F.col("width"), F.col("height"))
    return lines.join(dims, "stem").select("stem", "line_num", *[r6(v, k) for v, k in zip(c, ("x1", "y1", "x2", "y2"))])


@query("polygon_to_yolo", f"""
    SELECT ann_id, array_to_string(list_transform(range(10), lambda i: printf('%.6f',
      greatest(0.0, least(1.0, p[i + 1] / CASE WHEN i % 2 = 0 THEN 128.0::DOUBLE ELSE 80.0::DOUBLE END)))), ' ') AS line
    FROM (SELECT ann_id, {POLY} AS p FROM fx_gt)""")
def _(t):
    return t.fx_gt.select("ann_id", geo.polygon_to_yolo(poly(), F.lit(128.0), F.lit(80.0)).alias("line"))


@query("bbox_to_polygon", f"SELECT ann_id, {sql6('[x1, y1, x2, y1, x2, y2, x1, y2]')} AS poly FROM fx_gt")
def _(t):
    return t.fx_gt.select("ann_id", text6(geo.bbox_to_polygon(*geo.xyxy_to_xywh(*geo.box()))).alias("poly"))


@query("clip_box", """SELECT pred_id, greatest(0.0, least(x1, 90.0)) AS x1, greatest(0.0, least(y1, 70.0)) AS y1,
    greatest(0.0, least(x2, 90.0)) AS x2, greatest(0.0, least(y2, 70.0)) AS y2 FROM fx_pred
    WHERE x2 > x1 AND y2 > y1 AND greatest(0.0, least(x2, 90.0)) > greatest(0.0, least(x1, 90.0))
      AND greatest(0.0, least(y2, 70.0)) > greatest(0.0, least(y1, 70.0))""")
def _(t):
    c, keep = geo.clip_box(geo.box(), F.lit(90.0), F.lit(70.0))
    return t.fx_pred.filter(keep).select("pred_id", *[v.alias(n) for v, n in zip(c, ("x1", "y1", "x2", "y2"))])


@query("scale_vlm_boxes", """SELECT ann_id, round_even(x1 * 640 / 1000, 0)::INT AS x1, round_even(y1 * 480 / 1000, 0)::INT AS y1,
    trunc(x2 * 640 / 1000)::INT AS x2, y2 FROM fx_gt""")
def _(t):
    x1, y1, x2, y2 = geo.box()
    w, h = F.lit(640), F.lit(480)
    return t.fx_gt.select(
        "ann_id", geo.scale_coords(x1, w, 1000).cast("int").alias("x1"), geo.scale_coords(y1, h, 1000).cast("int").alias("y1"),
        geo.scale_coords(x2, w, 1000, truncate=True).cast("int").alias("x2"), geo.scale_coords(y2, h, 1).alias("y2"))


@query("normalize_box_order", """SELECT ann_id, array_to_string(list_transform(CASE
      WHEN category_id = 0 THEN [y1, x1, y2, x2] WHEN category_id = 1 THEN [x1, y1, x2, y2] WHEN category_id = 2 THEN [x1, y1, x2] ELSE NULL END,
      lambda v: printf('%.6f', v)), ',') AS bbox_2d FROM fx_gt""")
def _(t):
    # Class 0 answers under box_2d (y first), 1 and 2 under bbox (2 with a missing number), others not at all.
    x1, y1, x2, y2 = geo.box()
    cat = F.col("category_id")
    item = F.struct(
        F.lit(None).cast("array<double>").alias("bbox_2d"), F.when(cat == 0, F.array(x1, y1, x2, y2)).alias("box_2d"),
        F.when(cat == 1, F.array(x1, y1, x2, y2)).when(cat == 2, F.array(x1, y1, x2)).alias("bbox"))
    from framelark.operators.responses import normalize_box_order
    return t.fx_gt.select("ann_id", text6(normalize_box_order(item, "yxyx")).alias("bbox_2d"))


@query("polygon_area", f"SELECT ann_id, round({SHOELACE.format(p='p')}, 6) AS area FROM (SELECT ann_id, {POLY} AS p FROM fx_gt)")
def _(t):
    return t.fx_gt.select("ann_id", r6(geo.polygon_area(poly()), "area"))


_INSIDE = "(({px}) >= x1 AND ({px}) < x2 AND ({py}) >= y1 AND ({py}) < y2)"


@query("select_by_points", f"""SELECT ann_id FROM fx_gt
    WHERE ({_INSIDE.format(px='40.5', py='30.5')} OR {_INSIDE.format(px='70.5', py='50.5')}) AND NOT {_INSIDE.format(px='60.5', py='20.5')}""")
def _(t):
    pt = lambda x, y, pos: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(pos).alias("positive"))
    pts = F.array(pt(40.5, 30.5, True), pt(70.5, 50.5, True), pt(60.5, 20.5, False))
    rect = geo.bbox_to_polygon(*geo.xyxy_to_xywh(*geo.box()))
    return t.fx_gt.filter(geo.selected_by_points(rect, pts)).select("ann_id")


@query("classify_label", f"""SELECT stem, line_num, CASE WHEN n = 5 THEN 'det' WHEN n - 1 >= 6 AND (n - 1) % 2 = 0 THEN 'seg' ELSE 'det' END AS kind
    FROM (SELECT *, len({_TOK}) AS n FROM fx_label_line)""")
def _(t):
    return t.fx_label_line.select("stem", "line_num", text.label_kind(text.tokens(F.col("line"))).alias("kind"))


@query("parse_seg_label", f"""SELECT stem, line_num, CASE WHEN len(tok) >= 7 AND (len(tok) - 1) // 2 >= 3 THEN
      array_to_string(list_transform(range(2 * ((len(tok) - 1) // 2)), lambda i:
        trunc(tok[i + 2]::DOUBLE * CASE WHEN i % 2 = 0 THEN 640 ELSE 480 END)::INT), ',') END AS poly
    FROM (SELECT *, {_TOK} AS tok FROM fx_label_line)""")
def _(t):
    pts = text.seg_polygon(text.tokens(F.col("line")), F.lit(640), F.lit(480))
    return t.fx_label_line.select("stem", "line_num", F.array_join(pts.cast("array<string>"), ",").alias("poly"))


@query("filter_confidence", """SELECT pred_id, category_id, confidence FROM fx_pred
    WHERE confidence >= 0.4 OR (category_id IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE')) AND confidence >= 0.1)""")
def _(t):
    from framelark.operators.responses import filter_confidence
    names = t.region.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name"))
    return filter_confidence(t.fx_pred, 0.4, names, ["ASIA", "EUROPE"], 0.1).select("pred_id", "category_id", F.col("confidence"))


@query("clamp_detections", """SELECT * FROM (SELECT pred_id, greatest(0.0, least(x1, 90.0)) AS x1, greatest(0.0, least(y1, 70.0)) AS y1,
    greatest(0.0, least(x2, 90.0)) AS x2, greatest(0.0, least(y2, 70.0)) AS y2 FROM fx_pred) WHERE x2 - x1 >= 2 AND y2 - y1 >= 2""")
def _(t):
    c, keep = geo.clamp_detection(geo.box(), F.lit(90.0), F.lit(70.0))
    return t.fx_pred.filter(keep).select("pred_id", *[v.alias(n) for v, n in zip(c, ("x1", "y1", "x2", "y2"))])


@query("scale_intrinsics", """SELECT image_id, round((500 + r_regionkey * 10) * (width / 1280.0::DOUBLE), 6) AS fl_x, round((510 + r_regionkey * 10) * (height / 720.0::DOUBLE), 6) AS fl_y,
    round(640 * (width / 1280.0::DOUBLE), 6) AS cx, round(360 * (height / 720.0::DOUBLE), 6) AS cy FROM fx_image JOIN region ON r_regionkey = image_id % 5""")
def _(t):
    from framelark.operators.responses import scale_intrinsics
    cams = t.region.select(
        F.col("r_name").alias("camera"), (500.0 + F.col("r_regionkey") * 10).alias("fl_x"), (510.0 + F.col("r_regionkey") * 10).alias("fl_y"),
        F.lit(640.0).alias("cx"), F.lit(360.0).alias("cy"), F.lit(1280).alias("cal_width"), F.lit(720).alias("cal_height"))
    names = t.region.select(F.col("r_regionkey").cast("long").alias("_k"), F.col("r_name").alias("camera"))
    images = t.fx_image.withColumn("_k", F.col("image_id") % 5).join(names, "_k").select("image_id", "width", "height", "camera")
    return scale_intrinsics(images, cams).select("image_id", *[r6(c, c) for c in ("fl_x", "fl_y", "cx", "cy")])


@query("l2_normalize", """SELECT vec_id, array_to_string(list_transform(v, lambda x: printf('%.6f', x / CASE WHEN n < 1e-12 THEN 1.0 ELSE n END + 0.0)), ',') AS v
    FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n
          FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings))""")
def _(t):
    return t.embeddings.select("vec_id", text6(geo.l2_normalize(F.col("embedding"))).alias("v"))


@query("filter_polygons", """SELECT ann_id, array_to_string(list_transform(CASE
      WHEN (x2 - x1) * (y2 - y1) >= 1500 THEN [x1, y1, x2, y1, x2, y2, x1, y2] ELSE [x1, y1, x2, y1, x2, y2, x1, y2] END, lambda v: printf('%.6f', v)), ',') AS polys
    FROM fx_gt""")
def _(t):
    x1, y1, x2, y2 = geo.box()
    mx = (x1 + x2) / 2
    polys = F.array(F.array(x1, y1, mx, y1, mx, y1 + 1), geo.bbox_to_polygon(x1, y1, x2 - x1, y2 - y1), F.array(x1, y1, x2, y2))
    return t.fx_gt.select("ann_id", F.array_join(F.transform(geo.filter_polygons(polys, 1500.0), text6), "|").alias("polys"))


# --- text ----------------------------------------------------------------------------------------

_BLOCK = """CASE WHEN contains(response, '```json') THEN string_split(string_split(response, '```json')[2], '```')[1]
    WHEN contains(response, '```') THEN string_split(response, '```')[2] ELSE response END"""


@query("parse_vlm_json", f"""SELECT image_id, CASE WHEN json_valid(b) THEN NULL ELSE response END AS raw,
      CASE WHEN json_valid(b) THEN NULL ELSE 'Could not parse as JSON' END AS parse_error,
      CASE WHEN json_valid(b) THEN json_array_length(b)::INT END AS detections, b::VARCHAR ->> '$[0].label' AS label, b::VARCHAR ->> '$[#-1].label' AS last_label
    FROM (SELECT image_id, response, CASE WHEN json_valid({_BLOCK}) THEN {_BLOCK} END AS b FROM fx_vlm)""")
def _(t):
    from framelark.operators.responses import parse_responses
    return parse_responses(t.fx_vlm).select(
        "image_id", "raw", "parse_error", F.when(F.col("dets").isNotNull(), F.size("dets")).alias("detections"),
        F.get("dets", F.lit(0))["label"].alias("label"), F.get("dets", F.size("dets") - 1)["label"].alias("last_label"))


_LINES = """concat('# boxes', chr(10), '[', category_id, ', ', x1::INT, ', ', y1::INT, ', ', x2::INT, ', ', y2::INT, ']', chr(10),
    CASE WHEN ann_id % 3 = 0 THEN '[robot, 1, 2, three, 4]' ELSE 'robot, 1.5, 2, 3, 4, 0.9' END)"""


@query("parse_bbox_lines", """SELECT ann_id, c AS class, array_to_string(list_transform(b, lambda v: printf('%.6f', v)), ',') AS bbox FROM (
      SELECT ann_id, category_id::VARCHAR AS c, [x1, y1, x2, y2] AS b FROM fx_gt
      UNION ALL SELECT ann_id, 'robot', [1.5::DOUBLE, 2, 3, 4] FROM fx_gt WHERE ann_id % 3 <> 0)""")
def _(t):
    src = t.fx_gt.selectExpr("ann_id", f"{_LINES.replace('x1::INT', 'CAST(x1 AS INT)').replace('y1::INT', 'CAST(y1 AS INT)').replace('x2::INT', 'CAST(x2 AS INT)').replace('y2::INT', 'CAST(y2 AS INT)')} AS response")
    got = src.select("ann_id", F.explode(text.bbox_lines(F.col("response"))).alias("b"))
    return got.select("ann_id", F.col("b.class").alias("class"), text6(F.col("b.bbox")).alias("bbox"))


_PLAIN = "replace(lower(trim({c})), '_', ' ')"
_MATCHES = ("({a} IS NULL OR trim({a}) = '' OR {pa} = {pb} OR contains({pa}, {pb}) OR contains({pb}, {pa}) OR "
            "list_has_any(list_filter(string_split_regex({pa}, '\\s+'), lambda w: w <> ''), list_filter(string_split_regex({pb}, '\\s+'), lambda w: w <> '')))")


def matches_sql(a, b):
    return _MATCHES.format(a=a, pa=_PLAIN.format(c=a), pb=_PLAIN.format(c=b))


@query("label_matches", f"SELECT DISTINCT p_type, n_name, {matches_sql('p_type', 'n_name')} AS hit FROM part JOIN nation ON n_nationkey = p_partkey % 25")
def _(t):
    j = t.part.withColumn("k", (F.col("p_partkey") % 25).cast("int")).join(t.nation, F.col("k") == F.col("n_nationkey"))
    return j.select("p_type", "n_name", text.label_matches(F.col("p_type"), F.col("n_name")).alias("hit")).distinct()


# Detections of the responses; one row without label for a response that does not parse.
_LABELS = """SELECT image_id, ann_id, label FROM fx_label WHERE image_id % 37 <> 0
    UNION ALL SELECT DISTINCT image_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM fx_label WHERE image_id % 37 = 0"""
_CLASSES = ["exit sign", "Ceiling light", "map"]


def _labels(t):
    from framelark.operators.responses import parse_responses
    dets = parse_responses(t.fx_vlm).select("image_id", F.posexplode_outer("dets").alias("pos", "d"))
    return dets.select("image_id", (F.col("image_id") * 100 + F.col("pos") + 1).alias("ann_id"), F.col("d.label").alias("label"))


@query("canonicalize_labels", f"""SELECT image_id, ann_id, label AS raw, coalesce({', '.join(f"CASE WHEN {matches_sql('label', repr(c))} THEN '{c}' END" for c in _CLASSES)}) AS label
    FROM ({_LABELS}) WHERE {' OR '.join(matches_sql('label', repr(c)) for c in _CLASSES)}""")
def _(t):
    from framelark.operators.responses import canonicalize_labels
    kept, _dropped = canonicalize_labels(_labels(t).withColumn("raw", F.col("label")), _CLASSES)
    return kept.select("image_id", "ann_id", "raw", "label")


@query("match_query_span", f"""SELECT image_id, ann_id, coalesce(
      {', '.join(f"CASE WHEN lower(trim(label)) = '{c.lower()}' THEN '{c}' END" for c in _CLASSES)},
      {', '.join(f"CASE WHEN contains(lower(trim(label)), '{c.lower()}') OR contains('{c.lower()}', lower(trim(label))) THEN '{c}' END" for c in _CLASSES)},
      CASE WHEN trim(label) <> '' THEN label END, 'object') AS label FROM ({_LABELS})""")
def _(t):
    return _labels(t).select("image_id", "ann_id", text.match_span(F.col("label"), _CLASSES).alias("label"))


@query("source_id", """SELECT page_id, regexp_extract(s, '^(\\d+)', 1) AS sid FROM (
      SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS s FROM pages) WHERE regexp_matches(s, '^\\d')
    UNION ALL SELECT image_id, split_part(file_name, '.', 1) FROM fx_image""")
def _(t):
    a = t.pages.select("page_id", text.source_id(F.col("url")).alias("sid")).filter("sid is not null")
    return a.unionByName(t.fx_image.select(F.col("image_id").alias("page_id"), text.source_id(F.col("file_name")).alias("sid")))


@query("frame_timestamp", "SELECT file_name, timestamp_ns AS ts FROM fx_frame UNION ALL SELECT 'cam_' || file_name, NULL FROM fx_frame")
def _(t):
    both = t.fx_frame.select("file_name").union(t.fx_frame.select(F.concat(F.lit("cam_"), F.col("file_name"))))
    return both.select("file_name", text.frame_timestamp(F.col("file_name")).alias("ts"))


@query("safe_class_name", """
    WITH s AS (SELECT p_brand AS image, p_name, regexp_replace(long, '[^\\p{L}\\p{N}]', '_', 'g') AS safe0, long, p_partkey
      FROM (SELECT *, CASE WHEN p_size > 25 THEN repeat(concat(p_name, ' - ', p_type, '; '), 5) ELSE p_type END AS long FROM part))
    SELECT image, class_name, CASE WHEN rk > 1 THEN safe || '_' || rk ELSE safe END AS safe_name FROM (
      SELECT image, class_name, safe, row_number() OVER (PARTITION BY image, safe ORDER BY class_name) AS rk FROM (
        SELECT DISTINCT image, long AS class_name, CASE WHEN length(safe0) > 120 THEN substr(safe0, 1, 111) || '_' || substr(md5(long), 1, 8) ELSE safe0 END AS safe FROM s))""")
def _(t):
    from framelark.operators.responses import safe_class_names
    src = t.sql("SELECT p_brand AS image, CASE WHEN p_size > 25 THEN repeat(concat(p_name, ' - ', p_type, '; '), 5) ELSE p_type END AS class_name FROM part")
    return safe_class_names(src.distinct(), ["image"])


@query("label_remap", """SELECT p_partkey, coalesce(m.dst, p_type) AS label FROM part LEFT JOIN (
    SELECT src, max_by(dst, pos) AS dst FROM (SELECT p_type AS src, p_brand AS dst, p_partkey AS pos FROM part WHERE p_size < 5) GROUP BY src) m ON m.src = p_type""")
def _(t):
    from framelark.operators.responses import label_remap
    mapping = t.part.filter("p_size < 5").select(F.col("p_type").alias("src"), F.col("p_brand").alias("dst"), F.col("p_partkey").alias("pos"))
    return label_remap(t.part.select("p_partkey", F.col("p_type").alias("label")), mapping)


@query("merge_per_class_results", f"""SELECT image_id, class_name AS label, count(*) AS kept FROM (
      SELECT l.image_id, l.label, c.class_name FROM ({_LABELS}) l JOIN (SELECT unnest({_CLASSES}) AS class_name) c ON {matches_sql('l.label', 'c.class_name')}
      WHERE NOT (l.image_id % 7 = 0 AND c.class_name = 'map')) GROUP BY ALL""")
def _(t):
    # One response per image and class; the call for "map" failed on every seventh image.
    from framelark.operators.responses import merge_per_class_results
    calls = _labels(t).withColumn("class_name", F.explode(F.array(*[F.lit(c) for c in _CLASSES])))
    calls = calls.withColumn("success", ~((F.col("image_id") % 7 == 0) & (F.col("class_name") == "map")))
    items, _counts = merge_per_class_results(calls)
    return items.groupBy("image_id", "label").agg(F.count("*").alias("kept"))
