"""Combining, editing, importing and converting annotated sets."""

from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.operators import convert, datasets, responses, suppress
from framelark.plans.evaluation import iou_sql
from framelark.plans.projections import _CLASSES, _LABELS, matches_sql, sql6, text6
from framelark.plans.registry import query, r6

# Three parts with their own category numbering; part 2 lacks one category, so its boxes dangle.
_PARTS = dict(
    p_img="""SELECT CASE split WHEN 'train' THEN 0 WHEN 'test' THEN 1 ELSE 2 END AS part, image_id AS pos, image_id, file_name, 'left' AS side, timestamp_ns FROM fx_image""",
    p_ann="""SELECT i.part, g.ann_id AS pos, g.ann_id, g.image_id, g.category_id FROM fx_gt g JOIN p_img i ON i.image_id = g.image_id""",
    p_cat="""SELECT p.k AS part, r_regionkey AS pos, (r_regionkey + p.k) % 5 AS category_id, r_name AS name FROM region,
             (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) p WHERE NOT (p.k = 2 AND r_name = 'ASIA')""",
)
_COMB = dict(
    **_PARTS,
    new_cat="SELECT name, row_number() OVER (ORDER BY f) - 1 AS new_cat FROM (SELECT name, min(part * 1000 + pos) AS f FROM p_cat GROUP BY 1)",
    joined="""SELECT a.*, i.new_image, n.new_cat FROM p_ann a LEFT JOIN (SELECT *, row_number() OVER (ORDER BY part, pos) AS new_image FROM p_img) i ON i.part = a.part AND i.image_id = a.image_id
              LEFT JOIN p_cat c ON c.part = a.part AND c.category_id = a.category_id LEFT JOIN new_cat n ON n.name = c.name""",
)


def _parts(t):
    img = t.sql(_PARTS["p_img"])
    ann = t.fx_gt.join(img.select("image_id", "part"), "image_id").select("part", F.col("ann_id").alias("pos"), "ann_id", "image_id", "category_id")
    cat = t.region.select(F.explode(F.sequence(F.lit(0), F.lit(2))).alias("part"), "r_regionkey", "r_name").filter("not (part = 2 and r_name = 'ASIA')")
    cat = cat.select("part", F.col("r_regionkey").alias("pos"), ((F.col("r_regionkey") + F.col("part")) % 5).alias("category_id"), F.col("r_name").alias("name"))
    return img, ann, cat


@query("combine_datasets", """SELECT row_number() OVER (ORDER BY part, pos) AS ann_id, new_image AS image_id, new_cat::INT AS category_id, part
    FROM joined WHERE new_image IS NOT NULL AND new_cat IS NOT NULL""", **_COMB)
def _(t):
    return datasets.combine_datasets(*_parts(t))[1].select("ann_id", "image_id", "category_id", "part")


@query("combine_datasets_images", "SELECT row_number() OVER (ORDER BY part, pos) AS image_id, file_name, part FROM p_img", p_img=_PARTS["p_img"])
def _(t):
    return datasets.combine_datasets(*_parts(t))[0].select("image_id", "file_name", "part")


@query("combine_datasets_dropped", "SELECT part, count(*) AS dropped FROM joined WHERE new_image IS NULL OR new_cat IS NULL GROUP BY part", **_COMB)
def _(t):
    return datasets.combine_datasets(*_parts(t))[3]


_SIDES = dict(
    s_img="SELECT side, timestamp_ns AS pos, timestamp_ns AS image_id, file_name FROM fx_frame",
    s_ann="""SELECT side, pose_id AS pos, pose_id AS ann_id, f.image_id, CASE WHEN side = 'left' THEN pose_id % 3 ELSE 7 + pose_id % 3 END AS category_id
             FROM fx_pose JOIN s_img f ON f.image_id = 1700000000000000000 + pose_id * 100000000""",
)


def _stereo(t):
    img = t.sql(_SIDES["s_img"])
    ann = t.fx_pose.withColumn("image_id", F.lit(1700000000000000000) + F.col("pose_id") * 100000000).join(img.select("side", "image_id"), "image_id")
    ann = ann.select("side", F.col("pose_id").alias("pos"), F.col("pose_id").alias("ann_id"), "image_id",
                     F.when(F.col("side") == "left", F.col("pose_id") % 3).otherwise(7 + F.col("pose_id") % 3).cast("int").alias("category_id"))
    cat = t.region.filter("r_regionkey < 3").select(F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side"), "r_regionkey", "r_name")
    cat = cat.select("side", F.col("r_regionkey").alias("pos"), (F.col("r_regionkey") + F.when(F.col("side") == "left", 0).otherwise(7)).alias("category_id"), F.col("r_name").alias("name"))
    return img, ann, cat


@query("merge_stereo", """SELECT row_number() OVER (ORDER BY side, pos) AS ann_id, i.new_image AS image_id, (ann_id % 3)::INT AS category_id, side
    FROM s_ann a JOIN (SELECT side, image_id, row_number() OVER (ORDER BY side, pos) AS new_image FROM s_img) i USING (side, image_id)""", **_SIDES)
def _(t):
    return datasets.merge_stereo(*_stereo(t))[1].select("ann_id", "image_id", "category_id", "side")


@query("annotated_sets", """SELECT 'id' AS kind, image_id AS value FROM (SELECT DISTINCT image_id FROM fx_gt)
    UNION ALL SELECT 'ts', ts FROM (SELECT DISTINCT CASE WHEN split = 'val' THEN 0 ELSE timestamp_ns END AS ts FROM fx_image WHERE image_id IN (SELECT image_id FROM fx_gt))""")
def _(t):
    im = t.fx_image.withColumn("timestamp_ns", F.when(F.col("split") != "val", F.col("timestamp_ns")))
    ids = datasets.annotated_image_ids(t.fx_gt).select(F.lit("id").alias("kind"), F.col("image_id").alias("value"))
    ts = datasets.annotated_timestamps(im, t.fx_gt, missing="zero")
    return ids.unionByName(ts.select(F.lit("ts").alias("kind"), F.col("timestamp_ns").alias("value")))


@query("annotated_timestamps", "SELECT DISTINCT timestamp_ns FROM fx_image WHERE split <> 'val' AND image_id IN (SELECT image_id FROM fx_gt)")
def _(t):
    im = t.fx_image.withColumn("timestamp_ns", F.when(F.col("split") != "val", F.col("timestamp_ns")))
    return datasets.annotated_timestamps(im, t.fx_gt)


@query("union_categories", """SELECT n_nationkey AS category_id, n_name AS name FROM nation WHERE n_regionkey < 2
    UNION ALL SELECT c_nationkey, nm FROM cur WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2) AND nm NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 2)""",
       cur="SELECT DISTINCT s.s_nationkey AS c_nationkey, n.n_name AS nm FROM supplier s JOIN nation n ON n.n_nationkey = (s.s_nationkey + s.s_suppkey) % 25")
def _(t):
    saved = t.nation.filter("n_regionkey < 2").select(F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("name"))
    cur = t.sql("SELECT DISTINCT s.s_nationkey AS category_id, n.n_name AS name FROM supplier s JOIN nation n ON n.n_nationkey = (s.s_nationkey + s.s_suppkey) % 25")
    return datasets.union_categories(saved, cur)


@query("resolve_labels", """SELECT label, CASE WHEN id IS NOT NULL THEN id WHEN n IS NOT NULL THEN n ELSE 24 + row_number() OVER (PARTITION BY id IS NULL AND n IS NULL ORDER BY pos, label) END::INT AS category_id,
      id IS NULL AND n IS NULL AS created
    FROM (SELECT l.label, l.pos, a.n_nationkey AS id, b.n_nationkey AS n FROM (SELECT label, min(pos) AS pos FROM lab GROUP BY 1) l
          LEFT JOIN nation a ON a.n_nationkey = TRY_CAST(l.label AS BIGINT) LEFT JOIN nation b ON b.n_name = l.label)""",
       lab="""SELECT CASE WHEN p_size < 20 THEN CAST(p_size AS VARCHAR) WHEN p_size < 30 THEN n_name ELSE p_type END AS label, p_partkey AS pos FROM part JOIN nation ON n_nationkey = p_partkey % 25""")
def _(t):
    lab = t.sql("SELECT CASE WHEN p_size < 20 THEN CAST(p_size AS STRING) WHEN p_size < 30 THEN n_name ELSE p_type END AS label, p_partkey AS pos FROM part JOIN nation ON n_nationkey = p_partkey % 25")
    return datasets.resolve_labels(lab, t.nation.select(F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("name")))


@query("assemble_dataset", """SELECT image_id::VARCHAR || '_aug0' AS name, 'train' AS split FROM fx_image WHERE split = 'train'
    UNION ALL SELECT image_id::VARCHAR, 'train' FROM fx_image WHERE split = 'train' UNION ALL SELECT image_id::VARCHAR, split FROM fx_image WHERE split <> 'train'""")
def _(t):
    raw = t.fx_image.select(F.col("image_id").cast("string").alias("name"), "split")
    train = raw.filter("split = 'train'").select("name")
    return datasets.assemble_dataset(raw, train.unionByName(train.select(F.concat("name", F.lit("_aug0")).alias("name"))))


# Edits made out of the line items of the same orders: one per line, the kind by ship flag and tax.
_LOG = """SELECT 2 * row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS seq,
    CASE WHEN l_tax < 0.005 THEN 'remove' WHEN l_tax < 0.025 THEN 'move' WHEN l_tax < 0.045 THEN 'resize' WHEN l_tax < 0.065 THEN 'set_category' ELSE 'set_track' END AS op,
    l_orderkey * 100 + l_linenumber AS ann_id, CAST(NULL AS BIGINT) AS image_id, CAST(l_suppkey % 7 AS INT) AS category_id, l_partkey AS track_id,
    l_quantity AS x, l_discount AS y, l_quantity + 10 AS w, l_quantity + 20 AS h, CAST(NULL AS STRING) AS name FROM lineitem"""
_ADMIN = """SELECT CAST(s AS BIGINT) AS seq, op, CAST(NULL AS BIGINT) AS ann_id, CAST(NULL AS BIGINT) AS image_id, c AS category_id, CAST(NULL AS BIGINT) AS track_id,
    CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y, CAST(NULL AS DOUBLE) AS w, CAST(NULL AS DOUBLE) AS h, nm AS name
    FROM (SELECT n * 2 + 1 AS s, 'delete_category' AS op, r_regionkey AS c, CAST(NULL AS STRING) AS nm FROM region, (SELECT count(*) AS n FROM lineitem) WHERE r_name = 'ASIA'
          UNION ALL SELECT n + 1 - n % 2, 'delete_category', r_regionkey, NULL FROM region, (SELECT count(*) AS n FROM lineitem) WHERE r_name = 'AFRICA'
          UNION ALL SELECT n * 2 + 2, 'rename_category', r_regionkey, concat(r_name, ' (new)') FROM region, (SELECT count(*) AS n FROM lineitem) WHERE r_name = 'EUROPE') z"""
# Boxes drawn after all that, one per customer.
_ADDED = """SELECT n * 2 + 3 AS seq, 'add' AS op, -c_custkey - 1 AS ann_id, c_custkey AS image_id, CAST(1 AS INT) AS category_id, CAST(NULL AS BIGINT) AS track_id,
    CAST(1 AS DOUBLE) AS x, CAST(2 AS DOUBLE) AS y, CAST(3 AS DOUBLE) AS w, CAST(4 AS DOUBLE) AS h, CAST(NULL AS STRING) AS name FROM customer, (SELECT count(*) AS n FROM lineitem)"""


@query("apply_edits", """
    SELECT a.ann_id, a.image_id, coalesce(c.v, a.category_id) AS category_id, k.v AS track_id, coalesce(m.x, a.x1) AS x, coalesce(m.y, a.y1) AS y,
      coalesce(r.w, a.x2 - a.x1) AS w, coalesce(r.h, a.y2 - a.y1) AS h
    FROM fx_gt a
    LEFT JOIN (SELECT ann_id, arg_max(category_id, seq) AS v FROM lg WHERE op = 'set_category' GROUP BY 1) c ON c.ann_id = a.ann_id
    LEFT JOIN (SELECT ann_id, arg_max(track_id, seq) AS v FROM lg WHERE op = 'set_track' GROUP BY 1) k ON k.ann_id = a.ann_id
    LEFT JOIN (SELECT ann_id, arg_max(x, seq) AS x, arg_max(y, seq) AS y FROM lg WHERE op IN ('move', 'resize') GROUP BY 1) m ON m.ann_id = a.ann_id
    LEFT JOIN (SELECT ann_id, arg_max(w, seq) AS w, arg_max(h, seq) AS h FROM lg WHERE op = 'resize' GROUP BY 1) r ON r.ann_id = a.ann_id
    LEFT JOIN (SELECT ann_id, arg_max(category_id, seq) AS v FROM lg WHERE op = 'set_category' AND seq <= (SELECT count(*) FROM lineitem) GROUP BY 1) e ON e.ann_id = a.ann_id
    WHERE a.ann_id NOT IN (SELECT ann_id FROM lg WHERE op = 'remove')
      AND coalesce(c.v, a.category_id) NOT IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')
      AND coalesce(e.v, a.category_id) NOT IN (SELECT r_regionkey FROM region WHERE r_name = 'AFRICA')
    UNION ALL SELECT -c_custkey - 1, c_custkey, 1, NULL, 1, 2, 3, 4 FROM customer""", lg=_LOG)
def _(t):
    return _edited(t)[0]


@query("apply_edits_categories", "SELECT r_regionkey AS category_id, CASE WHEN r_name = 'EUROPE' THEN r_name || ' (new)' ELSE r_name END AS name FROM region WHERE r_name NOT IN ('ASIA', 'AFRICA')")
def _(t):
    return _edited(t)[1]


def _edited(t):
    anns = t.fx_gt.select("ann_id", "image_id", "category_id", F.lit(None).cast("long").alias("track_id"), F.col("x1").alias("x"), F.col("y1").alias("y"),
                          (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    log = _numbered_log(t).unionByName(t.sql(_ADMIN)).unionByName(t.sql(_ADDED))
    cats = t.region.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name"))
    return datasets.apply_edits(anns, cats, log)


def _numbered_log(t):
    from framelark.operators.scale import ordinal
    cols = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    # Numbered first: only the columns of the order move. The columns of the log come from them.
    lines = ordinal(t.lineitem.select(*cols), [], cols, "seq", start=1)
    columns, source = _LOG.split(" AS seq,", 1)[1].strip().rsplit(" FROM ", 1)
    return t._spark.sql(f"SELECT 2 * seq AS seq, {columns} FROM {{{source}}}", **{source: lines})


@query("unsynced_filter", """SELECT g.pose_id AS ann_id, f.side FROM fx_pose g JOIN (SELECT side, timestamp_ns, row_number() OVER () AS z FROM fx_frame) f
      ON f.timestamp_ns = 1700000000000000000 + pose_id * 100000000
    WHERE f.timestamp_ns IN (SELECT timestamp_ns FROM fx_frame GROUP BY 1 HAVING count(DISTINCT side) = 2) AND f.timestamp_ns % 700000000 <> 0""")
def _(t):
    images = t.fx_frame.select(F.concat("side", F.col("timestamp_ns").cast("string")).alias("image_id"), "side", "timestamp_ns", F.col("timestamp_ns").alias("frame_idx"))
    anns = t.fx_pose.withColumn("timestamp_ns", F.lit(1700000000000000000) + F.col("pose_id") * 100000000).join(images.select("timestamp_ns", "image_id", "side"), "timestamp_ns")
    gone = images.filter("timestamp_ns % 700000000 = 0").select("frame_idx")
    return datasets.unsynced_filter(images.drop("x"), anns.select(F.col("pose_id").alias("ann_id"), "image_id", "side"), gone)[1].select("ann_id", "side")


@query("register_frames", """
    SELECT timestamp_ns, side, CASE WHEN c_custkey IS NULL THEN (SELECT max(c_custkey) FROM customer) + row_number() OVER (PARTITION BY c_custkey IS NULL ORDER BY timestamp_ns, side) ELSE c_custkey END AS image_id,
      file_name, CASE WHEN fw > 0 THEN fw ELSE coalesce(ow, 0) END AS width, c_custkey IS NULL AS created FROM (
      SELECT coalesce(f.timestamp_ns, o.ts) AS timestamp_ns, coalesce(f.side, 'left') AS side, o.c_custkey, coalesce(o.fn, f.file_name) AS file_name, f.w AS fw, o.w AS ow
      FROM (SELECT *, CASE WHEN timestamp_ns % 300000000 = 0 THEN 640 ELSE 0 END AS w FROM fx_frame) f
      FULL JOIN (SELECT c_custkey, 1700000000000000000 + c_custkey * 100000000 AS ts, c_custkey || '.jpg' AS fn, CASE WHEN c_nationkey < 10 THEN 320 ELSE 0 END AS w FROM customer) o
        ON o.ts = f.timestamp_ns AND f.side = 'left')""")
def _(t):
    old = t.sql("""SELECT c_custkey AS image_id, 1700000000000000000 + c_custkey * 100000000 AS timestamp_ns, 'left' AS side, concat(c_custkey, '.jpg') AS file_name,
                   CASE WHEN c_nationkey < 10 THEN 320 ELSE 0 END AS width, CASE WHEN c_nationkey < 10 THEN 240 ELSE 0 END AS height FROM customer""")
    w = F.when(F.col("timestamp_ns") % 300000000 == 0, 640).otherwise(0)
    new = t.fx_frame.select("timestamp_ns", "side", "file_name", w.alias("width"), w.alias("height"))
    return datasets.register_frames(old, new).select("timestamp_ns", "side", "image_id", "file_name", "width", "created")


@query("pending_masks", """SELECT i.image_id // 2 AS frame_idx, CASE WHEN i.image_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, g.ann_id, coalesce(r_name, 'object') AS concept
    FROM fx_gt g JOIN fx_image i ON i.image_id = g.image_id LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON r_regionkey = g.category_id WHERE x2 - x1 < 40""")
def _(t):
    im = t.fx_image.select("image_id", F.floor(F.col("image_id") / 2).alias("frame_idx"), F.when(F.col("image_id") % 2 == 0, "left").otherwise("right").alias("side"))
    cats = t.region.filter("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("name"))
    anns = t.fx_gt.withColumn("has_mask", F.col("x2") - F.col("x1") >= 40)
    return datasets.pending_masks(anns, im, cats)[0]


@query("duplicate_images", "SELECT file_name, side, count(*) AS count FROM (SELECT CAST(l_partkey AS VARCHAR) AS file_name, CASE WHEN l_linenumber % 2 = 0 THEN 'right' ELSE 'left' END AS side FROM lineitem) GROUP BY ALL HAVING count(*) > 1")
def _(t):
    im = t.lineitem.select(F.col("l_partkey").cast("string").alias("file_name"), F.when(F.col("l_linenumber") % 2 == 0, "right").alias("side"))
    return suppress.duplicate_images(im)


@query("dedup_seed_tracks", """SELECT frame_idx, side, track_id, min(ann_id) AS ann_id FROM (
      SELECT frame_idx, CASE WHEN video_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, CASE WHEN category_id < 2 THEN ann_id % 4 END AS track_id, ann_id FROM fx_keybox) WHERE track_id IS NOT NULL GROUP BY ALL""")
def _(t):
    b = t.fx_keybox.select("frame_idx", F.when(F.col("video_id") % 2 == 0, "left").otherwise("right").alias("side"),
                           F.when(F.col("category_id") < 2, F.col("ann_id") % 4).alias("track_id"), "ann_id")
    return suppress.dedup_seed_tracks(b)


# --- import --------------------------------------------------------------------------------------

# Incoming boxes: all predictions, shifted ids, categories renumbered; live boxes: the ground truth moved
# onto the same places where the jitter is zero.
_IMP = dict(
    inc="""SELECT p.pred_id AS ann_id, CASE WHEN p.confidence < 0.02 THEN -1 ELSE p.image_id END AS image_id, p.category_id + 10 AS category_id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h,
             CASE WHEN p.confidence > 0.5 THEN CAST(p.pred_id % 900 AS VARCHAR) WHEN p.confidence > 0.3 THEN 'none' END AS track_text, p.confidence > 0.6 AS has_mask FROM fx_pred p""",
    lv="SELECT ann_id, image_id, category_id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h, ann_id % 500 + 1 AS track_id, x2 - x1 >= 40 AS has_mask FROM fx_gt",
    keyed="""SELECT i.*, im.image_id AS dst_image, CASE WHEN i.category_id - 10 = 4 THEN 5 ELSE i.category_id - 10 END AS dst_cat, i.image_id = -1 AS dangling,
               hash(0) AS z FROM inc i LEFT JOIN fx_image im ON im.image_id = i.image_id AND im.split <> 'val'""",
    dup="""SELECT k.*, l.ann_id AS live_id, l.has_mask AS live_mask, min(k.ann_id) OVER bx AS first_id, bool_or(k.has_mask) OVER bx AS any_mask
           FROM keyed k LEFT JOIN (SELECT image_id, category_id, x, y, w, h, max(ann_id) AS ann_id, arg_max(has_mask, ann_id) AS has_mask FROM lv GROUP BY 1,2,3,4,5,6) l
             ON l.image_id = k.dst_image AND l.category_id = k.dst_cat AND l.x = k.x AND l.y = k.y AND l.w = k.w AND l.h = k.h
           WHERE NOT dangling AND dst_image IS NOT NULL WINDOW bx AS (PARTITION BY dst_image, dst_cat, k.x, k.y, k.w, k.h)""",
)


def _import(t, merge=suppress.import_annotations, records=False):
    inc = t.fx_pred.select(
        F.col("pred_id").alias("ann_id"), F.when(F.col("confidence") < 0.02, -1).otherwise(F.col("image_id")).alias("image_id"), (F.col("category_id") + 10).alias("category_id"),
        F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"),
        F.when(F.col("confidence") > 0.5, (F.col("pred_id") % 900).cast("string")).when(F.col("confidence") > 0.3, "none").alias("track_text"),
        (F.col("confidence") > 0.6).alias("has_mask"), *[F.col("confidence").alias("score")] * records)
    live = t.fx_gt.select("ann_id", "image_id", "category_id", F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"),
                          (F.col("y2") - F.col("y1")).alias("h"), (F.col("ann_id") % 500 + 1).alias("track_id"), (F.col("x2") - F.col("x1") >= 40).alias("has_mask"))
    live_im = t.fx_image.filter("split <> 'val'").select("image_id", "file_name", F.lit("left").alias("side"))
    src_im = t.fx_image.select("image_id", F.concat(F.lit("/export/"), "file_name").alias("file_name"), F.lit(None).cast("string").alias("side"))
    # The name of category 4 is new to the live set, whose fifth category is called something else.
    names = t.region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    # Category 3 comes as the number of the live one.
    src_cat = names.select((F.col("k") + 10).alias("category_id"), F.when(F.col("k") == 3, "3").otherwise(F.col("name")).alias("name"))
    live_cat = names.select(F.col("k").alias("category_id"), F.when(F.col("k") == 4, "other").otherwise(F.col("name")).alias("name"))
    if not records:
        return merge(inc, src_im, src_cat, live, live_im, live_cat)
    x2, y2, ring = F.col("x") + F.col("w"), F.col("y") + F.col("h"), lambda *p: F.array(F.array(*p))
    polygon = F.when(F.col("has_mask"), ring(F.col("x"), F.col("y"), x2, F.col("y"), x2, y2 + F.col("ann_id") % 7)).when(F.col("score") > 0.55, F.array().cast("array<array<double>>"))
    inc = inc.withColumns({"segmentation": polygon, "area": F.when(F.col("ann_id") % 3 == 0, F.col("w") * F.col("h") / 2), "iscrowd": F.when(F.col("ann_id") % 11 == 0, 1)})
    live = live.withColumns({"segmentation": F.when(F.col("has_mask"), ring(F.col("x"), F.col("y"), x2, y2, F.col("x"), y2)), "score": F.lit(None).cast("double")})
    return suppress.import_records(inc.drop("has_mask"), src_im, src_cat, live.drop("has_mask"), live_im, live_cat, ["score"])


@query("import_annotations", """SELECT ann_id, 'dangling' AS fate FROM keyed WHERE dangling UNION ALL SELECT ann_id, 'foreign' FROM keyed WHERE NOT dangling AND dst_image IS NULL
    UNION ALL SELECT ann_id, CASE WHEN live_id IS NULL AND ann_id = first_id THEN 'imported' ELSE 'duplicate' END FROM dup""", **_IMP)
def _(t):
    return _import(t)[1].select("ann_id", "fate")


_DON = dict(
    given="SELECT *, min(CASE WHEN has_mask THEN ann_id END) OVER (PARTITION BY dst_image, dst_cat, x, y, w, h) AS don_id FROM dup",
    pick="SELECT *, CASE WHEN live_id IS NULL AND NOT has_mask OR live_id IS NOT NULL AND NOT live_mask THEN don_id END AS donor FROM given WHERE live_id IS NOT NULL OR ann_id = first_id",
)


@query("import_records", """
    SELECT 'live' AS origin, l.ann_id AS src, l.image_id, l.category_id, round(l.w * l.h, 6) AS area, 0 AS iscrowd, g.donor, NULL::DOUBLE AS score,
      round(CASE WHEN l.has_mask THEN l.x ELSE d.x END, 6) AS seg_x, round(CASE WHEN l.has_mask THEN l.y + l.h ELSE d.y + d.h + d.ann_id % 7 END, 6) AS seg_y
    FROM lv l LEFT JOIN (SELECT live_id, min(donor) AS donor FROM pick WHERE live_id IS NOT NULL GROUP BY 1) g ON g.live_id = l.ann_id LEFT JOIN inc d ON d.ann_id = g.donor
    UNION ALL SELECT 'imported', (SELECT max(ann_id) FROM lv) + row_number() OVER (ORDER BY p.ann_id), p.dst_image, p.dst_cat, round(CASE WHEN p.ann_id % 3 = 0 THEN p.w * p.h / 2 ELSE p.w * p.h END, 6),
      CASE WHEN p.ann_id % 11 = 0 THEN 1 ELSE 0 END, p.donor, s.confidence, round(CASE WHEN p.has_mask THEN p.x ELSE d.x END, 6), round(CASE WHEN p.has_mask THEN p.y + p.h + p.ann_id % 7 ELSE d.y + d.h + d.ann_id % 7 END, 6)
    FROM pick p JOIN fx_pred s ON s.pred_id = p.ann_id LEFT JOIN inc d ON d.ann_id = p.donor WHERE p.live_id IS NULL""", **_IMP, **_DON)
def _(t):
    got = _import(t, records=True)[0]
    ring = F.get("segmentation", F.lit(0))
    return got.select("origin", F.col("ann_id").alias("src"), "image_id", "category_id", F.round("area", 6).alias("area"), "iscrowd", "donor", "score",
                      F.round(F.get(ring, F.lit(0)), 6).alias("seg_x"), F.round(F.get(ring, F.size(ring) - 1), 6).alias("seg_y"))


@query("import_counts", """SELECT count(DISTINCT CASE WHEN live_id IS NULL AND ann_id = first_id THEN dst_image END) AS frames_matched, count(*) FILTER (live_id IS NULL AND ann_id = first_id) AS imported,
      count(*) FILTER (live_id IS NOT NULL OR ann_id <> first_id) + (SELECT count(*) FROM keyed WHERE dangling) AS skipped,
      (SELECT count(DISTINCT live_id) FROM pick WHERE live_id IS NOT NULL AND donor IS NOT NULL) + (SELECT count(*) FROM pick WHERE live_id IS NULL AND donor IS NOT NULL) AS masks_merged FROM dup""", **_IMP, **_DON)
def _(t):
    return _import(t, records=True)[2]


@query("import_annotations_merged", """
    SELECT l.ann_id, l.image_id, l.category_id, l.track_id, l.has_mask OR coalesce(g.give, false) AS has_mask, 'live' AS origin
    FROM lv l LEFT JOIN (SELECT live_id, bool_or(any_mask) AS give FROM dup WHERE live_id IS NOT NULL GROUP BY 1) g ON g.live_id = l.ann_id
    UNION ALL SELECT ann_id, dst_image, dst_cat, track_id, any_mask, 'imported' FROM (
      SELECT (SELECT max(ann_id) FROM lv) + rk AS ann_id, dst_image, dst_cat, any_mask, coalesce(own, f + greatest((SELECT max(track_id) + 1 FROM lv), coalesce(jump, 1))) AS track_id FROM (
        SELECT *, max(own + 1 - f) OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS jump FROM (
          SELECT *, coalesce(count(*) FILTER (own IS NULL) OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM (
            SELECT *, TRY_CAST(track_text AS BIGINT) AS own, row_number() OVER (ORDER BY ann_id) AS rk FROM dup WHERE live_id IS NULL AND ann_id = first_id))))""", **_IMP)
def _(t):
    return _import(t)[0].select("ann_id", "image_id", "category_id", "track_id", "has_mask", "origin")


# --- conversion ----------------------------------------------------------------------------------

_P6 = "printf('%.6f', greatest(0.0, least(1.0, {v} / {d}::DOUBLE)))"
_RECT = " || ' ' || ".join(_P6.format(v=v, d=d) for v, d in (("x1", 640), ("y1", 480), ("x2", 640), ("y1", 480), ("x2", 640), ("y2", 480), ("x1", 640), ("y2", 480)))
_TRI = " || ' ' || ".join(_P6.format(v=v, d=d) for v, d in (("x1", 640), ("y1", 480), ("x2", 640), ("y1", 480), ("x2", 640), ("y2", 480)))


def _coco(t):
    x1, y1, x2, y2 = geo.box()
    seg = F.when(x2 - x1 >= 40, F.array(F.array(x1, y1, x2, y1, x2, y2), F.array(x1, y1), F.array().cast("array<double>")))
    anns = t.fx_gt.select("ann_id", "image_id", (F.col("category_id") * 10).alias("category_id"), x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"), seg.alias("segmentation"))
    images = t.fx_image.select("image_id", "file_name", F.when(F.col("image_id") % 2 == 1, "right").alias("side"), F.col("width").cast("double"), F.col("height").cast("double"))
    return images, anns, t.region.select((F.col("r_regionkey") * 10).alias("category_id"), F.col("r_name").alias("name"))


@query("coco_to_seg_labels", f"""
    SELECT CASE WHEN image_id % 2 = 1 THEN 'right_' ELSE 'left_' END || (1700000000000000000 + image_id * 100000000) AS stem, ann_id, 0 AS part,
      category_id || ' ' || CASE WHEN x2 - x1 >= 40 THEN {_TRI} ELSE {_RECT} END AS line FROM fx_gt""")
def _(t):
    return convert.coco_to_seg_labels(*_coco(t), rectangles=True)[0]


@query("coco_to_seg_labels_summary", """SELECT (SELECT count(*) FROM fx_image) AS images, count(*) FILTER (x2 - x1 >= 40) AS polygons, count(*) FILTER (x2 - x1 < 40) AS maskless FROM fx_gt""")
def _(t):
    return convert.coco_to_seg_labels(*_coco(t))[1]


_VLM = dict(
    files="SELECT v.image_id AS k, i.file_name, v.response, row_number() OVER (ORDER BY i.file_name) - 1 AS frame_idx FROM fx_vlm v JOIN fx_image i ON i.image_id = v.image_id",
    lab=_LABELS,
    ok="""SELECT f.*, l.label, l.ann_id, g.x1, g.y1, g.x2, g.y2, dense_rank() OVER (ORDER BY f.frame_idx) AS image_id FROM files f JOIN lab l ON l.image_id = f.k JOIN fx_gt g ON g.ann_id = l.ann_id WHERE l.label IS NOT NULL""",
    cat="SELECT label, row_number() OVER (ORDER BY min(frame_idx * 1000 + ann_id % 100)) - 1 AS category_id FROM ok GROUP BY label",
)


@query("vlm_to_annotations", """SELECT row_number() OVER (ORDER BY image_id, place) AS ann_id, image_id, category_id::INT AS category_id, frame_idx, x, y, w, h FROM (
      SELECT ok.image_id, ok.ann_id AS place, frame_idx, c.category_id, x1 AS x, y1 AS y, least(x2, 100) - x1 AS w, least(y2, 80) - y1 AS h FROM ok JOIN cat c ON c.label = ok.label) WHERE w > 0 AND h > 0""", **_VLM)
def _(t):
    src = t.fx_vlm.join(t.fx_image.select("image_id", "file_name"), "image_id").select("file_name", F.lit(100).alias("width"), F.lit(80).alias("height"), "response")
    images, anns, _cats = convert.vlm_to_annotations(src)
    return anns.join(images.select("image_id", "frame_idx"), "image_id").select("ann_id", "image_id", "category_id", "frame_idx", "x", "y", "w", "h")


# Several detections per image for the whole chain from response to pixel boxes.
_CANON = [f"CASE WHEN {matches_sql('raw', repr(c))} THEN '{c}' END" for c in _CLASSES]
_STEP = "struct_pack(slot := {s}, id := r.pred_id, label := r.label, score := r.score, x1 := r.x1, y1 := r.y1, x2 := r.x2, y2 := r.y2)"


def canonical_sql(det, min_iou):
    """Statement and parts that walk the detections `det` of an image in order and keep one of a place."""
    walk = f"""SELECT r.image_id, r.rk, [{_STEP.format(s='r.pred_id')}] AS kept FROM d_turn r WHERE rk = 1
          UNION ALL SELECT r.image_id, r.rk, CASE WHEN h IS NULL THEN list_append(w.kept, {_STEP.format(s='r.pred_id')})
                 WHEN r.score IS NOT NULL AND (h.score IS NULL OR r.score > h.score) THEN list_transform(w.kept, lambda k: CASE WHEN k.slot = h.slot THEN {_STEP.format(s='h.slot')} ELSE k END)
                 ELSE w.kept END
          FROM (SELECT w.kept, q AS r, list_filter(w.kept, lambda k: k.label <> q.label AND {iou_sql('q', 'k')} >= {min_iou})[1] AS h
                FROM d_walk w JOIN d_turn q ON q.image_id = w.image_id AND q.rk = w.rk + 1) w"""
    parts = {"det": f"SELECT *, coalesce({', '.join(_CANON)}) AS label FROM ({det})",
             "d_turn": "SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY pred_id) AS rk FROM det WHERE label IS NOT NULL", "d_walk": walk}
    return """
    SELECT image_id, unnest.label AS label, round_even(unnest.x1 * 640 / 1000, 0) AS x1, round_even(unnest.y1 * 480 / 1000, 0) AS y1, round_even(unnest.x2 * 640 / 1000, 0) AS x2, round_even(unnest.y2 * 480 / 1000, 0) AS y2
    FROM (SELECT image_id, unnest(arg_max(kept, rk)) AS unnest FROM d_walk GROUP BY image_id)""", parts


_RAW = "SELECT image_id, pred_id, CASE category_id WHEN 0 THEN 'Exit_Sign' WHEN 1 THEN 'ceiling light' WHEN 2 THEN 'a map on the wall' ELSE 'robot' END AS raw, CASE WHEN confidence > 0.2 THEN confidence END AS score, trunc(x1) AS x1, trunc(y1) AS y1, trunc(x2) AS x2, trunc(y2) AS y2 FROM fx_pred"
_CANON_SQL, _CANON_PARTS = canonical_sql(_RAW, 0.6)


@query("canonical_vlm_boxes", _CANON_SQL, recursive=True, **_CANON_PARTS)
def _(t):
    # The response of an image lists its detections in pred_id order.
    item = F.concat(F.lit('{"label": "'), F.expr("CASE category_id WHEN 0 THEN 'Exit_Sign' WHEN 1 THEN 'ceiling light' WHEN 2 THEN 'a map on the wall' ELSE 'robot' END"),
                    F.lit('", "box_2d": ['), F.array_join(F.array(*[F.col(c).cast("int").cast("string") for c in ("y1", "x1", "y2", "x2")]), ", "),
                    F.lit('], "score": '), F.when(F.col("confidence") > 0.2, F.col("confidence").cast("string")).otherwise("null"), F.lit("}"))
    docs = datasets.bounded_lists(t.fx_pred.select("image_id", "pred_id", item.alias("item")), ["image_id"], ["pred_id"], F.col("item"), "items")
    resp = docs.select("image_id", F.col("chunk").alias("document"), F.concat(F.lit("[\n"), F.array_join("items", ", "), F.lit("]")).alias("response"))
    got = responses.canonical_boxes(resp, t.fx_image, _CLASSES, "yxyx", 0.6)
    return got.select("image_id", "label", "x1", "y1", "x2", "y2")


_CO = sql6("c")
_LAB = "SELECT stem, line_num, len(tok) = 5 AS det, tok, list_transform(tok[2:], lambda v: TRY_CAST(v AS DOUBLE)) AS c FROM (SELECT *, regexp_split_to_array(trim(line), '\\s+') AS tok FROM fx_label_line)"
_OKL = "regexp_full_match(tok[1], '[+-]?[0-9]+') AND len(c) >= 4"


def _labels(t):
    return convert.parse_labels(t.fx_label_line)


@query("flip_horizontal", f"""SELECT stem, line_num, {_CO} AS coords FROM (SELECT stem, line_num, CASE WHEN det THEN [1.0 - c[1]] || c[2:] ELSE list_transform(c, lambda v, i: CASE WHEN i % 2 = 1 THEN 1.0 - v ELSE v END) END AS c
    FROM lab WHERE {_OKL})""", lab=_LAB)
def _(t):
    return convert.flip_labels(_labels(t), "h").select("stem", "line_num", text6(F.col("coords")).alias("coords"))


@query("flip_vertical", f"""SELECT stem, line_num, {_CO} AS coords FROM (SELECT stem, line_num, CASE WHEN det THEN c[1:1] || [1.0 - c[2]] || c[3:] ELSE list_transform(c, lambda v, i: CASE WHEN i % 2 = 0 THEN 1.0 - v ELSE v END) END AS c
    FROM lab WHERE {_OKL})""", lab=_LAB)
def _(t):
    return convert.flip_labels(_labels(t), "v").select("stem", "line_num", text6(F.col("coords")).alias("coords"))


_RX, _RY = "cs * {x} + sn * {y} + (1 - cs) * 320 - sn * 240", "-sn * {x} + cs * {y} + sn * 320 + (1 - cs) * 240"
_CORNERS = [("b[1]", "b[2]"), ("b[3]", "b[2]"), ("b[3]", "b[4]"), ("b[1]", "b[4]")]
_EXTENT = ", ".join(f"least({top}.0::DOUBLE, greatest(0::DOUBLE, {pick}({', '.join(r.format(x=x, y=y) for x, y in _CORNERS)})))"
                    for pick, r, top in (("least", _RX, 640), ("least", _RY, 480), ("greatest", _RX, 640), ("greatest", _RY, 480)))
_AREA = "abs(list_sum(list_transform(range(1, len({p}) // 2 + 1), lambda i: {p}[2 * i - 1] * {p}[2 * i % len({p}) + 2] - {p}[2 * i % len({p}) + 1] * {p}[2 * i]))) / 2"


@query("rotate_labels", f"""
    SELECT stem, line_num, CASE WHEN det THEN 'det' ELSE 'seg' END AS kind, class_id, {sql6("CASE WHEN det THEN [(e[1] + e[3]) / 2 / 640, (e[2] + e[4]) / 2 / 480, (e[3] - e[1]) / 640, (e[4] - e[2]) / 480] || c[5:] ELSE list_transform(rot, lambda v, i: round_even(v / CASE WHEN i % 2 = 1 THEN 640 ELSE 480 END, 6)) END")} AS coords
    FROM turned WHERE CASE WHEN det THEN e[3] > e[1] AND e[4] > e[2] AND coalesce((e[3] - e[1]) * (e[4] - e[2]) / nullif((b[3] - b[1]) * (b[4] - b[2]), 0) >= 0.01, true)
      ELSE coalesce({_AREA.format(p='rot')} / nullif({_AREA.format(p='px')}, 0) >= 0.01, true) END""", lab=_LAB,
       placed=f"""SELECT stem, line_num, det, c, TRY_CAST(tok[1] AS BIGINT) AS class_id, cos(radians((line_num % 7) * 10.0::DOUBLE - 30)) AS cs, sin(radians((line_num % 7) * 10.0::DOUBLE - 30)) AS sn,
          CASE WHEN det THEN [c[1] * 640 - c[3] * 640 / 2, c[2] * 480 - c[4] * 480 / 2, c[1] * 640 + c[3] * 640 / 2, c[2] * 480 + c[4] * 480 / 2] END AS b,
          CASE WHEN NOT det THEN list_transform(c, lambda v, i: v * CASE WHEN i % 2 = 1 THEN 640 ELSE 480 END) END AS px FROM lab WHERE {_OKL}""",
       turned=f"""SELECT *, CASE WHEN det THEN [{_EXTENT}] END AS e, CASE WHEN NOT det THEN list_transform(px, lambda v, i: CASE WHEN i % 2 = 1 THEN least(640::DOUBLE, greatest(0::DOUBLE, {_RX.format(x='v', y='px[i + 1]')}))
          ELSE least(480::DOUBLE, greatest(0::DOUBLE, {_RY.format(x='px[i - 1]', y='v')})) END) END AS rot FROM placed""")
def _(t):
    lab = _labels(t).withColumns({"width": F.lit(640), "height": F.lit(480), "angle": (F.col("line_num") % 7) * 10.0 - 30.0})
    return convert.rotate_labels(lab).select("stem", "line_num", "kind", "class_id", text6(F.col("coords")).alias("coords"))


@query("mosaic_labels", f"""
    SELECT m.image || '_mosaic' AS name, l.line_num, m.quadrant, {sql6("CASE WHEN det THEN [c[1] / 2 + dx, c[2] / 2 + dy, c[3] / 2, c[4] / 2] ELSE list_transform(c, lambda v, i: v / 2 + CASE WHEN i % 2 = 1 THEN dx ELSE dy END) END")} AS coords
    FROM (SELECT m[1] AS image, q::INT AS quadrant, m[q + 1] AS stem, (q % 2) * 0.5::DOUBLE AS dx, (q // 2) * 0.5::DOUBLE AS dy FROM (
            SELECT list(stem) OVER (ORDER BY stem ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS m FROM (SELECT image_id::VARCHAR AS stem FROM fx_image)), (SELECT unnest(range(4)) AS q) WHERE len(m) = 4) m
    JOIN lab l ON l.stem = m.stem WHERE {_OKL}""", lab=_LAB)
def _(t):
    stems = t.fx_image.select(F.col("image_id").cast("string").alias("stem"))
    return convert.mosaic_labels(stems, _labels(t)).select("name", "line_num", "quadrant", text6(F.col("coords")).alias("coords"))


@query("augmentation_plan", """
    SELECT stem, -1 AS copy, 'original' AS type, stem AS name, NULL::DOUBLE AS angle, NULL::DOUBLE AS factor FROM st
    UNION ALL SELECT stem, copy, type, stem || '_aug' || copy || '_' || type, CASE WHEN type = 'rotate' THEN -15::DOUBLE + u * 30::DOUBLE END, CASE WHEN type = 'contrast' THEN 0.7::DOUBLE + u * (1.3::DOUBLE - 0.7::DOUBLE) END
      FROM (SELECT stem, copy::INT AS copy, ['flip_horizontal', 'rotate', 'contrast'][(('0x' || substr(md5('5:' || stem || '/' || copy), 1, 8))::BIGINT % 3)::INT + 1] AS type,
        ('0x' || substr(md5('5:' || stem || '/' || copy), 9, 8))::BIGINT / 4294967296::DOUBLE AS u FROM st, (SELECT unnest(range(2)) AS copy))
    UNION ALL SELECT stem, -1, 'mosaic', stem || '_mosaic', NULL, NULL FROM (SELECT stem, lead(stem, 3) OVER (ORDER BY stem) AS z FROM st) WHERE z IS NOT NULL""",
       st="SELECT image_id::VARCHAR AS stem FROM fx_image")
def _(t):
    return convert.augmentation_plan(t.fx_image.select(F.col("image_id").cast("string").alias("stem")), ["flip_horizontal", "rotate", "mosaic", "contrast"], 2, seed=5)
