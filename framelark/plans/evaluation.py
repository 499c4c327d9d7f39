"""Overlap, matching, suppression and scores on the derived boxes."""

from pyspark.sql import functions as F

from framelark.operators import evaluate, matching, suppress
from framelark.plans.registry import query, r6

BOX = ["x1", "y1", "x2", "y2"]


def iou_sql(a, b):
    """Overlap of two aliased boxes, areas clamped at 0 (equal to plain areas for proper boxes)."""
    inter = (
        f"greatest(0.0::DOUBLE, least({a}.x2,{b}.x2)-greatest({a}.x1,{b}.x1))"
        f"*greatest(0.0::DOUBLE, least({a}.y2,{b}.y2)-greatest({a}.y1,{b}.y1))"
    )
    union = (
        f"(greatest(0.0::DOUBLE,{a}.x2-{a}.x1)*greatest(0.0::DOUBLE,{a}.y2-{a}.y1)"
        f"+greatest(0.0::DOUBLE,{b}.x2-{b}.x1)*greatest(0.0::DOUBLE,{b}.y2-{b}.y1)-{inter})"
    )
    return f"(CASE WHEN {union} > 0 THEN {inter} / {union} ELSE 0.0::DOUBLE END)"


# Candidates per prediction in order of preference, then one step per prediction of an image.
MATCH = dict(
    cand=f"""SELECT p.pred_id, list(struct_pack(a := g.ann_id, c := g.category_id, v := {iou_sql('p','g')})
                ORDER BY {iou_sql('p','g')} DESC, g.ann_id) AS cs
             FROM fx_pred p JOIN fx_gt g ON p.image_id = g.image_id AND {iou_sql('p','g')} >= 0.5 GROUP BY p.pred_id""",
    turn="""SELECT p.image_id, p.pred_id, p.category_id AS pc, coalesce(c.cs, []) AS cs,
                row_number() OVER (PARTITION BY p.image_id ORDER BY p.pred_id) AS rk
            FROM fx_pred p LEFT JOIN cand c ON c.pred_id = p.pred_id""",
    walk="""SELECT image_id, rk, pred_id, pc, cs[1] AS pick,
                CASE WHEN len(cs) > 0 THEN [cs[1].a] ELSE CAST([] AS BIGINT[]) END AS used FROM turn WHERE rk = 1
            UNION ALL
            SELECT t.image_id, t.rk, t.pred_id, t.pc, list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))[1],
                CASE WHEN len(list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))) > 0
                     THEN list_append(w.used, list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))[1].a)
                     ELSE w.used END
            FROM walk w JOIN turn t ON t.image_id = w.image_id AND t.rk = w.rk + 1""",
    outcomes="""SELECT image_id, CASE WHEN pick IS NULL THEN 'fp' WHEN pick.c = pc THEN 'tp' ELSE 'mismatch' END AS outcome,
                  pred_id, pick.a AS ann_id, pc AS pred_class, pick.c AS gt_class, pick.v AS iou FROM walk
                UNION ALL
                SELECT g.image_id, 'fn', NULL, g.ann_id, NULL, g.category_id, NULL FROM fx_gt g
                WHERE NOT EXISTS (SELECT 1 FROM walk w WHERE w.pick.a = g.ann_id)""",
)

RATIOS = """CASE WHEN tp + fp > 0 THEN round(tp / CAST(tp + fp AS DOUBLE), 6) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn > 0 THEN round(tp / CAST(tp + fn AS DOUBLE), 6) ELSE 0.0 END AS recall"""


@query("iou_join", f"""
    SELECT p.image_id, p.pred_id, g.ann_id, round({iou_sql('p','g')}, 6) AS iou
    FROM fx_pred p JOIN fx_gt g ON p.image_id = g.image_id WHERE {iou_sql('p','g')} >= 0.5""")
def _(t):
    p = t.fx_pred.select("image_id", "pred_id", *BOX)
    g = t.fx_gt.select("image_id", "ann_id", *BOX)
    got = matching.iou_join(p, g, ["image_id"], 0.5)
    return got.select("image_id", F.col("l_pred_id").alias("pred_id"), F.col("r_ann_id").alias("ann_id"), r6("iou", "iou"))


@query("match_predictions",
       "SELECT image_id, outcome, pred_id, ann_id, pred_class, gt_class, round(iou, 6) AS iou FROM outcomes",
       recursive=True, **MATCH)
def _(t):
    return matching.match_predictions(t.fx_pred, t.fx_gt).withColumn("iou", F.round("iou", 6))


@query("detection_scores", f"""
    SELECT *, CASE WHEN precision + recall > 0 THEN round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) ELSE 0.0 END AS f1
    FROM (SELECT *, {RATIOS} FROM (
      SELECT count(*) FILTER (outcome = 'tp') AS tp, count(*) FILTER (outcome IN ('fp', 'mismatch')) AS fp,
             count(*) FILTER (outcome = 'fn') AS fn FROM outcomes))""", recursive=True, **MATCH)
def _(t):
    evaluate.require_rows(predictions=t.fx_pred, ground_truth=t.fx_gt)
    s = evaluate.detection_scores(matching.match_predictions(t.fx_pred, t.fx_gt))
    return s.select("tp", "fp", "fn", r6("precision", "precision"), r6("recall", "recall"), r6("f1", "f1"))


@query("per_class_scores", f"""
    SELECT *, {RATIOS} FROM (
      SELECT class_id, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM (
        SELECT pred_class AS class_id, (outcome = 'tp')::INT AS tp, (outcome <> 'tp')::INT AS fp, 0 AS fn
        FROM outcomes WHERE pred_id IS NOT NULL
        UNION ALL SELECT gt_class, 0, 0, 1 FROM outcomes WHERE outcome IN ('fn', 'mismatch')) GROUP BY class_id)""",
       recursive=True, **MATCH)
def _(t):
    s = evaluate.per_class_scores(matching.match_predictions(t.fx_pred, t.fx_gt))
    return s.select("class_id", "tp", "fp", "fn", r6("precision", "precision"), r6("recall", "recall"))


@query("confusion_matrix", """
    SELECT gt_class, pred_class, count(*) AS n FROM outcomes WHERE outcome IN ('tp', 'mismatch') GROUP BY ALL""",
       recursive=True, **MATCH)
def _(t):
    return evaluate.confusion_matrix(matching.match_predictions(t.fx_pred, t.fx_gt))


@query("assign_exclusive", """
    SELECT image_id, input_id, pick.a AS det_id, round(pick.v, 6) AS iou FROM walk""", recursive=True,
       **{**{k: v.replace("0.5", "0.1").replace(">=", ">") for k, v in MATCH.items() if k == "cand"},
          "turn": MATCH["turn"], "walk0": "SELECT 1", "walk": MATCH["walk"].replace(" pred_id,", " pred_id AS input_id,").replace("t.pred_id,", "t.pred_id,")})
def _(t):
    inputs = t.fx_pred.select("image_id", F.col("pred_id").alias("input_id"), *BOX)
    dets = t.fx_gt.select("image_id", F.col("ann_id").alias("det_id"), *BOX)
    return matching.assign_exclusive(inputs, dets).select("image_id", "input_id", "det_id", r6("iou", "iou"))


@query("assign_best", f"""
    SELECT i.image_id, i.category_id, i.input_id, d.ann_id AS chosen_id, coalesce(d.area, k.area, 0.0) AS area,
           coalesce(d.area, k.area, 0.0) > 0 AS success
    FROM ins i
    LEFT JOIN (SELECT p.pred_id, min_by(struct_pack(ann_id := g.ann_id, area := g.mask_area),
                 struct_pack(n := -{iou_sql('p','g')}, d := g.ann_id)) AS b
               FROM fx_pred p JOIN dets g ON p.image_id = g.image_id AND p.category_id = g.category_id GROUP BY 1) c
      ON c.pred_id = i.input_id
    LEFT JOIN LATERAL (SELECT c.b.ann_id AS ann_id, c.b.area AS area) d ON true
    LEFT JOIN (SELECT image_id, category_id, mask_area AS area, rk FROM dets) k
      ON k.image_id = i.image_id AND k.category_id = i.category_id AND k.rk = i.rk""",
       dets="""SELECT *, CASE WHEN x2 - x1 > 50 THEN NULL WHEN x2 - x1 > 40 THEN 0.0
                 ELSE (x2 - x1) * (y2 - y1) END AS mask_area,
                 row_number() OVER (PARTITION BY image_id, category_id ORDER BY ann_id) AS rk FROM fx_gt""",
       ins="""SELECT image_id, category_id, pred_id AS input_id,
                 row_number() OVER (PARTITION BY image_id, category_id ORDER BY pred_id) AS rk FROM fx_pred""")
def _(t):
    inputs = t.fx_pred.select("image_id", "category_id", F.col("pred_id").alias("input_id"), *BOX)
    area = F.when(F.col("x2") - F.col("x1") > 50, None).when(F.col("x2") - F.col("x1") > 40, 0.0).otherwise(
        (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    dets = t.fx_gt.select("image_id", "category_id", F.col("ann_id").alias("det_id"), *BOX, area.alias("mask_area"))
    return matching.assign_best(inputs, dets, ["image_id", "category_id"])


# --- suppression ---------------------------------------------------------------------------------


def nms_walk(keys, src="fx_pred", t="0.5", name="n", order="confidence DESC, pred_id"):
    """Greedy suppression one box at a time, carrying the kept boxes of the group."""
    k = ", ".join(keys)
    same = " AND ".join(f"r.{c} = w.{c}" for c in keys)
    hit = f"len(list_filter(w.kept, lambda k: {iou_sql('r', 'k')} > {t})) > 0"
    me = "struct_pack(x1 := {0}x1, y1 := {0}y1, x2 := {0}x2, y2 := {0}y2)"
    return {
        f"{name}_turn": f"SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {order}) AS rk FROM {src}",
        f"{name}_walk": f"""SELECT {k}, rk, pred_id, true AS keep, [{me.format('')}] AS kept FROM {name}_turn WHERE rk = 1
            UNION ALL SELECT {", ".join('r.' + c for c in keys)}, r.rk, r.pred_id, NOT ({hit}),
              CASE WHEN {hit} THEN w.kept ELSE list_append(w.kept, {me.format('r.')}) END
            FROM {name}_walk w JOIN {name}_turn r ON {same} AND r.rk = w.rk + 1""",
    }


@query("nms_class_agnostic", "SELECT image_id, pred_id FROM n_walk WHERE keep", recursive=True, **nms_walk(["image_id"]))
def _(t):
    return suppress.nms(t.fx_pred, ["image_id"], 0.5).select("image_id", "pred_id")


@query("nms_class_aware", "SELECT image_id, pred_id FROM n_walk WHERE keep", recursive=True,
       **nms_walk(["image_id", "category_id"], t="0.7"))
def _(t):
    return suppress.nms(t.fx_pred, ["image_id", "category_id"], 0.7).select("image_id", "pred_id")


def _hit3(k):
    return f"{k}.label <> r.category_id AND {iou_sql('r', k)} >= 0.75"


_KEPT3 = ("struct_pack(slot := {s}, id := r.pred_id, label := r.category_id, score := r.confidence, "
          "x1 := r.x1, y1 := r.y1, x2 := r.x2, y2 := r.y2)")


@query("dedup_cross_class", """
    SELECT image_id, unnest.id AS pred_id, unnest.slot AS slot
    FROM (SELECT image_id, unnest(arg_max(kept, rk)) AS unnest FROM d_walk GROUP BY image_id)""", recursive=True,
       d_turn="SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY pred_id) AS rk FROM fx_pred",
       d_walk=f"""SELECT r.image_id, r.rk, [{_KEPT3.format(s='r.pred_id')}] AS kept FROM d_turn r WHERE rk = 1
          UNION ALL SELECT r.image_id, r.rk,
            CASE WHEN h IS NULL THEN list_append(w.kept, {_KEPT3.format(s='r.pred_id')})
                 WHEN r.confidence > h.score THEN
                   list_transform(w.kept, lambda k: CASE WHEN k.slot = h.slot THEN {_KEPT3.format(s='h.slot')} ELSE k END)
                 ELSE w.kept END
          FROM (SELECT w.image_id, w.rk, w.kept, q AS r, list_filter(w.kept, lambda k: {_hit3('k').replace('r.', 'q.')})[1] AS h
                FROM d_walk w JOIN d_turn q ON q.image_id = w.image_id AND q.rk = w.rk + 1) w""")
def _(t):
    items = t.fx_pred.select(
        "image_id", F.col("pred_id").alias("id"), F.col("category_id").alias("label"), F.col("confidence").alias("score"), *BOX)
    return suppress.dedup_cross_class(items).select("image_id", F.col("id").alias("pred_id"), "slot")


# --- insertion, AP, sweep ------------------------------------------------------------------------

_MIN2 = "greatest(0.0::DOUBLE, least({v}, {d}::DOUBLE))"
_ADDED = f"""SELECT image_id, category_id, pred_id, confidence, {_MIN2.format(v='x1', d='120')} AS x1, {_MIN2.format(v='y1', d='100')} AS y1,
               {_MIN2.format(v='x2', d='120')} AS x2, {_MIN2.format(v='y2', d='100')} AS y2
             FROM dets WHERE pred_id IN (SELECT pred_id FROM n_walk WHERE keep)"""


def _insert_inputs(t):
    none = F.col("confidence") < 0.05
    dets = t.fx_pred.select(
        "image_id", F.col("pred_id").alias("det_id"), F.when(~none, F.col("category_id")).alias("category_id"), "confidence", *BOX)
    existing = t.fx_gt.filter("x2 - x1 >= 45").select("image_id", "category_id", *BOX)
    images = t.fx_image.select("image_id", F.lit(120).alias("width"), F.lit(100).alias("height"))
    return dets, existing, images


@query("insert_detections", """
    SELECT d.image_id, d.pred_id AS det_id, d.category_id, round(d.confidence, 4) AS confidence,
      CASE WHEN d.category_id IS NULL THEN 'no_category' WHEN s.pred_id IS NULL THEN 'suppressed'
           WHEN s.x2 - s.x1 < 2 OR s.y2 - s.y1 < 2 THEN 'too_small' WHEN a.pred_id IS NOT NULL THEN 'added' ELSE 'duplicate' END AS status,
      CASE WHEN s.x2 - s.x1 < 2 OR s.y2 - s.y1 < 2 OR a.pred_id IS NOT NULL THEN s.x1 END AS x1,
      CASE WHEN s.x2 - s.x1 < 2 OR s.y2 - s.y1 < 2 OR a.pred_id IS NOT NULL THEN s.y1 END AS y1,
      CASE WHEN s.x2 - s.x1 < 2 OR s.y2 - s.y1 < 2 OR a.pred_id IS NOT NULL THEN s.x2 END AS x2,
      CASE WHEN s.x2 - s.x1 < 2 OR s.y2 - s.y1 < 2 OR a.pred_id IS NOT NULL THEN s.y2 END AS y2
    FROM dets d LEFT JOIN sized s ON s.pred_id = d.pred_id LEFT JOIN (SELECT pred_id FROM m_walk WHERE keep) a ON a.pred_id = d.pred_id""",
       recursive=True,
       dets="SELECT image_id, pred_id, CASE WHEN confidence >= 0.05 THEN category_id END AS category_id, confidence, x1, y1, x2, y2 FROM fx_pred",
       known="SELECT * FROM dets WHERE category_id IS NOT NULL",
       **nms_walk(["image_id", "category_id"], src="known"),
       sized=_ADDED,
       fresh=f"""SELECT * FROM sized s WHERE x2 - x1 >= 2 AND y2 - y1 >= 2 AND NOT EXISTS (SELECT 1 FROM fx_gt g
                  WHERE g.x2 - g.x1 >= 45 AND g.image_id = s.image_id AND g.category_id = s.category_id AND {iou_sql('s','g')} > 0.7)""",
       **nms_walk(["image_id", "category_id"], src="fresh", t="0.7", name="m"))
def _(t):
    return suppress.insert_detections(*_insert_inputs(t))


# One walk over the candidate pairs of a group, carrying the used ends.
AP_SQL = dict(
    thr="SELECT unnest([50, 55, 60, 65, 70, 75, 80, 85, 90, 95]) AS t",
    cand=f"""SELECT p.image_id, p.category_id, p.pred_id, p.confidence, list(struct_pack(a := g.ann_id, v := {iou_sql('p','g')})
               ORDER BY {iou_sql('p','g')} DESC, g.ann_id) AS cs
             FROM pr p JOIN fx_gt g ON p.image_id = g.image_id AND p.category_id = g.category_id AND {iou_sql('p','g')} >= 0.5 GROUP BY ALL""",
    turn="""SELECT image_id, category_id, pred_id, t, list_filter(cs, lambda c: c.v * 100 >= t) AS cs,
              row_number() OVER (PARTITION BY image_id, category_id, t ORDER BY confidence DESC, pred_id) AS rk
            FROM cand, thr WHERE len(list_filter(cs, lambda c: c.v * 100 >= t)) > 0""",
    walk="""SELECT image_id, category_id, t, rk, pred_id, true AS hit, [cs[1].a] AS used FROM turn WHERE rk = 1
            UNION ALL SELECT q.image_id, q.category_id, q.t, q.rk, q.pred_id,
              len(list_filter(q.cs, lambda c: NOT list_contains(w.used, c.a))) > 0,
              CASE WHEN len(list_filter(q.cs, lambda c: NOT list_contains(w.used, c.a))) > 0
                THEN list_append(w.used, list_filter(q.cs, lambda c: NOT list_contains(w.used, c.a))[1].a) ELSE w.used END
            FROM walk w JOIN turn q ON q.image_id = w.image_id AND q.category_id = w.category_id AND q.t = w.t AND q.rk = w.rk + 1""",
)


def ap_sql(by):
    b = "".join(f"{c}, " for c in by)
    pb = "".join(f"p.{c}, " for c in by)
    on = "".join(f" AND c.{c} = n.{c}" for c in by)
    return dict(
        cum=f"""SELECT {pb}p.category_id, p.t, coalesce(w.hit, false) AS hit,
                  sum(CASE WHEN w.hit THEN 1 ELSE 0 END) OVER z AS tp, count(*) OVER z AS n
                FROM (SELECT * FROM pr, thr) p LEFT JOIN walk w ON w.pred_id = p.pred_id AND w.t = p.t
                WINDOW z AS (PARTITION BY {pb}p.category_id, p.t ORDER BY p.confidence DESC, p.pred_id)""",
        npos=f"SELECT {b}category_id, count(*) AS npos FROM gts GROUP BY ALL",
        pts=f"""SELECT {"".join(f"c.{c}, " for c in by)}c.category_id, c.t, (c.tp * 100 // n.npos)::INT AS step, max(c.tp / c.n::DOUBLE) AS prec
                FROM cum c JOIN npos n ON n.category_id = c.category_id{on} WHERE c.hit GROUP BY ALL""",
        curve=f"""SELECT {b}category_id, t, r, max(prec) FILTER (step >= r) AS prec
                  FROM pts, (SELECT unnest(range(101)) AS r) GROUP BY ALL""",
        aps=f"SELECT {b}category_id, t, sum(coalesce(prec, 0)) / 101.0::DOUBLE AS ap FROM curve GROUP BY ALL",
        ap=f"""SELECT {"".join(f"n.{c}, " for c in by)}n.category_id, coalesce(max(c.ap) FILTER (c.t = 50), 0.0) AS ap50, coalesce(sum(c.ap) / 10, 0.0) AS ap50_95
               FROM npos n LEFT JOIN aps c ON c.category_id = n.category_id{on} GROUP BY ALL""",
    )


@query("average_precision", "SELECT category_id, round(ap50, 6) AS ap50, round(ap50_95, 6) AS ap50_95 FROM ap",
       recursive=True, pr="SELECT * FROM fx_pred", gts="SELECT * FROM fx_gt", **AP_SQL, **ap_sql([]))
def _(t):
    ap = evaluate.average_precision(t.fx_pred, t.fx_gt)
    return ap.select("category_id", r6("ap50", "ap50"), r6("ap50_95", "ap50_95"))


_SPLIT_GT = "SELECT g.*, i.split FROM fx_gt g JOIN fx_image i ON i.image_id = g.image_id"
_SPLIT_OUT = "SELECT o.*, i.split FROM outcomes o JOIN fx_image i ON i.image_id = o.image_id"


@query("metrics_table", f"""
    SELECT split, CASE WHEN class_id < 0 THEN 'all' ELSE class_id::VARCHAR END AS class_id,
      CASE WHEN class_id < 0 THEN 'all' ELSE coalesce(r_name, 'class_' || class_id) END AS class_name, instances,
      round(p, 6) AS precision, round(r, 6) AS recall, CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 6) ELSE 0.0 END AS f1,
      round(ap50, 6) AS ap50, round(ap50_95, 6) AS ap50_95, NULL::DOUBLE AS mask_precision, NULL::DOUBLE AS mask_recall,
      NULL::DOUBLE AS mask_f1, NULL::DOUBLE AS mask_ap50, NULL::DOUBLE AS mask_ap50_95
    FROM (SELECT c.split, c.class_id, coalesce(n.instances, 0) AS instances,
            CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END AS p,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END AS r,
            coalesce(a.ap50, 0.0) AS ap50, coalesce(a.ap50_95, 0.0) AS ap50_95
          FROM cls c
          LEFT JOIN (SELECT split, category_id, npos AS instances FROM npos
                     UNION ALL SELECT split, -1, sum(npos)::BIGINT FROM npos GROUP BY 1) n ON n.split = c.split AND n.category_id = c.class_id
          LEFT JOIN (SELECT * FROM ap UNION ALL SELECT split, -1, avg(ap50), avg(ap50_95) FROM ap GROUP BY 1) a
            ON a.split = c.split AND a.category_id = c.class_id)
    LEFT JOIN region ON r_regionkey = class_id""",
       recursive=True,
       pr="SELECT p.*, i.split FROM fx_pred p JOIN fx_image i ON i.image_id = p.image_id", gts=_SPLIT_GT,
       mcand=MATCH["cand"], mturn=MATCH["turn"].replace("JOIN cand", "JOIN mcand"),
       mwalk=MATCH["walk"].replace("turn", "mturn").replace("FROM walk", "FROM mwalk"),
       outcomes=MATCH["outcomes"].replace("walk", "mwalk"),
       outs=_SPLIT_OUT,
       cls="""SELECT split, class_id, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM (
                SELECT split, pred_class AS class_id, (outcome = 'tp')::INT AS tp, (outcome <> 'tp')::INT AS fp, 0 AS fn FROM outs WHERE pred_id IS NOT NULL
                UNION ALL SELECT split, gt_class, 0, 0, 1 FROM outs WHERE outcome IN ('fn', 'mismatch')
                UNION ALL SELECT split, -1, (outcome = 'tp')::INT, (outcome IN ('fp', 'mismatch'))::INT, (outcome = 'fn')::INT FROM outs) GROUP BY ALL""",
       **AP_SQL, **ap_sql(["split"]))
def _(t):
    split = t.fx_image.select("image_id", "split")
    classes = t.region.select(F.col("r_regionkey").alias("class_id"), F.col("r_name").alias("name"))
    m = evaluate.metrics_table(t.fx_pred.join(split, "image_id"), t.fx_gt.join(split, "image_id"), classes)
    for c in ("precision", "recall", "f1", "ap50", "ap50_95"):
        m = m.withColumn(c, F.round(c, 6))
    return m


_SWEEP = [(c, i) for c in (0.0, 0.25, 0.5, 0.75) for i in (0.5, 0.7, 0.9)]


@query("threshold_sweep", f"""
    SELECT *, CASE WHEN precision + recall > 0 THEN round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) ELSE 0.0 END AS f1
    FROM (SELECT *, {RATIOS} FROM (
      SELECT min_conf, min_iou, count(*) FILTER (pc = gc) AS tp, count(*) FILTER (pc IS DISTINCT FROM gc) AS fp,
        (SELECT count(*) FROM fx_gt) - count(gc) AS fn
      FROM (SELECT g.min_conf, g.min_iou, p.pred_id, p.category_id AS pc, w.pick.c AS gc FROM grid g JOIN fx_pred p ON p.confidence >= g.min_conf
            LEFT JOIN walk w ON w.min_conf = g.min_conf AND w.min_iou = g.min_iou AND w.pred_id = p.pred_id) GROUP BY ALL))""",
       recursive=True, grid=" UNION ALL ".join(f"SELECT {c}::DOUBLE AS min_conf, {i}::DOUBLE AS min_iou" for c, i in _SWEEP),
       cand=MATCH["cand"],
       turn="""SELECT p.image_id, p.pred_id, p.category_id AS pc, g.min_conf, g.min_iou, list_filter(c.cs, lambda x: x.v >= g.min_iou) AS cs,
                row_number() OVER (PARTITION BY p.image_id, g.min_conf, g.min_iou ORDER BY p.pred_id) AS rk
               FROM fx_pred p JOIN cand c ON c.pred_id = p.pred_id JOIN grid g ON p.confidence >= g.min_conf""",
       walk="""SELECT image_id, min_conf, min_iou, rk, pred_id, cs[1] AS pick,
                CASE WHEN len(cs) > 0 THEN [cs[1].a] ELSE CAST([] AS BIGINT[]) END AS used FROM turn WHERE rk = 1
            UNION ALL
            SELECT t.image_id, t.min_conf, t.min_iou, t.rk, t.pred_id, list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))[1],
                CASE WHEN len(list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))) > 0
                     THEN list_append(w.used, list_filter(t.cs, lambda x: NOT list_contains(w.used, x.a))[1].a) ELSE w.used END
            FROM walk w JOIN turn t ON t.image_id = w.image_id AND t.min_conf = w.min_conf AND t.min_iou = w.min_iou AND t.rk = w.rk + 1""")
def _(t):
    s = evaluate.threshold_sweep(t.fx_pred, t.fx_gt, [0.0, 0.25, 0.5, 0.75], [0.5, 0.7, 0.9])
    for c in ("precision", "recall", "f1"):
        s = s.withColumn(c, F.round(c, 6))
    return s
