"""Matching between keyframes, densification, track ids and propagation."""

from pyspark.sql import functions as F

from framelark.operators import frames, matching, tracks
from framelark.operators.scale import cut
from framelark.plans.evaluation import iou_sql
from framelark.plans.registry import query, r6

V = ["video_id"]
BOX = ["x1", "y1", "x2", "y2"]
MAX_DIST = 40


def _boxes(t):
    return t.fx_keybox.select("video_id", "frame_idx", "category_id", F.col("ann_id").alias("id"), (F.col("x") + F.col("w") / 2).alias("cx"),
                              (F.col("y") + F.col("h") / 2).alias("cy"), "w", "h")


def _spans(t):
    return frames.anchor_spans(t.fx_keybox, t.fx_keybox, V)


def _matches(t):
    return tracks.match_spans(_boxes(t), _spans(t), V, MAX_DIST)


def _pairs(t):
    return tracks.span_pairs(_boxes(t), None, _matches(t), V)


def greedy_sql(group, pairs="cand"):
    """Walk candidate pairs of a group by (dist, a_id, b_id), carrying the used ends."""
    g = ", ".join(group)
    same = " AND ".join(f"r.{c} = w.{c}" for c in group)
    free = "NOT list_contains(w.ua, r.a_id) AND NOT list_contains(w.ub, r.b_id)"
    return {
        "g_turn": f"SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY dist, a_id, b_id) AS rk FROM {pairs}",
        "g_walk": f"""SELECT {g}, rk, a_id, b_id, dist, true AS took, [a_id] AS ua, [b_id] AS ub FROM g_turn WHERE rk = 1
            UNION ALL SELECT {", ".join("r." + c for c in group)}, r.rk, r.a_id, r.b_id, r.dist, {free},
              CASE WHEN {free} THEN list_append(w.ua, r.a_id) ELSE w.ua END, CASE WHEN {free} THEN list_append(w.ub, r.b_id) ELSE w.ub END
            FROM g_walk w JOIN g_turn r ON {same} AND r.rk = w.rk + 1""",
        "matches": f"SELECT {g}, a_id, b_id, dist FROM g_walk WHERE took",
    }


_GROUP = ["video_id", "a", "b", "category_id"]
_SQL = dict(
    kb="SELECT video_id, frame_idx, category_id, ann_id AS id, x + w / 2 AS cx, y + h / 2 AS cy, w, h FROM fx_keybox",
    spans="""SELECT * FROM (SELECT video_id, frame_idx AS a, lead(frame_idx) OVER (PARTITION BY video_id ORDER BY frame_idx) AS b
             FROM (SELECT DISTINCT video_id, frame_idx FROM fx_keybox)) WHERE b - a >= 2""",
    cand=f"""SELECT s.video_id, s.a, s.b, l.category_id, l.id AS a_id, r.id AS b_id, sqrt((l.cx - r.cx) * (l.cx - r.cx) + (l.cy - r.cy) * (l.cy - r.cy)) AS dist
             FROM spans s JOIN kb l ON l.video_id = s.video_id AND l.frame_idx = s.a JOIN kb r ON r.video_id = s.video_id AND r.frame_idx = s.b AND r.category_id = l.category_id
             WHERE sqrt((l.cx - r.cx) * (l.cx - r.cx) + (l.cy - r.cy) * (l.cy - r.cy)) <= {MAX_DIST}""",
    **greedy_sql(_GROUP),
)
_PAIRS = dict(
    **_SQL,
    prs="""SELECT m.video_id, m.a, m.b, m.a_id, m.b_id, l.cx AS acx, l.cy AS acy, l.w AS aw, l.h AS ah, r.cx AS bcx, r.cy AS bcy, r.w AS bw, r.h AS bh
           FROM matches m JOIN kb l ON l.id = m.a_id JOIN kb r ON r.id = m.b_id""",
)


@query("match_nearest_center", "SELECT video_id, a, b, category_id, a_id, b_id, round(dist, 6) AS dist FROM matches", recursive=True, **_SQL)
def _(t):
    return _matches(t).withColumn("dist", F.round("dist", 6))


@query("match_nearest_center_unmatched", """SELECT 'a' AS side, s.video_id, k.id FROM spans s JOIN kb k ON k.video_id = s.video_id AND k.frame_idx = s.a WHERE k.id NOT IN (SELECT a_id FROM matches)
    UNION ALL SELECT 'b', s.video_id, k.id FROM spans s JOIN kb k ON k.video_id = s.video_id AND k.frame_idx = s.b WHERE k.id NOT IN (SELECT b_id FROM matches)""", recursive=True, **_SQL)
def _(t):
    b, s, m = _boxes(t), _spans(t), _matches(t)
    left = lambda end: tracks.span_leftovers(b, s, m, V, end).select(F.lit(end).alias("side"), "video_id", "id")
    return left("a").unionByName(left("b"))


# Track ids that hold for three of the five objects; the rest pairs by distance.
_TRK = "CASE WHEN ann_id % 5 < 3 AND ann_id % 7 <> 0 THEN ann_id % 5 END"


@query("pair_anchor_boxes", f"""SELECT video_id, a, b, category_id, a_id, b_id, 'track' AS how FROM exact UNION ALL
    SELECT video_id, a, b, category_id, a_id, b_id, 'center' FROM matches""", recursive=True,
       kb=f"SELECT video_id, frame_idx, category_id, ann_id AS id, x + w / 2 AS cx, y + h / 2 AS cy, {_TRK} AS track_id FROM fx_keybox", spans=_SQL["spans"],
       exact="""SELECT s.video_id, s.a, s.b, l.category_id, l.id AS a_id, r.id AS b_id FROM spans s JOIN kb l ON l.video_id = s.video_id AND l.frame_idx = s.a
                JOIN kb r ON r.video_id = s.video_id AND r.frame_idx = s.b AND r.category_id = l.category_id AND r.track_id = l.track_id""",
       cand=_SQL["cand"] + " AND l.id NOT IN (SELECT a_id FROM exact) AND r.id NOT IN (SELECT b_id FROM exact)", **greedy_sql(_GROUP))
def _(t):
    b, s = _boxes(t).withColumn("ann_id", F.col("id")).withColumn("track_id", F.expr(_TRK)), _spans(t)
    at = lambda e: b.join(s.withColumn("frame_idx", F.col(e)), ["video_id", "frame_idx"])
    got = matching.pair_anchor_boxes(at("a"), at("b"), ["video_id", "a", "b"], MAX_DIST)
    return got.select("video_id", "a", "b", "category_id", "a_id", "b_id", "how")


_SIDES = "CASE WHEN {k} % 4 = 0 THEN NULL ELSE 200 + {k} * 7 % 400 END"


@query("match_distance", f"""SELECT ann_id, coalesce(greatest(CASE WHEN aw > 0 AND ah > 0 THEN 0.05::DOUBLE * least(aw, ah) END, CASE WHEN bw > 0 AND bh > 0 THEN 0.05::DOUBLE * least(bw, bh) END), 0) AS reach
    FROM (SELECT ann_id, {_SIDES.format(k='frame_idx')} AS aw, 300 AS ah, {_SIDES.format(k='ann_id')} AS bw, category_id * 250 AS bh FROM fx_keybox)""")
def _(t):
    rows = t.fx_keybox.select("ann_id", F.expr(_SIDES.format(k="frame_idx")).alias("aw"), F.lit(300).alias("ah"), F.expr(_SIDES.format(k="ann_id")).alias("bw"), (F.col("category_id") * 250).alias("bh"))
    return rows.select("ann_id", matching.match_distance(*[F.col(c) for c in ("aw", "ah", "bw", "bh")], 0.05).alias("reach"))


@query("one_sided_tracks", f"""SELECT video_id, a, b, track_id, CASE WHEN max(e) = 'a' THEN 'start' ELSE 'end' END AS side FROM (
      SELECT s.video_id, s.a, s.b, k.track_id, CASE WHEN k.frame_idx = s.a THEN 'a' ELSE 'b' END AS e FROM spans s
      JOIN (SELECT video_id, frame_idx, {_TRK} AS track_id FROM fx_keybox) k ON k.video_id = s.video_id AND k.frame_idx IN (s.a, s.b) WHERE k.track_id IS NOT NULL)
    GROUP BY ALL HAVING count(DISTINCT e) = 1""", spans=_SQL["spans"])
def _(t):
    b, s = _boxes(t).withColumn("ann_id", F.col("id")).withColumn("track_id", F.expr(_TRK)), _spans(t)
    at = lambda e: b.join(s.withColumn("frame_idx", F.col(e)), ["video_id", "frame_idx"])
    return matching.one_sided_tracks(at("a"), at("b"), ["video_id", "a", "b"])


# Measured steps: straight motion with a deterministic error, some of them missing, some jumps.
_STEP = """SELECT video_id, a, a_id, p, CASE WHEN (a_id * 7 + p) % 23 <> 0 THEN (bcx - acx) / (b - a) + ((a_id + p) % 5 - 2) * {e} + CASE WHEN (a_id + p) % 31 = 0 THEN 30 ELSE 0 END END AS dx,
    CASE WHEN (a_id * 7 + p) % 23 <> 0 THEN (bcy - acy) / (b - a) + ((a_id + 2 * p) % 3 - 1) * {e} END AS dy,
    (a_id % 3) * {e} AS cam_dx, 0 - (p % 2) * {e} AS cam_dy FROM """


def _steps(t, pairs):
    rows = pairs.withColumn("p", F.explode(F.sequence(F.col("a") + 1, F.col("b"))))
    half = F.lit(0.5)
    seen = (F.col("a_id") * 7 + F.col("p")) % 23 != 0
    jump = F.when((F.col("a_id") + F.col("p")) % 31 == 0, 30).otherwise(0)
    n = F.col("b") - F.col("a")
    return rows.select(
        "video_id", "a", "a_id", "p",
        F.when(seen, (F.col("bcx") - F.col("acx")) / n + ((F.col("a_id") + F.col("p")) % 5 - 2) * half + jump).alias("dx"),
        F.when(seen, (F.col("bcy") - F.col("acy")) / n + ((F.col("a_id") + 2 * F.col("p")) % 3 - 1) * half).alias("dy"),
        ((F.col("a_id") % 3) * half).alias("cam_dx"), (-(F.col("p") % 2) * half).alias("cam_dy"))


_STEPS = dict(
    steps=_STEP.format(e="0.5::DOUBLE") + "(SELECT *, unnest(range(a + 1, b + 1)) AS p FROM prs)",
    clamped="""SELECT s.*, p.b, p.acx, p.acy, p.aw, p.ah, p.bcx, p.bcy, p.bw, p.bh, s.dx IS NULL AS missing,
        cam_dx + (dx - cam_dx) * CASE WHEN m > lim AND m > 0 THEN lim / m ELSE 1.0 END AS sx, cam_dy + (dy - cam_dy) * CASE WHEN m > lim AND m > 0 THEN lim / m ELSE 1.0 END AS sy
        FROM (SELECT *, sqrt((dx - cam_dx) * (dx - cam_dx) + (dy - cam_dy) * (dy - cam_dy)) AS m FROM steps) s
        JOIN (SELECT *, 0.3 * least(aw, ah) AS lim FROM prs) p USING (video_id, a, a_id)""",
)


def _out(df):
    return df.select(*[c for c in df.columns if c not in BOX], *[r6(c, c) for c in BOX])


_CORNERS = "round({cx} - ({w}) / 2, 6) AS x1, round({cy} - ({h}) / 2, 6) AS y1, round({cx} + ({w}) / 2, 6) AS x2, round({cy} + ({h}) / 2, 6) AS y2"


@query("interpolate_linear", f"""SELECT video_id, a, b, a_id, p, 'linear' AS source, 0.15::DOUBLE AS confidence, {_CORNERS.format(cx='(acx + t * (bcx - acx))', cy='(acy + t * (bcy - acy))', w='aw + t * (bw - aw)', h='ah + t * (bh - ah)')}
    FROM (SELECT *, (p - a) / (b - a)::DOUBLE AS t FROM (SELECT *, unnest(range(a + 1, b)) AS p FROM prs))""", recursive=True, **_PAIRS)
def _(t):
    return _out(tracks.interpolate_linear(_pairs(t), V))


@query("clamp_step", "SELECT video_id, a_id, p, round(sx, 6) AS sx, round(sy, 6) AS sy FROM clamped WHERE NOT missing", recursive=True, **_PAIRS, **_STEPS)
def _(t):
    pairs = _pairs(t)
    j = _steps(t, pairs).join(pairs.select("video_id", "a", "a_id", "aw", "ah"), ["video_id", "a", "a_id"]).filter("dx is not null")
    sx, sy = tracks.clamp_step(F.col("dx"), F.col("dy"), F.lit(0.3) * F.least("aw", "ah"), F.col("cam_dx"), F.col("cam_dy"))
    return j.select("video_id", "a_id", "p", r6(sx, "sx"), r6(sy, "sy"))


_ANCH = "(CASE WHEN lost_at IS NULL THEN raw{x} + (p - a) / (b - a)::DOUBLE * (bc{x} - end{x}) WHEN p < lost_at THEN raw{x} ELSE rl{x} + (p - lost_at + 1) / (b - lost_at + 1)::DOUBLE * (bc{x} - kb{x} - rl{x}) + k{x} END)"


@query("interpolate_anchored", f"""
    SELECT video_id, a, b, a_id, p, 'flow' AS source, round(CASE WHEN lost_at IS NULL OR p < lost_at THEN 0.9 ELSE 0.35 END * (CASE WHEN lost_at IS NULL THEN b - a - 1 ELSE lost_at - a - 1 END / (b - a - 1)::DOUBLE), 3) AS confidence,
      {_CORNERS.format(cx=_ANCH.format(x='x'), cy=_ANCH.format(x='y'), w='aw + (p - a) / (b - a)::DOUBLE * (bw - aw)', h='ah + (p - a) / (b - a)::DOUBLE * (bh - ah)')}
    FROM (SELECT *, acx + coalesce(sum(sx) FILTER (lost_at IS NULL OR p < lost_at) OVER run, 0) AS rawx, acy + coalesce(sum(sy) FILTER (lost_at IS NULL OR p < lost_at) OVER run, 0) AS rawy,
            acx + coalesce(sum(sx) FILTER (lost_at IS NULL OR p < lost_at) OVER whole, 0) AS endx, acy + coalesce(sum(sy) FILTER (lost_at IS NULL OR p < lost_at) OVER whole, 0) AS endy,
            acx + coalesce(sum(sx - cam_dx) FILTER (p < lost_at) OVER whole, 0) AS rlx, acy + coalesce(sum(sy - cam_dy) FILTER (p < lost_at) OVER whole, 0) AS rly,
            sum(cam_dx) OVER run AS kx, sum(cam_dy) OVER run AS ky, sum(cam_dx) OVER whole AS kbx, sum(cam_dy) OVER whole AS kby
          FROM (SELECT *, min(CASE WHEN missing THEN p END) OVER (PARTITION BY video_id, a, a_id) AS lost_at FROM clamped)
          WINDOW run AS (PARTITION BY video_id, a, a_id ORDER BY p), whole AS (PARTITION BY video_id, a, a_id))
    WHERE p < b""", recursive=True, **_PAIRS, **_STEPS)
def _(t):
    pairs = _pairs(t)
    return _out(tracks.interpolate_anchored(pairs, _steps(t, pairs), V))


@query("smooth_kalman", f"""SELECT video_id, a, b, a_id, p, 'kalman' AS source,
      round(CASE WHEN missing THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END * (n_meas / greatest(1, b - a - 1)::DOUBLE), 3) AS confidence,
      {_CORNERS.format(cx='(x + t * (bcx - bkx - ex) + kx)', cy='(y + t * (bcy - bky - ey) + ky)', w='aw + t * (bw - aw)', h='ah + t * (bh - ah)')}
    FROM (SELECT *, (p - a) / (b - a)::DOUBLE AS t, max(CASE WHEN p = b THEN x END) OVER g AS ex, max(CASE WHEN p = b THEN y END) OVER g AS ey, max(CASE WHEN p = b THEN kx END) OVER g AS bkx,
            max(CASE WHEN p = b THEN ky END) OVER g AS bky, count(*) FILTER (NOT missing AND p < b) OVER g AS n_meas
          FROM filtered WHERE p > a WINDOW g AS (PARTITION BY video_id, a, a_id)) WHERE p < b""", recursive=True, **_PAIRS, **_STEPS,
       seen="""SELECT *, acx + sum(CASE WHEN missing THEN 0 ELSE sx END) OVER run - kx AS zx, acy + sum(CASE WHEN missing THEN 0 ELSE sy END) OVER run - ky AS zy
          FROM (SELECT *, sum(cam_dx) OVER run AS kx, sum(cam_dy) OVER run AS ky FROM clamped WHERE b - a >= 2 WINDOW run AS (PARTITION BY video_id, a, a_id ORDER BY p))
          WINDOW run AS (PARTITION BY video_id, a, a_id ORDER BY p)""",
       filtered="""SELECT DISTINCT video_id, a, b, a_id, a AS p, acx AS x, 0::DOUBLE AS u, acy AS y, 0::DOUBLE AS v, 10::DOUBLE AS pp, 0::DOUBLE AS c, 10::DOUBLE AS w, false AS missing, 0::DOUBLE AS kx, 0::DOUBLE AS ky, bcx, bcy, aw, ah, bw, bh FROM seen
          UNION ALL SELECT video_id, a, b, a_id, p, CASE WHEN missing THEN x + u ELSE x + u + k0 * (zx - (x + u)) END, CASE WHEN missing THEN u ELSE u + k1 * (zx - (x + u)) END,
            CASE WHEN missing THEN y + v ELSE y + v + k0 * (zy - (y + v)) END, CASE WHEN missing THEN v ELSE v + k1 * (zy - (y + v)) END,
            CASE WHEN missing THEN q ELSE q - k0 * q END, CASE WHEN missing THEN d ELSE d - k0 * d END, CASE WHEN missing THEN r ELSE r - k1 * d END, missing, kx, ky, bcx, bcy, aw, ah, bw, bh
          FROM (SELECT *, q / (q + 4) AS k0, d / (q + 4) AS k1 FROM (
            SELECT s.video_id, s.a, s.b, s.a_id, s.p, f.x, f.u, f.y, f.v, f.pp + 2 * f.c + f.w + 1 AS q, f.c + f.w AS d, f.w + 0.25 AS r, s.missing, s.zx, s.zy, s.kx, s.ky, s.bcx, s.bcy, s.aw, s.ah, s.bw, s.bh
            FROM filtered f JOIN seen s ON s.video_id = f.video_id AND s.a = f.a AND s.a_id = f.a_id AND s.p = f.p + 1))""")
def _(t):
    pairs = _pairs(t)
    return _out(tracks.smooth_kalman(pairs, _steps(t, pairs), V))


_LEFT = dict(lf="SELECT s.video_id, s.a, s.b, k.id AS a_id, k.cx, k.cy, k.w, k.h FROM spans s JOIN kb k ON k.video_id = s.video_id AND k.frame_idx = s.{e} WHERE k.id NOT IN (SELECT {e}_id FROM matches)",
             walk="""SELECT *, (a_id % 5 - 2) * 1.5::DOUBLE AS dx, (p % 3) * 0.75::DOUBLE + CASE WHEN (a_id + p) % 13 = 0 THEN 50 ELSE 0 END AS dy FROM (SELECT *, unnest(range(a + 1, b)) AS p FROM lf)""")


def _leftovers(t, end):
    left = tracks.span_leftovers(_boxes(t), _spans(t), _matches(t), V, end)
    rows = left.withColumn("p", F.explode(F.sequence(F.col("a") + 1, F.col("b") - 1)))
    jump = F.when((F.col("id") + F.col("p")) % 13 == 0, 50).otherwise(0)
    steps = rows.select("video_id", "a", F.col("id").alias("a_id"), "p", ((F.col("id") % 5 - 2) * F.lit(1.5)).alias("dx"), ((F.col("p") % 3) * F.lit(0.75) + jump).alias("dy"))
    return left, steps


def _extend_sql(order):
    k = "CASE WHEN sqrt(dx * dx + dy * dy) > lim AND dx * dx + dy * dy > 0 THEN lim / sqrt(dx * dx + dy * dy) ELSE 1.0 END"
    return f"""SELECT video_id, a, b, a_id, p, 'flow' AS source, 0.7::DOUBLE AS confidence, {_CORNERS.format(cx='(cx + mx)', cy='(cy + my)', w='w', h='h')} FROM (
      SELECT *, sum(dx * {k}) OVER o AS mx, sum(dy * {k}) OVER o AS my, max((sqrt(dx * dx + dy * dy) > greatest(w, h))::INT) OVER o AS lost
      FROM (SELECT *, 0.3 * least(w, h) AS lim FROM walk) WINDOW o AS (PARTITION BY video_id, a, a_id ORDER BY p {order})) WHERE lost = 0"""


@query("extend_unmatched", _extend_sql(""), recursive=True, **_SQL, lf=_LEFT["lf"].format(e="a"), walk=_LEFT["walk"])
def _(t):
    return _out(tracks.extend_unmatched(*_leftovers(t, "a"), V))


@query("extend_unmatched_backward", _extend_sql("DESC"), recursive=True, **_SQL, lf=_LEFT["lf"].format(e="b"), walk=_LEFT["walk"])
def _(t):
    return _out(tracks.extend_unmatched(*_leftovers(t, "b"), V, backward=True))


def _totals(t):
    return t.fx_keybox.groupBy("video_id").agg(F.max("frame_idx").alias("m")).select("video_id", (F.col("m") + 6).alias("total"))


@query("fill_tail", f"""SELECT video_id, id AS a_id, frame_idx + d AS p, 'hold' AS source, 0.4::DOUBLE AS confidence, {_CORNERS.format(cx='cx', cy='cy', w='w', h='h')}
    FROM (SELECT *, unnest(range(1, 6)) AS d FROM kb WHERE frame_idx = (SELECT max(frame_idx) FROM kb z WHERE z.video_id = kb.video_id))""", kb=_SQL["kb"])
def _(t):
    return _out(tracks.fill_tail(_boxes(t), t.fx_keybox, _totals(t), V))


_LINK = dict(
    reach="""SELECT video_id, id, id AS head FROM kb WHERE id NOT IN (SELECT b_id FROM matches)
             UNION ALL SELECT r.video_id, m.b_id, r.head FROM reach r JOIN matches m ON m.a_id = r.id""",
    trk="""SELECT r.video_id, r.id, h.track_id FROM reach r JOIN (SELECT k.id, row_number() OVER (PARTITION BY k.video_id ORDER BY k.frame_idx, k.id) - 1 AS track_id
             FROM kb k JOIN reach z ON z.id = k.id AND z.head = k.id) h ON h.id = r.head""",
)


@query("link_tracks", "SELECT video_id, id, track_id FROM trk", recursive=True, **_SQL, **_LINK)
def _(t):
    return tracks.link_tracks(_boxes(t), _matches(t), V)


@query("densify_tracks", """
    SELECT d.video_id, row_number() OVER (PARTITION BY d.video_id ORDER BY p, stage, a_id) AS ann_id, p AS frame_idx, k.category_id, trk.track_id,
      round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, round((x2 - x1) * (y2 - y1), 4) AS area, source, confidence
    FROM (SELECT video_id, a_id, p, greatest(0, least(cx - w / 2, 400)) AS x1, greatest(0, least(cy - h / 2, 240)) AS y1, greatest(0, least(cx + w / 2, 400)) AS x2, greatest(0, least(cy + h / 2, 240)) AS y2, source, confidence, stage FROM (
        SELECT video_id, id AS a_id, frame_idx AS p, cx, cy, w, h, 'keyframe' AS source, 1.0::DOUBLE AS confidence, 0 AS stage FROM kb
        UNION ALL SELECT video_id, a_id, p, acx + t * (bcx - acx), acy + t * (bcy - acy), aw + t * (bw - aw), ah + t * (bh - ah), 'linear', 0.15, 1 FROM (SELECT *, (p - a) / (b - a)::DOUBLE AS t FROM (SELECT *, unnest(range(a + 1, b)) AS p FROM prs))
        UNION ALL SELECT video_id, id, frame_idx + unnest(range(1, 6)), cx, cy, w, h, 'hold', 0.4, 2 FROM kb WHERE frame_idx = (SELECT max(frame_idx) FROM kb z WHERE z.video_id = kb.video_id))) d
    JOIN kb k ON k.id = d.a_id JOIN trk ON trk.id = d.a_id WHERE x2 > x1 AND y2 > y1""", recursive=True, **_PAIRS, **_LINK)
def _(t):
    b, m = _boxes(t), cut(_matches(t))
    linear = tracks.interpolate_linear(tracks.span_pairs(b, None, m, V), V)
    hold = tracks.fill_tail(b, t.fx_keybox, _totals(t), V)
    sizes = t.fx_keybox.select("video_id").distinct().withColumns({"width": F.lit(400), "height": F.lit(240)})
    d = tracks.densify_tracks(b, _spans(t), m, [linear, hold], tracks.link_tracks(b, m, V), sizes, V)
    return _out(d).withColumn("area", F.round("area", 4))


# Every sixth box has one of four given ids, so that lanes clash.
@query("inherit_track_ids", """
    SELECT w.session, w.side, w.frame_idx, w.ann_id, coalesce(n.track_id, w.given) AS track_id FROM walk w
    LEFT JOIN (SELECT session, ann_id, row_number() OVER (PARTITION BY session ORDER BY ann_id) + (SELECT coalesce(max(preset), 0) FROM drawn d WHERE d.session = walk.session) AS track_id
               FROM walk WHERE given = -ann_id) n ON n.session = w.session AND n.ann_id = -w.given""", recursive=True,
       drawn="SELECT video_id AS session, CASE WHEN category_id = 0 THEN 'left' ELSE 'right' END AS side, frame_idx, ann_id, CASE WHEN ann_id % 6 = 0 THEN 1 + (ann_id // 6) % 4 END AS preset FROM fx_keybox",
       turn="SELECT *, row_number() OVER (PARTITION BY session, side ORDER BY frame_idx, ann_id) AS rk FROM drawn",
       walk="""SELECT session, side, frame_idx, ann_id, rk, coalesce(preset, -ann_id) AS given, []::BIGINT[] AS ref, [coalesce(preset, -ann_id)] AS now FROM turn WHERE rk = 1
         UNION ALL SELECT session, side, frame_idx, ann_id, rk, given, ref, list_append(now, given) FROM (
           SELECT *, coalesce(preset, CASE WHEN NOT list_contains(now, ref[len(now) + 1]) THEN ref[len(now) + 1] END, -ann_id) AS given FROM (
             SELECT t.session, t.side, t.frame_idx, t.ann_id, t.rk, t.preset, CASE WHEN t.frame_idx = w.frame_idx THEN w.ref ELSE w.now END AS ref, CASE WHEN t.frame_idx = w.frame_idx THEN w.now ELSE [] END AS now
             FROM walk w JOIN turn t ON t.session = w.session AND t.side = w.side AND t.rk = w.rk + 1))""")
def _(t):
    given = F.when(F.col("ann_id") % 6 == 0, 1 + F.floor(F.col("ann_id") / 6) % 4).cast("long")
    b = t.fx_keybox.select(F.col("video_id").alias("session"), F.when(F.col("category_id") == 0, "left").otherwise("right").alias("side"), "frame_idx", "ann_id", given.alias("track_id"))
    return tracks.inherit_track_ids(b)


_CANDS = "SELECT video_id, CAST(frame_idx / 5 AS BIGINT) AS frame_idx, ann_id AS cand_id, x AS x1, y AS y1, x + w AS x2, y + h AS y2 FROM fx_keybox"


@query("propagate_chain", f"""SELECT video_id, seed_id, frame_idx, cand_id, x1, y1, x2, y2 FROM chain WHERE frame_idx > 0""", recursive=True, cands=_CANDS,
       succ=f"""SELECT l.cand_id AS c, arg_max(r.cand_id, struct_pack(v := {iou_sql('l', 'r')}, i := -r.cand_id)) AS s FROM cands l JOIN cands r ON r.video_id = l.video_id AND r.frame_idx = l.frame_idx + 1
                WHERE {iou_sql('l', 'r')} >= 0.3 GROUP BY 1""",
       chain=f"""SELECT video_id, cand_id AS seed_id, frame_idx, cand_id, x1, y1, x2, y2, x1 AS sx1, y1 AS sy1, x2 AS sx2, y2 AS sy2 FROM cands WHERE frame_idx = 0
          UNION ALL SELECT c.video_id, c.seed_id, n.frame_idx, n.cand_id, n.x1, n.y1, n.x2, n.y2, c.sx1, c.sy1, c.sx2, c.sy2 FROM chain c JOIN succ ON succ.c = c.cand_id JOIN cands n ON n.cand_id = succ.s
          WHERE {iou_sql('n', 'z').replace('z.x1', 'c.sx1').replace('z.y1', 'c.sy1').replace('z.x2', 'c.sx2').replace('z.y2', 'c.sy2')} >= 0.2""")
def _(t):
    cands = t.sql(_CANDS)
    seeds = cands.filter("frame_idx = 0").withColumnRenamed("cand_id", "seed_id")
    return tracks.propagate_chain(seeds, cands, V)


@query("apply_propagated", """SELECT video_id, frame_idx, track_id, min(ann_id) AS ann_id FROM (SELECT video_id, frame_idx + 1 AS frame_idx, ann_id % 5 AS track_id, ann_id, w, h FROM fx_keybox) p WHERE w >= 32 AND h >= 2
      AND NOT EXISTS (SELECT 1 FROM fx_keybox k WHERE k.video_id = p.video_id AND k.frame_idx + ann_id % 3 = p.frame_idx AND k.ann_id % 5 = p.track_id) GROUP BY ALL""")
def _(t):
    src = t.fx_keybox.select("video_id", (F.col("frame_idx") + 1).alias("frame_idx"), (F.col("ann_id") % 5).alias("track_id"), "ann_id", F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"),
                             F.when(F.col("w") >= 32, F.col("w")).otherwise(1.0).alias("x2"), F.col("h").alias("y2"))
    live = t.fx_keybox.select("video_id", (F.col("frame_idx") + F.col("ann_id") % 3).alias("frame_idx"), (F.col("ann_id") % 5).alias("track_id"))
    return tracks.apply_propagated(src, live, ["video_id", "frame_idx"]).select("video_id", "frame_idx", "track_id", "ann_id")


@query("apply_interpolated", """SELECT video_id, p AS frame_idx, min(a_id) AS job FROM (SELECT *, unnest(range(a + 1, b)) AS p FROM prs) z
    WHERE NOT EXISTS (SELECT 1 FROM fx_keybox k WHERE k.video_id = z.video_id AND k.frame_idx + ann_id % 3 = z.p) GROUP BY ALL""", recursive=True, **_PAIRS)
def _(t):
    rows = tracks.interpolate_linear(_pairs(t), V).select("video_id", F.col("p").alias("frame_idx"), F.col("a_id").alias("job"), *BOX)
    live = t.fx_keybox.select("video_id", (F.col("frame_idx") + F.col("ann_id") % 3).alias("frame_idx"))
    return tracks.apply_interpolated(rows, live, V).select("video_id", "frame_idx", "job")


@query("compose_motion", """SELECT video_id, a, a_id, p, floor((m0 * acx + m1 * acy + m2) * 1000 + 0.33371923)::BIGINT AS cam_x, floor((m3 * acx + m4 * acy + m5) * 1000 + 0.33371923)::BIGINT AS cam_y FROM moved WHERE p > a""",
       recursive=True, **_PAIRS,
       moved="""SELECT video_id, a, b, a_id, acx, acy, a AS p, 1::DOUBLE AS m0, 0::DOUBLE AS m1, 0::DOUBLE AS m2, 0::DOUBLE AS m3, 1::DOUBLE AS m4, 0::DOUBLE AS m5 FROM prs
         UNION ALL SELECT video_id, a, b, a_id, acx, acy, p, n0 * m0 + n1 * m3, n0 * m1 + n1 * m4, n0 * m2 + n1 * m5 + n2, n3 * m0 + m3, n3 * m1 + m4, n3 * m2 + m5 + n5
         FROM (SELECT * REPLACE (p + 1 AS p), 1 + ((p + 1) % 3) * 0.01::DOUBLE AS n0, (a_id % 2) * 0.01::DOUBLE AS n1, ((p + 1) % 5)::DOUBLE AS n2, -((p + 1) % 2) * 0.01::DOUBLE AS n3, (a_id % 4)::DOUBLE AS n5
               FROM moved WHERE p < b)""")
def _(t):
    pairs = _pairs(t)
    e = F.lit(0.01)
    rows = pairs.withColumn("p", F.explode(F.sequence(F.col("a") + 1, F.col("b"))))
    one, zero = F.lit(1.0), F.lit(0.0)
    m = F.array(one + (F.col("p") % 3) * e, (F.col("a_id") % 2) * e, (F.col("p") % 5) * one, zero - (F.col("p") % 2) * e, one, (F.col("a_id") % 4) * one, zero, zero, one)
    keys = ["video_id", "a", "a_id"]
    got = tracks.compose_motion(rows.select(*keys, "p", m.alias("m")), pairs.select(*keys, F.col("acx").alias("cx"), F.col("acy").alias("cy")), keys)
    # Thousandths, cut where no short decimal lies: the order of the products shows in the last digits.
    milli = lambda c: F.floor(F.col(c) * 1000 + 0.33371923).cast("bigint").alias(c)
    return got.select(*keys, "p", milli("cam_x"), milli("cam_y"))
