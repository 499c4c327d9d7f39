"""Boxes between keyframes: interpolation, tracking of leftovers, track ids, propagation.

A pair is one object seen on both anchors of a span: keys, a, b (frame indexes), a_id, b_id, and the
centers and sizes acx, acy, aw, ah, bcx, bcy, bw, bh. Steps are measured displacements: keys, a, a_id, p,
dx, dy (NULL = nothing measured) and, with a camera model, its share cam_dx, cam_dy of the move.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.operators.matching import iou_join, match_nearest_center, unmatched
from framelark.operators.scale import Summary, cut, fold_in_order, ordinal, running, union_all

# Fixed confidences of generated boxes and the default clamp of one step.
CONF_LINEAR, CONF_FLOW, CONF_BRIDGE, CONF_MEASURED, CONF_GAP = 0.15, 0.9, 0.35, 0.9, 0.6
CONF_EXTEND, CONF_HOLD, MAX_STEP = 0.7, 0.4, 0.3
# Fixed overlaps of the chain: with the box before, and with the seed.
PREV_IOU, SEED_IOU = 0.3, 0.2

BOX = ["x1", "y1", "x2", "y2"]


def span_pairs(boxes: DataFrame, spans: DataFrame, matches: DataFrame, keys) -> DataFrame:
    """Pairs with both boxes. boxes: keys, frame_idx, id, cx, cy, w, h; matches: keys, a, b, a_id, b_id."""
    side = lambda p: boxes.select(*keys, F.col("id").alias(f"{p}_id"), *[F.col(c).alias(f"{p}{c}") for c in ("cx", "cy", "w", "h")])
    return matches.join(side("a"), [*keys, "a_id"]).join(side("b"), [*keys, "b_id"])


def match_spans(boxes: DataFrame, spans: DataFrame, keys, max_dist) -> DataFrame:
    """Nearest-center pairs of every span. boxes: keys, frame_idx, category_id, id, cx, cy."""
    by = [*keys, "a", "b", "category_id"]
    at = lambda p: boxes.join(spans.withColumn("frame_idx", F.col(p)), [*keys, "frame_idx"]).select(*by, "id", "cx", "cy")
    return match_nearest_center(at("a"), at("b"), by, max_dist)


def span_leftovers(boxes: DataFrame, spans: DataFrame, matches: DataFrame, keys, end="a") -> DataFrame:
    """Boxes on one end of a span without a partner: keys, a, b and the box columns."""
    side = boxes.join(spans.withColumn("frame_idx", F.col(end)), [*keys, "frame_idx"])
    return unmatched(side, matches, [*keys, "a", "b"], f"{end}_id")


def _interior(pairs, last):
    """One row per frame of a span from a + 1 to `last`, with t in (0, 1]."""
    rows = pairs.filter(F.col("b") - F.col("a") >= 2).withColumn("p", F.explode(F.sequence(F.col("a") + 1, last)))
    return rows.withColumn("t", (F.col("p") - F.col("a")) / (F.col("b") - F.col("a")))


def _lerp(a, b, t=None):
    t = F.col("t") if t is None else t
    return F.col(a) + t * (F.col(b) - F.col(a))


def _boxed(rows, keys, cx, cy, w, h, source, conf, ids=("a_id",)):
    c = geo.center_to_xyxy(cx, cy, w, h)
    return rows.select(*keys, "a", "b", *ids, "p", *[v.alias(n) for v, n in zip(c, BOX)],
                       F.lit(source).alias("source"), F.round(conf, 3).alias("confidence"))


def interpolate_linear(pairs: DataFrame, keys) -> DataFrame:
    """Center and size straight from one anchor to the other."""
    r = _interior(pairs, F.col("b") - 1)
    return _boxed(r, keys, _lerp("acx", "bcx"), _lerp("acy", "bcy"), _lerp("aw", "bw"), _lerp("ah", "bh"), "linear", F.lit(CONF_LINEAR))


def clamp_step(dx, dy, max_step, cam_dx=None, cam_dy=None):
    """Step shortened to `max_step`, direction kept; with camera motion only the residual is shortened."""
    cx = F.lit(0.0) if cam_dx is None else cam_dx
    cy = F.lit(0.0) if cam_dy is None else cam_dy
    rx, ry = dx - cx, dy - cy
    size = F.sqrt(rx * rx + ry * ry)
    k = F.when((size > max_step) & (size > 0), max_step / size).otherwise(F.lit(1.0))
    return cx + rx * k, cy + ry * k


def _with_steps(rows, steps, keys, size, frac):
    """Rows joined with their step: sx, sy (clamped), camera share mx, my, missing flag."""
    cam = [c for c in ("cam_dx", "cam_dy") if c in steps.columns]
    s = steps.select(*keys, "a", "a_id", "p", "dx", "dy", *cam)
    j = rows.join(s, [*keys, "a", "a_id", "p"], "left")
    zero = F.lit(0.0)
    mx = F.coalesce("cam_dx", zero) if cam else zero
    my = F.coalesce("cam_dy", zero) if cam else zero
    sx, sy = clamp_step(F.col("dx"), F.col("dy"), F.lit(frac) * size, mx, my)
    return j.withColumns({
        "mx": mx, "my": my, "sx": sx, "sy": sy, "missing": (F.col("dx").isNull() | F.col("dy").isNull()).cast("int"),
        "jump": F.sqrt(F.pow(F.col("dx") - mx, 2) + F.pow(F.col("dy") - my, 2)),
    })


def interpolate_anchored(pairs: DataFrame, steps: DataFrame, keys, frac=MAX_STEP) -> DataFrame:
    """Follow the measured steps from a and bend the path so that it ends on the box at b.

    Confidence 0.9 times the measured share of the interior. From the first missing step on, the path is
    bridged straight to b (relative to the camera) with 0.35 times that share.
    """
    keys = list(keys)
    group = [*keys, "a", "a_id"]
    inner = _interior(pairs, F.col("b"))
    rows = _with_steps(inner, steps, keys, F.least("aw", "ah"), frac)
    live = F.col("missing") == 0
    run = running(rows, group, ["p"], {
        "lost": ("max", F.col("missing")), "cx": ("sum", F.when(live, F.col("sx")).otherwise(0.0)),
        "cy": ("sum", F.when(live, F.col("sy")).otherwise(0.0)), "kx": ("sum", F.col("mx")), "ky": ("sum", F.col("my"))}, like=inner)
    ok = F.col("lost") == 0
    ends = run.groupBy(*group).agg(
        F.max("lost").alias("was_lost"), F.max(F.when(ok, F.col("p"))).alias("last_p"),
        F.sum(F.when(ok, F.col("sx"))).alias("ex"), F.sum(F.when(ok, F.col("sy"))).alias("ey"),
        F.count_if(ok & (F.col("p") < F.col("b"))).alias("n_meas"),
        F.sum(F.when(ok, F.col("mx"))).alias("lkx"), F.sum(F.when(ok, F.col("my"))).alias("lky"),
        F.sum("mx").alias("bkx"), F.sum("my").alias("bky"))
    j = run.filter("p < b").join(ends, group)
    q = F.col("n_meas") / F.greatest(F.lit(1), F.col("b") - F.col("a") - 1)
    last = F.coalesce("last_p", "a")
    u = (F.col("p") - last) / (F.col("b") - last)

    def path(axis):
        start, target = F.col(f"ac{axis}"), F.col(f"bc{axis}")
        raw, end = start + F.col(f"c{axis}"), start + F.coalesce(f"e{axis}", F.lit(0.0))
        bent = raw + F.col("t") * (target - end)
        r_last = end - F.coalesce(f"lk{axis}", F.lit(0.0))
        bridge = r_last + u * (target - F.col(f"bk{axis}") - r_last) + F.col(f"k{axis}")
        return F.when(F.col("was_lost") == 0, bent).when(ok, raw).otherwise(bridge)

    conf = F.when(ok, F.lit(CONF_FLOW)).otherwise(F.lit(CONF_BRIDGE)) * q
    return _boxed(j, keys, path("x"), path("y"), _lerp("aw", "bw"), _lerp("ah", "bh"), "flow", conf)


def smooth_kalman(pairs: DataFrame, steps: DataFrame, keys, frac=MAX_STEP, q=1.0, r=4.0) -> DataFrame:
    """Constant-velocity filter over the measured path, relative to the camera, anchored at b.

    Missing steps are predicted through. Confidence 0.9 where measured, 0.6 elsewhere, times the
    measured share.
    """
    keys = list(keys)
    group = [*keys, "a", "a_id"]
    inner = _interior(pairs, F.col("b"))
    rows = _with_steps(inner, steps, keys, F.least("aw", "ah"), frac)
    live = F.col("missing") == 0
    run = running(rows, group, ["p"], {
        "cx": ("sum", F.when(live, F.col("sx")).otherwise(0.0)), "cy": ("sum", F.when(live, F.col("sy")).otherwise(0.0)),
        "kx": ("sum", F.col("mx")), "ky": ("sum", F.col("my"))}, like=inner)
    run = run.withColumns({"zx": F.col("acx") + F.col("cx") - F.col("kx"), "zy": F.col("acy") + F.col("cy") - F.col("ky")})
    state = "struct<x:double,u:double,y:double,v:double,p:double,c:double,w:double>"
    first = F.struct(F.col("acx").alias("x"), F.lit(0.0).alias("u"), F.col("acy").alias("y"), F.lit(0.0).alias("v"),
                     F.lit(10.0).alias("p"), F.lit(0.0).alias("c"), F.lit(10.0).alias("w"))

    def step(s, row):
        # Position p, cross term c and velocity w of the covariance are the same on both axes.
        p, c, w = s["p"] + 2 * s["c"] + s["w"] + q, s["c"] + s["w"], s["w"] + q * 0.25
        k0, k1 = p / (p + r), c / (p + r)
        seen = row["missing"] == 0
        gx, gy = row["zx"] - (s["x"] + s["u"]), row["zy"] - (s["y"] + s["v"])
        if_seen = lambda v: F.when(seen, v).otherwise(F.lit(0.0))
        return F.struct(
            (s["x"] + s["u"] + if_seen(k0 * gx)).alias("x"), (s["u"] + if_seen(k1 * gx)).alias("u"),
            (s["y"] + s["v"] + if_seen(k0 * gy)).alias("y"), (s["v"] + if_seen(k1 * gy)).alias("v"),
            (p - if_seen(k0 * p)).alias("p"), (c - if_seen(k0 * c)).alias("c"), (w - if_seen(k1 * c)).alias("w"))

    slim = run.select(*group, "b", "b_id", "p", "t", "missing", "zx", "zy", "kx", "ky", "acx", "acy", "bcx", "bcy", "aw", "ah", "bw", "bh")
    got = fold_in_order(slim, group, ["p"], first, state, step,
                        lambda s, row: F.struct(s["x"].alias("x"), s["y"].alias("y")), "struct<x:double,y:double>", _filter_summary(q, r))
    got = cut(got)
    ends = got.groupBy(*group).agg(
        F.max(F.when(F.col("p") == F.col("b"), F.col("out.x"))).alias("ex"), F.max(F.when(F.col("p") == F.col("b"), F.col("out.y"))).alias("ey"),
        F.max(F.when(F.col("p") == F.col("b"), F.col("kx"))).alias("bkx"), F.max(F.when(F.col("p") == F.col("b"), F.col("ky"))).alias("bky"),
        F.count_if((F.col("missing") == 0) & (F.col("p") < F.col("b"))).alias("n_meas"))
    j = got.filter("p < b").join(ends, group)
    share = F.col("n_meas") / F.greatest(F.lit(1), F.col("b") - F.col("a") - 1)
    at = lambda axis: F.col(f"out.{axis}") + F.col("t") * (F.col(f"bc{axis}") - F.col(f"bk{axis}") - F.col(f"e{axis}")) + F.col(f"k{axis}")
    conf = F.when(F.col("missing") == 0, CONF_MEASURED).otherwise(CONF_GAP) * share
    return _boxed(j, keys, at("x"), at("y"), _lerp("aw", "bw"), _lerp("ah", "bh"), "kalman", conf)


def _filter_summary(q, r):
    """A stretch of the filter as (a, b, c, e, j): from state mean m and covariance P before it, the mean after is
    a (1 + P j)^-1 (m + P e) + b and the covariance a (1 + P j)^-1 P a' + c. b and e have a column per axis."""
    names = ["a00", "a01", "a10", "a11", "b0", "b1", "d0", "d1", "c00", "c01", "c11", "e0", "e1", "f0", "f1", "j00", "j01", "j11"]
    kind = "struct<" + ",".join(f"{n}:double" for n in names) + ">"
    make = lambda **v: F.struct(*[v[n].alias(n) for n in names])

    def element(row):
        seen = row["missing"] == 0
        pick = lambda a, b: F.when(seen, F.lit(a)).otherwise(F.lit(b)).cast("double")
        k, s, zero = q / (q + r), q + r, F.lit(0.0)
        told = lambda z, share: F.when(seen, row[z] * F.lit(share)).otherwise(zero)
        return make(a00=pick(1 - k, 1.0), a01=pick(1 - k, 1.0), a10=zero, a11=F.lit(1.0), b0=told("zx", k), b1=zero, d0=told("zy", k), d1=zero,
                    c00=pick((1 - k) * q, float(q)), c01=zero, c11=F.lit(q * 0.25), e0=told("zx", 1 / s), e1=told("zx", 1 / s), f0=told("zy", 1 / s), f1=told("zy", 1 / s),
                    j00=pick(1 / s, 0.0), j01=pick(1 / s, 0.0), j11=pick(1 / s, 0.0))

    def inverse(p, j):
        """(1 + p j)^-1 of symmetric p and j, and the way through it: rows of a (1 + p j)^-1."""
        m00, m01 = 1 + p["c00"] * j["j00"] + p["c01"] * j["j01"], p["c00"] * j["j01"] + p["c01"] * j["j11"]
        m10, m11 = p["c01"] * j["j00"] + p["c11"] * j["j01"], 1 + p["c01"] * j["j01"] + p["c11"] * j["j11"]
        raw = F.struct(m00.alias("a"), m01.alias("b"), m10.alias("c"), m11.alias("d"))
        return geo.let(raw, lambda m: geo.let(m["a"] * m["d"] - m["b"] * m["c"], lambda det: F.struct(
            (m["d"] / det).alias("n00"), (-m["b"] / det).alias("n01"), (-m["c"] / det).alias("n10"), (m["a"] / det).alias("n11"))))

    def through(s, t, n):
        """Mean and covariance after t of a stretch s that leaves (b, c), with n = (1 + c j)^-1."""
        g00, g01 = t["a00"] * n["n00"] + t["a01"] * n["n10"], t["a00"] * n["n01"] + t["a01"] * n["n11"]
        g10, g11 = t["a10"] * n["n00"] + t["a11"] * n["n10"], t["a10"] * n["n01"] + t["a11"] * n["n11"]
        g = F.struct(g00.alias("g00"), g01.alias("g01"), g10.alias("g10"), g11.alias("g11"))

        def mean(g, b0, b1, e0, e1):
            v0, v1 = s[b0] + s["c00"] * t[e0] + s["c01"] * t[e1], s[b1] + s["c01"] * t[e0] + s["c11"] * t[e1]
            return g["g00"] * v0 + g["g01"] * v1 + t[b0], g["g10"] * v0 + g["g11"] * v1 + t[b1]

        def after(g):
            b, d = mean(g, "b0", "b1", "e0", "e1"), mean(g, "d0", "d1", "f0", "f1")
            h00, h01 = g["g00"] * s["c00"] + g["g01"] * s["c01"], g["g00"] * s["c01"] + g["g01"] * s["c11"]
            h10, h11 = g["g10"] * s["c00"] + g["g11"] * s["c01"], g["g10"] * s["c01"] + g["g11"] * s["c11"]
            a = {f"a{i}{k}": g[f"g{i}0"] * s[f"a0{k}"] + g[f"g{i}1"] * s[f"a1{k}"] for i in "01" for k in "01"}
            return {**a, "b0": b[0], "b1": b[1], "d0": d[0], "d1": d[1], "c00": h00 * t["a00"] + h01 * t["a01"] + t["c00"],
                    "c01": h00 * t["a10"] + h01 * t["a11"] + t["c01"], "c11": h10 * t["a10"] + h11 * t["a11"] + t["c11"]}

        return g, after

    def combine(s, t):
        def with_inverse(n):
            g, after = through(s, t, n)

            def whole(g):
                # Backwards, the transposed inverse: what t says about the state before s.
                back = lambda v0, v1: (n["n00"] * v0 + n["n10"] * v1, n["n01"] * v0 + n["n11"] * v1)
                turn = lambda v: (s["a00"] * v[0] + s["a10"] * v[1], s["a01"] * v[0] + s["a11"] * v[1])
                told = lambda e0, e1, b0, b1: turn(back(t[e0] - t["j00"] * s[b0] - t["j01"] * s[b1], t[e1] - t["j01"] * s[b0] - t["j11"] * s[b1]))
                e, f = told("e0", "e1", "b0", "b1"), told("f0", "f1", "d0", "d1")
                column = lambda k: turn(back(t["j00"] * s[f"a0{k}"] + t["j01"] * s[f"a1{k}"], t["j01"] * s[f"a0{k}"] + t["j11"] * s[f"a1{k}"]))
                j0, j1 = column("0"), column("1")
                return make(**after(g), e0=e[0] + s["e0"], e1=e[1] + s["e1"], f0=f[0] + s["f0"], f1=f[1] + s["f1"],
                            j00=j0[0] + s["j00"], j01=j1[0] + s["j01"], j11=j1[1] + s["j11"])

            return geo.let(g, whole)

        return geo.let(inverse(s, t), with_inverse)

    def apply(state, t):
        zero = F.lit(0.0)
        s = {"a00": zero, "a01": zero, "a10": zero, "a11": zero, "b0": state["x"], "b1": state["u"], "d0": state["y"], "d1": state["v"],
             "c00": state["p"], "c01": state["c"], "c11": state["w"]}

        def with_inverse(n):
            g, after = through(s, t, n)

            def whole(g):
                v = after(g)
                return F.struct(*[v[k].alias(name) for k, name in (("b0", "x"), ("b1", "u"), ("d0", "y"), ("d1", "v"), ("c00", "p"), ("c01", "c"), ("c11", "w"))])

            return geo.let(g, whole)

        return geo.let(inverse(s, t), with_inverse)

    return Summary(element, combine, apply, kind)


def extend_unmatched(boxes: DataFrame, steps: DataFrame, keys, backward=False, frac=MAX_STEP) -> DataFrame:
    """Follow a box without a partner into the span, at constant size, until a step is missing or longer
    than the box. boxes: keys, a, b, id, cx, cy, w, h; steps run in walking direction."""
    keys = list(keys)
    rows = boxes.select(*keys, "a", "b", F.col("id").alias("a_id"), "cx", "cy", "w", "h").filter("b - a >= 2")
    inner = rows.withColumn("p", F.explode(F.sequence(F.col("a") + 1, F.col("b") - 1)))
    rows = _with_steps(inner, steps, keys, F.least("w", "h"), frac)
    stop = (F.col("missing") == 1) | (F.col("jump") > F.greatest("w", "h"))
    order = F.col("p").desc() if backward else F.col("p").asc()
    run = running(rows, [*keys, "a", "a_id"], [order], {
        "lost": ("max", stop.cast("int")), "mvx": ("sum", F.coalesce("sx", F.lit(0.0))), "mvy": ("sum", F.coalesce("sy", F.lit(0.0)))}, like=inner)
    return _boxed(run.filter("lost = 0"), keys, F.col("cx") + F.col("mvx"), F.col("cy") + F.col("mvy"), F.col("w"), F.col("h"), "flow", F.lit(CONF_EXTEND))


def fill_tail(boxes: DataFrame, key_frames: DataFrame, totals: DataFrame, keys) -> DataFrame:
    """Boxes of the last keyframe held to the end of the sequence. totals: keys, total frames."""
    keys = list(keys)
    last = key_frames.groupBy(*keys).agg(F.max("frame_idx").alias("frame_idx")).join(totals, keys).filter("total - frame_idx >= 2")
    rows = boxes.join(last, [*keys, "frame_idx"]).withColumn("p", F.explode(F.sequence(F.col("frame_idx") + 1, F.col("total") - 1)))
    c = geo.center_to_xyxy(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))
    return rows.select(*keys, F.col("id").alias("a_id"), "p", *[v.alias(n) for v, n in zip(c, BOX)],
                       F.lit("hold").alias("source"), F.lit(CONF_HOLD).alias("confidence"))


def link_tracks(boxes: DataFrame, matches: DataFrame, keys) -> DataFrame:
    """Persistent track ids over keyframe matches: keys, id, track_id, from 0 in order of first sight.

    Each box has at most one match on either side, so components are chains; every box finds the head
    of its chain by doubling its reach each round. boxes: keys, frame_idx, id; matches: keys, a_id, b_id.
    """
    keys = list(keys)
    k = [*keys, "id"]
    prev = matches.select(*keys, F.col("b_id").alias("id"), F.col("a_id").alias("head"))
    at = cut(boxes.select(*k).join(prev, k, "left").withColumn("head", F.coalesce("head", "id")))
    while True:
        far = at.select(*keys, F.col("id").alias("head"), F.col("head").alias("_next"))
        at = cut(at.join(far, [*keys, "head"]).withColumn("_moved", F.col("_next") != F.col("head")).select(
            *k, F.col("_next").alias("head"), "_moved"))
        done = at.filter("_moved").isEmpty()
        at = at.drop("_moved")
        if done:
            break
    heads = at.filter("head = id").select(*k).join(boxes.select(*k, "frame_idx"), k)
    ids = ordinal(heads, keys, ["frame_idx", "id"], "track_id").select(*keys, F.col("id").alias("head"), "track_id")
    return at.join(ids, [*keys, "head"]).select(*k, "track_id")


def densify_tracks(boxes: DataFrame, spans: DataFrame, matches: DataFrame, filled, tracks: DataFrame, sizes: DataFrame, keys) -> DataFrame:
    """Keyframe boxes and generated boxes as one annotation table.

    boxes: keys, frame_idx, category_id, id, cx, cy, w, h; filled: generated tables in order of emission;
    tracks: keys, id, track_id; sizes: keys, width, height. Boxes are clipped to the frame, empty ones
    dropped, confidences rounded to 3 places, ids run from 1 per sequence.
    """
    keys = list(keys)
    c = geo.center_to_xyxy(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))
    key_rows = boxes.select(*keys, F.col("id").alias("a_id"), F.col("frame_idx").alias("p"), *[v.alias(n) for v, n in zip(c, BOX)],
                            F.lit("keyframe").alias("source"), F.lit(1.0).alias("confidence"), F.lit(0).alias("_stage"))
    cols = key_rows.columns
    rows = union_all([key_rows] + [f.withColumn("_stage", F.lit(i + 1)).select(*cols) for i, f in enumerate(filled)])
    info = boxes.select(*keys, F.col("id").alias("a_id"), "category_id").join(tracks.withColumnRenamed("id", "a_id"), [*keys, "a_id"])
    j = rows.join(info, [*keys, "a_id"]).join(sizes, keys)
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    clipped, _ = geo.clip_box(geo.box(), w, h)
    out = j.withColumns({n: v for n, v in zip(BOX, clipped)}).filter("x2 > x1 and y2 > y1")
    return ordinal(out, keys, ["p", "_stage", "a_id"], "ann_id", start=1).select(
        *keys, "ann_id", F.col("p").alias("frame_idx"), "category_id", "track_id", *BOX,
        ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"), "source", F.round("confidence", 3).alias("confidence"))


def inherit_track_ids(boxes: DataFrame, keys=("session",)) -> DataFrame:
    """Track ids of boxes drawn frame by frame: the k-th box of a frame takes the k-th id of the nearest
    earlier frame with boxes on its side, unless an earlier box of the frame has it; else a fresh id of the session.

    boxes: keys, side, frame_idx, ann_id (creation order), track_id (NULL = to be given). Fresh ids follow the
    highest given one in the order in which their first boxes were made.

    A lane (keys, side, position) carries the id of its latest start: a given id, or a box for which the frame
    before has no position. Where two lanes carry one id, which takes a given id, the later position must start
    afresh. The first such clash of a run is final once the run it clashes with has none before it; final ones
    become starts and the ids are carried again, until no clash is left. A fresh id is in one lane only, so the
    rounds follow the number of lanes that share an id at a time, not the length of the session.
    """
    keys = list(keys)
    lane, frame = [*keys, "side", "k"], [*keys, "side", "frame_idx"]
    placed = ordinal(boxes.select(*frame, "ann_id", F.col("track_id").cast("long").alias("given")), frame, ["ann_id"], "k")
    count = placed.groupBy(*frame).agg(F.count("*").alias("n"))
    before = running(count, [*keys, "side"], ["frame_idx"], {"prev": ("max", F.struct("frame_idx", "n"))}, before=True)
    rows = placed.join(before.select(*frame, F.col("prev.n").alias("prev_n")), frame)
    fresh = F.col("prev_n").isNull() | (F.col("k") >= F.col("prev_n"))
    own = F.struct(F.lit(True).alias("fresh"), F.col("ann_id").cast("long").alias("id"))
    start = F.when(F.col("given").isNotNull(), F.struct(F.lit(False).alias("fresh"), F.col("given").alias("id"))).when(fresh, own)
    rows = rows.select(*lane, "frame_idx", "ann_id", start.alias("start"))
    clashes = not boxes.filter("track_id is not null").isEmpty()
    rows = cut(rows) if clashes else rows
    while True:
        # The latest start of a lane, by its frame.
        held = running(rows, lane, ["frame_idx"], {"held": ("max", F.when(F.col("start").isNotNull(), F.struct("frame_idx", "start")))})
        held = held.select(*lane, "frame_idx", "ann_id", "start", F.col("held.frame_idx").alias("since"), F.col("held.start.fresh").alias("fresh"), F.col("held.start.id").alias("id"))
        if not clashes:
            break
        held = cut(held)
        # Fresh ids stand in one lane; of given ones, the first position of each frame keeps its own.
        holder = held.filter("not fresh").groupBy(*frame, "id").agg(F.min(F.struct("k", "since")).alias("holder"), F.max("k").alias("last")).filter("last > holder.k")
        clash = held.filter("not fresh and start is null").join(holder, [*frame, "id"]).filter("k > holder.k")
        first = cut(clash.groupBy(*lane, "since").agg(F.min(F.struct("frame_idx", "ann_id", "holder")).alias("c")))
        if first.isEmpty():
            break
        earlier = first.select(*keys, "side", F.col("k").alias("_k"), F.col("since").alias("_since"), F.col("c.frame_idx").alias("_before"))
        pairs = first.select(*lane, F.col("c.frame_idx").alias("frame_idx"), F.col("c.holder.k").alias("_k"), F.col("c.holder.since").alias("_since"))
        final = pairs.join(earlier, [*keys, "side", "_k", "_since"], "left").filter("_before is null or _before > frame_idx").select(*lane, "frame_idx", F.lit(True).alias("_new"))
        rows = cut(rows.join(final, [*lane, "frame_idx"], "left").select(*lane, "frame_idx", "ann_id", F.when(F.col("_new"), own).otherwise(F.col("start")).alias("start")))
    top = boxes.groupBy(*keys).agg(F.coalesce(F.max("track_id"), F.lit(0)).cast("long").alias("top"))
    made = held.filter("start.fresh").select(*keys, "ann_id")
    numbers = ordinal(made, keys, ["ann_id"], "n", start=1).join(top, keys)
    numbers = numbers.select(*keys, F.lit(True).alias("fresh"), F.col("ann_id").cast("long").alias("id"), (F.col("top") + F.col("n")).alias("new_id"))
    named = held.join(numbers, [*keys, "fresh", "id"], "left")
    return named.select(*keys, "side", "frame_idx", "ann_id", F.coalesce("new_id", "id").alias("track_id"))


def best_successors(cands: DataFrame, keys) -> DataFrame:
    """For each candidate box the best-overlapping one of the next frame, where it reaches the minimum."""
    keys = [*keys, "frame_idx"]
    now = cands.select(*keys, F.col("cand_id").alias("cand"), *BOX)
    nxt = cands.select(*keys[:-1], (F.col("frame_idx") - 1).alias("frame_idx"), F.col("cand_id").alias("cand"), *BOX)
    hits = iou_join(now, nxt, keys, PREV_IOU, clamp_areas=True)
    return hits.groupBy(*keys[:-1], F.col("l_cand").alias("cand")).agg(
        F.min(F.struct((-F.col("iou")).alias("n"), F.col("r_cand").alias("c")))["c"].alias("succ"))


def propagate_chain(seeds: DataFrame, cands: DataFrame, keys) -> DataFrame:
    """Follow each seed frame by frame to the candidate that overlaps the box before it best.

    A step needs an overlap of 0.3 with the box before and 0.2 with the seed, otherwise the seed is lost
    for good. seeds: keys, seed_id, frame_idx, box, and sx1, sy1, sx2, sy2 where the box to start from is not
    the seed itself; cands: keys, frame_idx, cand_id, box. The successor of a candidate does not depend on the
    seed, so the chains of all seeds grow by doubling.
    """
    keys = list(keys)
    origin = [F.col(f"s{c}" if f"s{c}" in seeds.columns else c).alias(f"s{c}") for c in BOX]
    s = seeds.select(*keys, "frame_idx", "seed_id", *BOX, *origin)
    nxt = cands.select(*keys, (F.col("frame_idx") - 1).alias("frame_idx"), "cand_id", *BOX)
    first = iou_join(s, nxt, [*keys, "frame_idx"], PREV_IOU, clamp_areas=True).groupBy(*keys, F.col("l_seed_id").alias("seed_id")).agg(
        F.min(F.struct((-F.col("iou")).alias("n"), F.col("r_cand_id").alias("c")))["c"].alias("cand"))
    chain = cut(first.withColumn("n", F.lit(1).cast("long")))
    jump, reach = cut(best_successors(cands, keys)), 1
    while not jump.isEmpty():
        longer = chain.join(jump, [*keys, "cand"]).select(
            *[F.col(k).alias(k) for k in keys], F.col("seed_id").alias("seed_id"), F.col("succ").alias("cand"), (F.col("n") + reach).alias("n"))
        if longer.isEmpty():
            break
        chain = union_all([chain, cut(longer)])
        second = jump.select(*keys, F.col("cand").alias("succ"), F.col("succ").alias("_s"))
        jump, reach = cut(jump.join(second, [*keys, "succ"]).select(*keys, "cand", F.col("_s").alias("succ"))), reach * 2
    boxes = cands.select(*keys, F.col("cand_id").alias("cand"), "frame_idx", *BOX)
    j = chain.join(boxes, [*keys, "cand"]).join(s.select(*keys, "seed_id", *[f"s{c}" for c in BOX]), [*keys, "seed_id"])
    far = geo.iou(geo.box(), tuple(F.col(f"s{c}") for c in BOX), clamp_areas=True) < F.lit(SEED_IOU)
    cutoff = j.filter(far).groupBy(*keys, "seed_id").agg(F.min("n").alias("lost"))
    return j.join(cutoff, [*keys, "seed_id"], "left").filter("lost is null or n < lost").select(
        *keys, "seed_id", "frame_idx", F.col("cand").alias("cand_id"), *BOX)


def apply_propagated(boxes: DataFrame, live: DataFrame, keys=("image_id",), min_side=2.0) -> DataFrame:
    """Propagated boxes that are large enough and whose track is not yet on the image."""
    by = [*keys, "track_id"]
    fits = boxes.filter((F.col("x2") - F.col("x1") >= min_side) & (F.col("y2") - F.col("y1") >= min_side))
    first = fits.groupBy(*by).agg(F.min(F.struct(*[c for c in fits.columns if c not in by])).alias("_b"))
    new = first.join(live.filter("track_id is not null").select(*by).distinct(), by, "left_anti")
    return new.select(*by, "_b.*")


def apply_interpolated(boxes: DataFrame, live: DataFrame, keys, one_per_frame=True) -> DataFrame:
    """Interpolated boxes for frames of a side that have none yet; the first job wins a frame.

    boxes: keys (with side), frame_idx, job, payload; live: keys, frame_idx.
    """
    by = [*keys, "frame_idx"]
    free = boxes.join(live.select(*by).distinct(), by, "left_anti")
    if not one_per_frame:
        return free
    rest = [c for c in free.columns if c not in (*by, "job")]
    return free.groupBy(*by).agg(F.min(F.struct("job", *rest)).alias("_b")).select(*by, "_b.*")


def compose_motion(transforms: DataFrame, anchors: DataFrame, keys) -> DataFrame:
    """Camera position of an anchor center along a span.

    transforms: keys, p, m (row-major 3x3 from p - 1 to p); anchors: keys, cx, cy. Output: keys, p, the
    running product `acc`, cam_x, cam_y.
    """
    keys = list(keys)
    eye = F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)])

    def product(s, m):
        return F.array(*[sum((m[3 * i + k] * s[3 * k + j] for k in range(1, 3)), m[3 * i] * s[j]) for i in range(3) for j in range(3)])

    whole = Summary(lambda row: row["m"], product, product, "array<double>")
    out = fold_in_order(transforms.select(*keys, "p", "m"), keys, ["p"], eye, "array<double>", lambda s, row: product(s, row["m"]), lambda s, row: s, "array<double>", whole)
    j = out.withColumnRenamed("out", "acc").join(anchors.select(*keys, "cx", "cy"), keys)
    at = lambda i: F.col("acc")[3 * i] * F.col("cx") + F.col("acc")[3 * i + 1] * F.col("cy") + F.col("acc")[3 * i + 2]
    return j.select(*keys, "p", "acc", at(0).alias("cam_x"), at(1).alias("cam_y"))
