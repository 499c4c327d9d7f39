"""Pairing boxes by overlap or distance."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.operators.scale import (
    FOLD_ROWS,
    cut,
    greedy_pairs,
    limit_of,
    ordinal,
    overlap_pairs,
    split_both,
    union_all,
)


def _sides(df, keys):
    return [c for c in df.columns if c not in keys]


def _limit(df):
    return limit_of(df.sparkSession, "foldRows", FOLD_ROWS)


def _same(keys):
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])


def _bounded_pairs(left, right, keys, min_iou, strict):
    """Overlapping pairs of bounded groups: keys, l_id, r_id, iou."""
    iou = geo.iou(geo.box("l."), geo.box("r."))
    hit = (iou > F.lit(min_iou)) if strict or min_iou <= 0 else (iou >= F.lit(min_iou))
    return left.alias("l").join(right.alias("r"), _same(keys) & hit).select(
        *[F.col(f"l.{k}").alias(k) for k in keys], F.col("l.id").alias("l_id"), F.col("r.id").alias("r_id"), iou.alias("iou"))


def iou_pairs(left: DataFrame, right: DataFrame, keys, min_iou=0.5, strict=False, clamp_areas=False, cond=None):
    """Overlapping pairs as (pairs of bounded groups, pairs of oversized groups or None).

    Output: keys, the other columns as l_* and r_*, and iou. `cond` is a further Column over the
    aliases l and r. Pairs without any overlap are never part of the result.
    """
    iou = geo.iou(geo.box("l."), geo.box("r."), clamp_areas)
    hit = (iou > F.lit(min_iou)) if strict or min_iou <= 0 else (iou >= F.lit(min_iou))
    if cond is not None:
        hit = hit & cond
    out = [
        *[F.col(f"l.{k}").alias(k) for k in keys],
        *[F.col(f"l.{c}").alias(f"l_{c}") for c in _sides(left, keys)],
        *[F.col(f"r.{c}").alias(f"r_{c}") for c in _sides(right, keys)],
        iou.alias("iou"),
    ]
    (sl, sr), hot = split_both(left, right, keys, _limit(left))
    pairs = sl.alias("l").join(sr.alias("r"), _same(keys) & hit).select(*out)
    return pairs, None if hot is None else overlap_pairs(hot[0], hot[1], keys, hit, min_iou).select(*out)


def bounded_pairs(left: DataFrame, right: DataFrame, keys, min_iou) -> DataFrame:
    """`iou_pairs` of groups known to be bounded."""
    iou = geo.iou(geo.box("l."), geo.box("r."))
    hit = (iou > F.lit(min_iou)) if min_iou <= 0 else (iou >= F.lit(min_iou))
    return left.alias("l").join(right.alias("r"), _same(keys) & hit).select(
        *[F.col(f"l.{k}").alias(k) for k in keys], *[F.col(f"l.{c}").alias(f"l_{c}") for c in _sides(left, keys)],
        *[F.col(f"r.{c}").alias(f"r_{c}") for c in _sides(right, keys)], iou.alias("iou"))


def iou_join(left: DataFrame, right: DataFrame, keys, min_iou=0.5, strict=False, clamp_areas=False, cond=None):
    """Pairs of boxes of one group whose overlap reaches `min_iou` (exceeds it with `strict`)."""
    small, big = iou_pairs(left, right, keys, min_iou, strict, clamp_areas, cond)
    return small if big is None else small.unionByName(big)


def both_parts(pairs, change):
    """Apply a row-level change to both parts of a split pair table."""
    return tuple(None if p is None else change(p) for p in pairs)


def serial_choice(left: DataFrame, right: DataFrame, keys, min_iou, strict=False, also=None) -> DataFrame:
    """left ids in order each take the best free right box (overlap, then lower id), in groups of any size.

    Sides: keys, id (integer, once per side), box. `also` is a further condition on an overlap that reaches
    `min_iou`, over the overlap and the keys. Output: l_id, r_id, iou. Copies of one box are handled together: the
    choice runs over distinct boxes, a distinct right box offering one seat per copy. In each round a
    right box serves, in order, those that want it most, up to the first one touching it that wants
    another box (or whose choice hangs on a tie). Who comes first for the box it wants is always served.
    """
    box = ["x1", "y1", "x2", "y2"]
    iou = geo.iou(geo.box("l."), geo.box("r."))
    hit = (iou > F.lit(min_iou)) if strict or min_iou <= 0 else (iou >= F.lit(min_iou))
    if also is not None:
        hit = hit & also(iou, lambda k: F.col(f"l.{k}"))
    distinct = lambda d: cut(d.groupBy(*keys, *box).agg(F.min("id").alias("grp")))
    lg, rg = distinct(left), distinct(right)
    edges = cut(overlap_pairs(lg, rg, keys, hit, min_iou).select(F.col("l.grp").alias("P"), F.col("r.grp").alias("G"), iou.alias("iou")))
    members = lambda d, g, n: d.join(g, [*keys, *box]).select("id", F.col("grp").alias(n)).join(edges.select(n).distinct(), n, "left_semi")
    free, seats = cut(members(left, lg, "P")), cut(members(right, rg, "G"))
    out = []
    while True:
        ahead = free.groupBy("P").agg(F.min("id").alias("m"))
        room = seats.groupBy("G").agg(F.min("id").alias("seat"))
        live = cut(edges.join(ahead, "P").join(room, "G"))
        if live.isEmpty():
            break
        edges = live.select("P", "G", "iou")
        best = live.groupBy("P").agg(F.min(F.struct((-F.col("iou")).alias("n"), "seat", F.col("G").alias("g"))).alias("b"))
        rows = live.join(best, "P").withColumns({"top": F.col("G") == F.col("b.g"), "equal": -F.col("iou") == F.col("b.n")})
        ties = rows.groupBy("P").agg((F.count_if("equal") > 1).alias("tied"))
        rows = cut(rows.join(ties, "P"))
        limit = rows.groupBy("G").agg(
            F.min("m").alias("first"), F.min(F.when(~F.col("top"), F.col("m"))).alias("other"),
            F.min(F.when(F.col("top") & F.col("tied"), F.col("m"))).alias("tie"))
        tie = F.when(F.col("tie") == F.col("first"), F.col("first") + 1).otherwise(F.col("tie"))
        limit = limit.select("G", F.least("other", tie).alias("end"))
        served = free.join(rows.filter("top").select("P", "G", "iou"), "P").join(limit, "G").filter("end is null or id < end")
        served = cut(served.select("id", "G", "iou"))
        queue = ordinal(served, ["G"], ["id"], "k").select(F.col("id").alias("l_id"), "G", "k", "iou")
        offer = ordinal(seats.join(served.select("G").distinct(), "G", "left_semi"), ["G"], ["id"], "k").select(F.col("id").alias("r_id"), "G", "k")
        new = cut(queue.join(offer, ["G", "k"]).select("l_id", "r_id", "iou"))
        out.append(new)
        free = cut(free.join(new.select(F.col("l_id").alias("id")), "id", "left_anti"))
        seats = cut(seats.join(new.select(F.col("r_id").alias("id")), "id", "left_anti"))
    if not out:
        return live.select(F.col("m").alias("l_id"), F.col("seat").alias("r_id"), "iou")
    return union_all(out)


def _take_turns(left, right, keys, min_iou, strict=False):
    """The same choice for all groups: bounded ones over their pairs, oversized ones in rounds."""
    (sl, sr), hot = split_both(left, right, keys, _limit(left))
    pairs = _bounded_pairs(sl, sr, keys, min_iou, strict).select(*keys, "l_id", "r_id", (-F.col("iou")).alias("neg_iou"))
    taken = greedy_pairs((pairs, None), keys, "l_id", "r_id", ["neg_iou", "r_id"], ["l_id"], ["l_id", "neg_iou", "r_id"])
    taken = taken.select(*keys, "l_id", "r_id", (-F.col("neg_iou")).alias("iou"))
    if hot is None:
        return taken
    late = serial_choice(hot[0], hot[1], keys, min_iou, strict)
    return taken.unionByName(hot[0].select(*keys, F.col("id").alias("l_id")).join(late, "l_id"))


def match_predictions(pred: DataFrame, gt: DataFrame, keys=("image_id",), min_iou=0.5, extra=()) -> DataFrame:
    """Predictions in pred_id order each take the best free ground-truth box of any class.

    Boxes that do not overlap at all never match, whatever `min_iou`.

    Output: keys, outcome (tp, mismatch, fp, fn), pred_id, ann_id, pred_class, gt_class, iou.
    `extra` names prediction columns to carry along.
    """
    keys = list(keys)
    box = ["x1", "y1", "x2", "y2"]
    taken = _take_turns(
        pred.select(*keys, F.col("pred_id").alias("id"), *box), gt.select(*keys, F.col("ann_id").alias("id"), *box), keys, min_iou
    ).withColumnsRenamed({"l_id": "pred_id", "r_id": "ann_id"})
    classes = gt.select(*keys, "ann_id", F.col("category_id").alias("gt_class"))
    taken = taken.join(classes, [*keys, "ann_id"])
    preds = (
        pred.select(*keys, "pred_id", F.col("category_id").alias("pred_class"), *extra)
        .join(taken, [*keys, "pred_id"], "left")
        .withColumn(
            "outcome",
            F.when(F.col("ann_id").isNull(), "fp")
            .when(F.col("pred_class") == F.col("gt_class"), "tp")
            .otherwise("mismatch"),
        )
    )
    missed = classes.join(
        taken.select(*keys, "ann_id"), [*keys, "ann_id"], "left_anti"
    )
    cols = [*keys, "outcome", "pred_id", "ann_id", "pred_class", "gt_class", "iou"]
    return preds.select(*cols, *extra).unionByName(
        missed.withColumn("outcome", F.lit("fn")), allowMissingColumns=True
    )


def assign_exclusive(inputs: DataFrame, dets: DataFrame, keys=("image_id",), min_iou=0.1) -> DataFrame:
    """Inputs in input_id order take the best unused detection with overlap above `min_iou`, else NULL."""
    keys = list(keys)
    box = ["x1", "y1", "x2", "y2"]
    taken = _take_turns(
        inputs.select(*keys, F.col("input_id").alias("id"), *box), dets.select(*keys, F.col("det_id").alias("id"), *box),
        keys, min_iou, strict=True,
    ).withColumnsRenamed({"l_id": "input_id", "r_id": "det_id"})
    return inputs.join(taken, [*keys, "input_id"], "left")


def assign_best(inputs: DataFrame, dets: DataFrame, keys) -> DataFrame:
    """Each input takes the mask of its best-overlapping detection, first wins ties, no threshold.

    An input that overlaps nothing takes the first detection of its group. A chosen detection without
    a mask falls back to the mask at the input's own position; an empty mask (area 0) is a failure.
    Inputs: keys, input_id, box. Detections: keys, det_id, box, mask_area (NULL = no mask).
    """
    keys = list(keys)
    box = ["x1", "y1", "x2", "y2"]
    # Choosing the best overlap needs only pairs that overlap; the rest share one first detection.
    best = (
        iou_join(inputs.select(*keys, "input_id", *box), dets.select(*keys, "det_id", *box), keys, 0.0, clamp_areas=True)
        .groupBy(*keys, F.col("l_input_id").alias("input_id"))
        .agg(F.min(F.struct((-F.col("iou")).alias("n"), F.col("r_det_id").alias("d")))["d"].alias("best_id"))
    )
    first = dets.groupBy(*keys).agg(F.min("det_id").alias("first_id"))
    ranked = ordinal(dets.select(*keys, "det_id", "mask_area"), keys, ["det_id"], "k").select(
        *keys, "k", F.col("mask_area").alias("kth_area")
    )
    masks = dets.select(*keys, F.col("det_id").alias("chosen_id"), "mask_area")
    return (
        ordinal(inputs, keys, ["input_id"], "k")
        .join(best, [*keys, "input_id"], "left")
        .join(first, keys, "left")
        .withColumn("chosen_id", F.coalesce("best_id", "first_id"))
        .join(masks, [*keys, "chosen_id"], "left")
        .join(ranked, [*keys, "k"], "left")
        .withColumn("area", F.coalesce("mask_area", "kth_area", F.lit(0.0)))
        .select(*keys, "input_id", "chosen_id", "area", (F.col("area") > 0).alias("success"))
    )


RINGS = 6  # doublings of the radius from the first to `max_dist`


def _points(side, keys, at, name):
    """(distinct centers with the least id as `name`, members of each)."""
    side = side.withColumns({c: F.col(c) + F.lit(0.0) for c in ("cx", "cy")})  # no negative zero
    points = cut(side.groupBy(*keys, "cx", "cy", "max_dist").agg(F.min("id").alias("_p")).withColumn(name, F.struct(*keys, F.col("_p").alias("p"))).drop("_p"))
    members = cut(side.join(points, [*keys, "cx", "cy", "max_dist"]).select(name, F.col("id").alias(at)))
    return points, members


def _nearest_rings(a, b, keys):
    """Nearest centers of groups of any size: keys, a_id, b_id, dist.

    Copies of a center are one point with its members in order of id. Within a radius, two points that are each
    other's nearest are final, whatever lies beyond it; all their members pair off at once, or the first ones alone
    where another point is just as near. When no pair is left the radius doubles, for what is still free.
    """
    pa, ma = _points(a, keys, "a_id", "P")
    pb, mb = _points(b, keys, "b_id", "Q")
    dx, dy = F.col("l.cx") - F.col("r.cx"), F.col("l.cy") - F.col("r.cy")
    dist = F.sqrt(dx * dx + dy * dy)
    out = []
    for ring in range(RINGS, -1, -1):
        radius = F.col("max_dist") / F.lit(2.0**ring)
        cell = lambda c: F.floor(F.col(c) / radius).cast("long")  # noqa: B023, E731
        around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))  # noqa: B023, E731
        left = pa.join(ma.select("P").distinct(), "P", "left_semi").withColumns({"_gx": cell("cx"), "_gy": cell("cy"), "_r": radius}).alias("l")
        right = pb.join(mb.select("Q").distinct(), "Q", "left_semi").withColumn("_gx", around("cx")).withColumn("_gy", around("cy")).alias("r")
        on = dist <= F.col("l._r")
        for k in [*keys, "_gx", "_gy"]:
            on = (F.col(f"l.{k}") == F.col(f"r.{k}")) & on
        live = cut(left.join(right, on).select("l.P", "r.Q", dist.alias("dist")))
        while True:
            firsts = live.join(ma.groupBy("P").agg(F.min("a_id").alias("a"), F.count("*").alias("na")), "P").join(mb.groupBy("Q").agg(F.min("b_id").alias("b"), F.count("*").alias("nb")), "Q")
            firsts = cut(firsts)
            if firsts.isEmpty():
                break
            live = firsts.select("P", "Q", "dist")
            best_p = firsts.groupBy("P").agg(F.min(F.struct("dist", "b", "Q")).alias("bp"))
            best_q = firsts.groupBy("Q").agg(F.min(F.struct("dist", "a", "P")).alias("bq"))
            marked = cut(firsts.join(best_p, "P").join(best_q, "Q").withColumns({"even_p": F.col("dist") == F.col("bp.dist"), "even_q": F.col("dist") == F.col("bq.dist")}))
            ties_p = marked.groupBy("P").agg((F.count_if("even_p") > 1).alias("tied_p"))
            ties_q = marked.groupBy("Q").agg((F.count_if("even_q") > 1).alias("tied_q"))
            final = marked.filter((F.col("bp.Q") == F.col("Q")) & (F.col("bq.P") == F.col("P"))).join(ties_p, "P").join(ties_q, "Q")
            final = cut(final.select("P", "Q", "dist", F.when(F.col("tied_p") | F.col("tied_q"), F.lit(1)).otherwise(F.least("na", "nb")).alias("many")))
            turn = lambda members, point, at: ordinal(members.join(final, point, "left_semi"), [point], [at], "_k")  # noqa: B023, E731
            pairs = final.join(turn(ma, "P", "a_id"), "P").join(turn(mb, "Q", "b_id"), ["Q", "_k"]).filter("_k < many")
            new = cut(pairs.select(*[F.col(f"P.{k}").alias(k) for k in keys], "P", "Q", "a_id", "b_id", "dist"))
            out.append(new)
            ma = cut(ma.join(new.select("P", "a_id"), ["P", "a_id"], "left_anti"))
            mb = cut(mb.join(new.select("Q", "b_id"), ["Q", "b_id"], "left_anti"))
    return union_all([n.drop("P", "Q") for n in out]) if out else None


def match_nearest_center(a: DataFrame, b: DataFrame, keys, max_dist) -> DataFrame:
    """One-to-one nearest-center pairs inside `keys`, taken in order of (distance, a_id, b_id).

    Sides: keys, id, cx, cy. `max_dist` is a number, or the name of a column present on both sides
    with one value per group. Output: keys, a_id, b_id, dist.
    """
    keys = list(keys)
    if not isinstance(max_dist, str):
        a = a.withColumn("max_dist", F.lit(float(max_dist)))
        b = b.withColumn("max_dist", F.lit(float(max_dist)))
    else:
        a = a.withColumn("max_dist", F.col(max_dist).cast("double"))
        b = b.withColumn("max_dist", F.col(max_dist).cast("double"))
    cols = [*keys, "id", "cx", "cy", "max_dist"]
    a, b = a.select(*cols).filter("max_dist > 0"), b.select(*cols).filter("max_dist > 0")
    dx, dy = F.col("l.cx") - F.col("r.cx"), F.col("l.cy") - F.col("r.cy")
    dist = F.sqrt(dx * dx + dy * dy)
    out = [
        *[F.col(f"l.{k}").alias(k) for k in keys],
        F.col("l.id").alias("a_id"),
        F.col("r.id").alias("b_id"),
        dist.alias("dist"),
    ]
    (sa, sb), hot = split_both(a, b, keys, _limit(a))
    on = dist <= F.col("l.max_dist")
    for k in keys:
        on = (F.col(f"l.{k}") == F.col(f"r.{k}")) & on
    pairs = sa.alias("l").join(sb.alias("r"), on).select(*out)
    taken = greedy_pairs(
        (pairs, None), keys, "a_id", "b_id", ["dist", "b_id"], ["dist", "a_id"], ["dist", "a_id", "b_id"]
    )
    far = None if hot is None else _nearest_rings(hot[0], hot[1], keys)
    return taken if far is None else taken.unionByName(far.select(*taken.columns))


def unmatched(side: DataFrame, pairs: DataFrame, keys, id_col: str) -> DataFrame:
    """Rows of one side that found no partner."""
    return side.join(pairs.select(*keys, F.col(id_col).alias("id")), [*keys, "id"], "left_anti")


def match_distance(a_width, a_height, b_width, b_height, frac):
    """How far centers of a pair may lie apart: a share of the smaller side of the larger of both frames.

    A frame without width or height does not count; without either frame the distance is 0.
    """
    def reach(w, h):
        return F.when((w > 0) & (h > 0), F.lit(frac) * F.least(w, h).cast("double"))

    return F.coalesce(F.greatest(reach(a_width, a_height), reach(b_width, b_height)), F.lit(0.0))


def pair_anchor_boxes(a: DataFrame, b: DataFrame, keys, max_dist) -> DataFrame:
    """Pair anchor boxes by (category, track id) first, the rest by nearest center.

    Sides: keys, category_id, track_id, id, cx, cy (and max_dist, when it is a column).
    Output: keys, category_id, a_id, b_id, how ("track" or "center").
    """
    keys = list(keys)
    by = [*keys, "category_id", "track_id"]

    def ranked(side, name):
        got = ordinal(side.filter("track_id is not null"), by, ["id"], "_k")
        return got.select(*by, "_k", F.col("id").alias(name))

    exact = ranked(a, "a_id").join(ranked(b, "b_id"), [*by, "_k"]).select(*keys, "category_id", "a_id", "b_id")
    group = [*keys, "category_id"]
    rest_a, rest_b = unmatched(a, exact, group, "a_id"), unmatched(b, exact, group, "b_id")
    near = match_nearest_center(rest_a, rest_b, group, max_dist)
    return exact.withColumn("how", F.lit("track")).unionByName(
        near.drop("dist").withColumn("how", F.lit("center"))
    )


def one_sided_tracks(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Track ids present on only one anchor of a span: keys, track_id, side ("start" or "end")."""
    keys = [*keys, "track_id"]
    both = a.select(*keys, F.lit(1).alias("s")).unionByName(b.select(*keys, F.lit(2).alias("s")))
    seen = both.filter("track_id is not null").groupBy(*keys).agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    return seen.filter("lo = hi").select(*keys, F.when(F.col("lo") == 1, "start").otherwise("end").alias("side"))


def mosaic_neighbors(images: DataFrame, keys=(), order="file_name", out="file_name") -> DataFrame:
    """Each image with its next three in name order, where all three exist.

    Output: keys, `out` of the first image, quadrant 0..3, member.
    """
    keys = list(keys)
    ix = ordinal(images.select(*keys, order, *([out] if out != order else [])), keys, [order], "_i")
    slots = ix.select(
        *keys, F.col(out).alias("member"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("quadrant"), "_i"
    ).withColumn("_first", F.col("_i") - F.col("quadrant"))
    first = ix.select(*keys, F.col(out).alias("image"), F.col("_i").alias("_first"))
    full = slots.groupBy(*keys, "_first").count().filter("count = 4").drop("count")
    return slots.join(full, [*keys, "_first"], "left_semi").join(first, [*keys, "_first"]).select(
        *keys, "image", "quadrant", "member"
    )
