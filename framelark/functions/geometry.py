"""Box and polygon expressions. Boxes are x1, y1, x2, y2 unless a name says otherwise."""

from pyspark.sql import Column
from pyspark.sql import functions as F



def let(value: Column, fn) -> Column:
    """fn(value) with the value computed once, for use inside several lambdas."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def fixed(v: Column, places=6) -> Column:
    """Decimal text of a double with the given places, rounded by its binary value, ties to even.

    Spark's own rounding works on the shortest decimal form and can differ in the last digit. Here the
    value is split in two halves whose products with 10^places are exact, so the comparison with one
    half is exact too.
    """
    unit = 10**places
    scale = F.lit(float(unit))
    big = v * F.lit(134217729.0)
    hi = big - (big - v)
    whole = F.floor(hi * scale)
    over = (hi * scale - whole - F.lit(0.5)) + (v - hi) * scale
    up = (over > 0) | ((over == 0) & (whole % 2 != 0))
    n = F.abs(whole + F.when(up, 1).otherwise(0))
    digits = F.lpad((n % unit).cast("string"), places, "0")
    return F.concat(F.when(v < 0, "-").otherwise(""), F.floor(n / unit).cast("string"), F.lit("."), digits)


def fixed_all(arr: Column, places=6) -> Column:
    """Every number of an array as `fixed` text, in steps so that no part is computed twice."""
    unit = 10**places
    scale = F.lit(float(unit))
    halves = F.transform(arr, lambda v: F.struct(v.alias("v"), (v * F.lit(134217729.0) - (v * F.lit(134217729.0) - v)).alias("hi")))
    parts = F.transform(halves, lambda s: F.struct(
        (s["v"] < 0).alias("neg"), F.floor(s["hi"] * scale).alias("whole"), (s["hi"] * scale - F.lit(0.5)).alias("most"),
        ((s["v"] - s["hi"]) * scale).alias("rest")))
    over = F.transform(parts, lambda s: F.struct(s["neg"], s["whole"], ((s["most"] - s["whole"]) + s["rest"]).alias("over")))
    whole = F.transform(over, lambda s: F.struct(s["neg"].alias("neg"), F.abs(
        s["whole"] + F.when((s["over"] > 0) | ((s["over"] == 0) & (s["whole"] % 2 != 0)), 1).otherwise(0)).alias("n")))
    return F.transform(whole, lambda s: F.concat(
        F.when(s["neg"], "-").otherwise(""), F.floor(s["n"] / unit).cast("string"), F.lit("."), F.lpad((s["n"] % unit).cast("string"), places, "0")))


def box(prefix="", sep=""):
    """The four corner columns behind an alias or prefix: box("l.") -> l.x1, l.y1, l.x2, l.y2."""
    return tuple(F.col(f"{prefix}{sep}{c}") for c in ("x1", "y1", "x2", "y2"))


def fields(struct: Column):
    return tuple(struct[c] for c in ("x1", "y1", "x2", "y2"))


def _inter(a, b):
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return w * h


def iou(a, b, clamp_areas=False) -> Column:
    """Intersection over union; 0 when the union is not positive.

    With `clamp_areas`, inverted boxes count as empty instead of with a signed area.
    """

    def area(p):
        if clamp_areas:
            return F.greatest(F.lit(0.0), p[2] - p[0]) * F.greatest(F.lit(0.0), p[3] - p[1])
        return (p[2] - p[0]) * (p[3] - p[1])

    inter = _inter(a, b)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def xywh_to_xyxy(x, y, w, h):
    return x, y, x + w, y + h


def xyxy_to_xywh(x1, y1, x2, y2):
    return x1, y1, x2 - x1, y2 - y1


def xyxy_to_center(x1, y1, x2, y2):
    """Center and size."""
    return (x1 + x2) / 2.0, (y1 + y2) / 2.0, x2 - x1, y2 - y1


def center_to_xyxy(cx, cy, w, h):
    return cx - w / 2.0, cy - h / 2.0, cx + w / 2.0, cy + h / 2.0


def yolo_to_pixels(xc, yc, w, h, width=None, height=None):
    """Normalized center box to corners; without image dims the numbers are kept unscaled."""
    x1, y1, x2, y2 = center_to_xyxy(xc, yc, w, h)
    if width is None:
        return x1, y1, x2, y2
    return x1 * width, y1 * height, x2 * width, y2 * height


def clamp(v, lo, hi) -> Column:
    return F.greatest(F.lit(lo) if not isinstance(lo, Column) else lo, F.least(v, hi))


def clip_box(b, width, height, reorder=False):
    """(clipped corners, keep flag).

    Inverted boxes are rejected, or put in order first with `reorder`; boxes left without area after
    clipping are rejected.
    """
    x1, y1, x2, y2 = b
    if reorder:
        x1, y1, x2, y2 = F.least(b[0], b[2]), F.least(b[1], b[3]), F.greatest(b[0], b[2]), F.greatest(b[1], b[3])
    ordered = (x2 > x1) & (y2 > y1)
    c = (clamp(x1, 0.0, width), clamp(y1, 0.0, height), clamp(x2, 0.0, width), clamp(y2, 0.0, height))
    return c, ordered & (c[2] > c[0]) & (c[3] > c[1])


def clamp_detection(b, width, height, min_side=2.0):
    """Clamp to the image; keep flag is false when either side is under `min_side`."""
    c, _ = clip_box(b, width, height)
    return c, ((c[2] - c[0]) >= min_side) & ((c[3] - c[1]) >= min_side)


def scale_coords(v: Column, dim: Column, scale: float, truncate=False) -> Column:
    """Model coordinate on a 0..scale axis to a pixel, half-even rounding; scale 1 leaves it alone."""
    if scale == 1:
        return v
    px = v * dim / F.lit(float(scale))
    return (px.cast("int") if truncate else F.bround(px).cast("int")).cast("double")


def polygon_to_yolo(poly: Column, width: Column, height: Column) -> Column:
    """Pixel polygon to normalized text with 6 decimals; NULL for fewer than 6 or an odd count."""
    unit = F.transform(poly, lambda v, i: clamp(v / F.when(i % 2 == 0, width).otherwise(height), 0.0, F.lit(1.0)))
    return F.when((F.size(poly) >= 6) & (F.size(poly) % 2 == 0), F.array_join(fixed_all(unit), " "))


def bbox_to_polygon(x, y, w, h) -> Column:
    return F.array(x, y, x + w, y, x + w, y + h, x, y + h)


def _edges(poly: Column) -> Column:
    """Edges {xi, yi, xj, yj} of a flat x, y, x, y, ... array, the last one closing the polygon."""
    n = F.floor(F.size(poly) / F.lit(2)).cast("int")
    at = lambda i: F.get(poly, i)

    def edge(i):
        j = (i + 1) % n
        return F.struct(
            at(2 * i).alias("xi"), at(2 * i + 1).alias("yi"), at(2 * j).alias("xj"), at(2 * j + 1).alias("yj")
        )

    empty = F.array().cast("array<struct<xi:double,yi:double,xj:double,yj:double>>")
    return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 1), edge)).otherwise(empty)


def polygon_area(poly: Column) -> Column:
    """Shoelace area; 0 for fewer than three points."""
    cross = lambda acc, e: acc + e["xi"] * e["yj"] - e["xj"] * e["yi"]
    return let(poly, lambda p: F.abs(F.aggregate(_edges(p), F.lit(0.0), cross)) / 2.0)


def filter_polygons(polys: Column, min_area=100.0) -> Column:
    """Polygons of at least `min_area`; when none qualifies, the largest well-formed one."""
    formed = F.transform(F.filter(polys, lambda p: F.size(p) >= 6), lambda p: F.struct(polygon_area(p).alias("a"), p.alias("p")))

    def chosen(f):
        large = F.filter(f, lambda s: s["a"] >= min_area)
        best = F.when(F.size(large) > 0, large).when(F.size(f) > 0, F.array(F.array_max(f))).otherwise(F.slice(f, 1, 0))
        return F.transform(best, lambda s: s["p"])

    return let(formed, chosen)


def _inside(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd rule by casting a ray to the right; `edges` are those of the polygon."""

    def crossing(e):
        at = e["xi"] + (py - e["yi"]) * (e["xj"] - e["xi"]) / F.when(e["yj"] != e["yi"], e["yj"] - e["yi"])
        return ((e["yi"] > py) != (e["yj"] > py)) & (px < at)

    return F.size(F.filter(edges, crossing)) % 2 == 1


def point_in_polygon(poly: Column, px: Column, py: Column) -> Column:
    return let(poly, lambda p: _inside(_edges(p), px, py))


def selected_by_points(poly: Column, points: Column) -> Column:
    """True when the polygon holds a positive point and no negative one.

    `points` is an array of {x, y, positive}; if none is positive, all count as positive.
    """
    any_pos = F.exists(points, lambda p: p["positive"])

    def verdict(edges):
        pos = F.exists(points, lambda p: (p["positive"] | ~any_pos) & _inside(edges, p["x"], p["y"]))
        neg = F.exists(points, lambda p: any_pos & ~p["positive"] & _inside(edges, p["x"], p["y"]))
        return pos & ~neg

    return let(let(poly, _edges), verdict)


def l2_normalize(v: Column) -> Column:
    """Vector divided by its norm, in double; a norm under 1e-12 counts as 1."""
    d = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(d, lambda x: x / F.when(norm < 1e-12, F.lit(1.0)).otherwise(norm))


# --- flips and rotation of label geometry ---------------------------------------------------------


def flip_points(coords: Column, axis: str) -> Column:
    """Mirror a normalized point list; axis "h" mirrors x, "v" mirrors y."""
    parity = 0 if axis == "h" else 1
    return F.transform(coords, lambda v, i: F.when(i % 2 == parity, 1.0 - v).otherwise(v))


def flip_center(xc, yc, axis: str):
    return (1.0 - xc, yc) if axis == "h" else (xc, 1.0 - yc)


def rotate_point(x, y, cos, sin, width, height):
    """Rotate a pixel about the image center, positive angles turning counter-clockwise on screen."""
    cx, cy = width / 2.0, height / 2.0
    return cos * x + sin * y + (1 - cos) * cx - sin * cy, -sin * x + cos * y + sin * cx + (1 - cos) * cy


def rotated_extent(b, cos, sin, width, height):
    """Corners of the upright box around a rotated box."""
    p = [rotate_point(b[i], b[j], cos, sin, width, height) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3))]
    xs, ys = [q[0] for q in p], [q[1] for q in p]
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def rotate_polygon(poly: Column, cos, sin, width, height) -> Column:
    """Rotate every point of a pixel polygon and clip it to the image."""

    def one(v, i):
        x = F.when(i % 2 == 0, v).otherwise(F.get(poly, i - 1))
        y = F.when(i % 2 == 0, F.get(poly, i + 1)).otherwise(v)
        px, py = rotate_point(x, y, cos, sin, width, height)
        return F.when(i % 2 == 0, clamp(px, 0.0, width)).otherwise(clamp(py, 0.0, height))

    return F.transform(poly, one)
