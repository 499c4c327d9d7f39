"""String and JSON expressions for labels, file names and model responses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: what counts as an integer and as a float in label text.
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Fixed shape of one parsed detection.
DETECTIONS = "array<struct<label:string,bbox_2d:array<double>,box_2d:array<double>,bbox:array<double>,score:double>>"


def detections(field=None) -> str:
    """Shape of one parsed detection whose box may also stand under `field`."""
    if field in (None, "bbox_2d", "box_2d", "bbox"):
        return DETECTIONS
    return DETECTIONS.replace("struct<", f"struct<`{field}`:array<double>,")


def as_int(text: Column) -> Column:
    """Integer of a token, NULL when the token is not written as one ("1.0" is not)."""
    return F.when(text.rlike(INT_TEXT), text.try_cast("bigint"))


def as_float(text: Column) -> Column:
    """Double of a token, NULL when it is not a plain decimal number; "nan" is not one."""
    return F.when(text.rlike(FLOAT_TEXT), text.try_cast("double"))


def tokens(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def json_block(response: Column) -> Column:
    """The fenced ```json block, else the first fenced block, else the whole response."""
    after_json = F.get(F.split(response, "```json"), F.lit(1))
    after_fence = F.get(F.split(response, "```"), F.lit(1))
    return (
        F.when(F.contains(response, F.lit("```json")), F.get(F.split(after_json, "```"), F.lit(0)))
        .when(F.contains(response, F.lit("```")), after_fence)
        .otherwise(response)
    )


def json_list(block: Column) -> Column:
    """The block as JSON list text; a single object counts as a list of one."""
    text = F.trim(block)
    return F.when(F.startswith(text, F.lit("{")), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)


def bbox_lines(response: Column) -> Column:
    """Array of {class, bbox} from `[class,x1,y1,x2,y2]` lines; comments and unparsable lines skipped."""
    lines = F.transform(F.split(F.trim(response), "\n"), lambda s: F.trim(s))
    lines = F.filter(lines, lambda s: (F.length(s) > 0) & ~F.startswith(s, F.lit("#")))

    # In steps, so that no part is computed twice.
    parts = F.transform(lines, lambda s: F.transform(F.split(F.translate(s, "[]", ""), ","), lambda t: F.trim(t)))
    boxes = F.transform(F.filter(parts, lambda p: F.size(p) >= 5), lambda p: F.struct(F.get(p, F.lit(0)).alias("class"), F.transform(F.slice(p, 2, 4), as_float).alias("bbox")))
    return F.filter(boxes, lambda b: ~F.exists(b["bbox"], lambda v: v.isNull()))


def _plain(label: Column) -> Column:
    return F.replace(F.lower(F.trim(label)), F.lit("_"), F.lit(" "))


def label_matches(label: Column, target: Column) -> Column:
    """Loose label equality: equal, one inside the other, or a shared word; blank labels match all."""
    a, b = _plain(label), _plain(target)
    words = lambda s: F.filter(F.split(s, r"\s+"), lambda w: F.length(w) > 0)
    blank = label.isNull() | (F.trim(label) == "")
    return blank | (a == b) | F.contains(a, b) | F.contains(b, a) | F.arrays_overlap(words(a), words(b))


def first_matching_class(label: Column, classes) -> Column:
    """First requested class the label matches, in list order, else NULL.

    `classes` is the short list a user asks for, so it is written into the expression.
    """
    if not classes:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(label_matches(label, F.lit(c)), F.lit(c)) for c in classes])


def match_span(label: Column, queries) -> Column:
    """Exact case-insensitive query, else first one contained either way, else the label or "object"."""
    low = F.lower(F.trim(label))
    exact = [F.when(low == q.lower(), F.lit(q)) for q in queries]
    part = [F.when(F.contains(low, F.lit(q.lower())) | F.contains(F.lit(q.lower()), low), F.lit(q)) for q in queries]
    raw = F.when(F.length(F.trim(label)) > 0, label).otherwise(F.lit("object"))
    return F.coalesce(*exact, *part, raw, F.lit("object"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def source_id(name: Column) -> Column:
    """Leading digits of the file stem, NULL when there are none."""
    return F.nullif(F.regexp_extract(stem(name), r"^(\d+)", 1), F.lit(""))


def frame_timestamp(name: Column) -> Column:
    """Integer of an all-digit stem, else NULL."""
    return F.when(stem(name).rlike(r"^[0-9]+$"), stem(name).try_cast("bigint"))


def safe_name(label: Column, max_len=120) -> Column:
    """File-safe class name; long ones are cut and carry 8 digits of their md5."""
    safe = F.regexp_replace(label, r"[^\p{L}\p{N}]", "_")
    cut = F.concat(F.substring(safe, 1, max_len - 9), F.lit("_"), F.substring(F.md5(label), 1, 8))
    return F.when(F.length(safe) > max_len, cut).otherwise(safe)


def label_kind(parts: Column) -> Column:
    """det for five tokens, seg for an even count of at least six coordinates, else det."""
    n = F.size(parts) - 1
    return F.when(F.size(parts) == 5, "det").when((n >= 6) & (n % 2 == 0), "seg").otherwise("det")


def seg_polygon(parts: Column, width: Column, height: Column) -> Column:
    """Pixel polygon (truncated to ints) of a label line of seven or more tokens, else NULL."""
    pairs = F.floor((F.size(parts) - 1) / F.lit(2)).cast("int")
    pts = F.transform(
        F.slice(parts, 2, 2 * pairs),
        lambda v, i: (as_float(v) * F.when(i % 2 == 0, width).otherwise(height)).cast("int"),
    )
    return F.when((F.size(parts) >= 7) & (pairs >= 3), pts)
