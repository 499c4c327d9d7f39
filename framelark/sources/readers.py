"""Files and documents to tables. Readers take paths; the functions behind them work on any text column."""

import re
import struct
import sys
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelark.functions import geometry as geo
from framelark.functions import text
from framelark.operators.frames import check_poses
from framelark.operators.scale import computed_once, cut

# What tasks call travels with them: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed list of image suffixes.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")

# Fixed document shapes. Ids are read as text because some writers quote them.
_PARTS = {
    "images": "id:STRING,file_name:STRING,width:INT,height:INT,timestamp_ns:BIGINT,log_time_ns:BIGINT,frame_idx:BIGINT,side:STRING",
    "annotations": "id:STRING,image_id:STRING,category_id:STRING,bbox:ARRAY<DOUBLE>,area:DOUBLE,iscrowd:INT,segmentation:ARRAY<ARRAY<DOUBLE>>,track_id:STRING,confidence:DOUBLE,source:STRING",
    "categories": "id:STRING,name:STRING",
}
COCO = ", ".join(f"{part} ARRAY<STRUCT<{fields}>>" for part, fields in _PARTS.items())
_PREDICTION = "image_id:STRING,class_id:INT,category_id:INT,bbox:ARRAY<DOUBLE>,bbox_2d:ARRAY<DOUBLE>,confidence:DOUBLE,score:DOUBLE,label:STRING"
_LIST_KEYS = ("predictions", "results", "data", "bboxes", "parsed_output")


def coco_tables(docs: DataFrame, doc="doc"):
    """(images, annotations, categories) of documents given as JSON text; a missing part raises.

    Keys outside the known columns stay in `extra`, a map of text. Columns other than `doc` name the input.
    """
    by = [c for c in docs.columns if c != doc]
    shape = "images ARRAY<MAP<STRING,STRING>>, annotations ARRAY<MAP<STRING,STRING>>"
    docs = computed_once(docs, {doc: F.col(doc)})
    parsed = docs.withColumn("_d", F.from_json(doc, COCO)).withColumn("_m", F.from_json(doc, shape))
    lost = parsed.filter("_d.images is null or _d.annotations is null or _d.categories is null").take(1)
    if lost:
        raise ValueError("document lacks images, annotations or categories")

    each = {part: parsed.select(*by, F.posexplode(F.arrays_zip(F.col(f"_d.{part}").alias("r"), F.col(f"_m.{part}").alias("m"))).alias("pos", "z")).select(*by, "pos", "z.r", "z.m")
            for part in ("images", "annotations")}
    each["categories"] = parsed.select(*by, F.posexplode("_d.categories").alias("pos", "r"))
    return _tables(each, by)


def _tables(each, by):
    """The tables of the elements of each part: by, pos, r (known fields) and m (all fields as text)."""

    def rows(part):
        known = [f.split(":")[0] for f in _PARTS[part].split(",")]
        rest = F.map_filter("m", lambda k, v: ~k.isin(known))
        return each[part].select(*by, "pos", "r.*", F.when(F.size(rest) > 0, rest).alias("extra"))

    images = rows("images")
    images = images.withColumns({"id": F.col("id").cast("long"), "side": F.coalesce("side", F.lit("left"))}).withColumnRenamed("id", "image_id")
    anns = rows("annotations")
    at = lambda i: F.get("bbox", F.lit(i))
    anns = anns.withColumns({
        "id": F.col("id").cast("long"), "image_id": F.col("image_id").cast("long"), "category_id": F.col("category_id").cast("int"),
        "track_id": text.as_int(F.col("track_id")), "x1": at(0), "y1": at(1), "x2": at(0) + at(2), "y2": at(1) + at(3),
    }).withColumnRenamed("id", "ann_id").drop("bbox")
    cats = each["categories"].select(*by, "pos", F.col("r.id").cast("int").alias("category_id"), F.col("r.name").alias("name"))
    return images, anns, cats


def unite_images(images: DataFrame, by=()) -> DataFrame:
    """One row per image of documents that repeat the entry of an image cut into slices."""
    return images.dropDuplicates([*by, "image_id"])


def read_coco(spark: SparkSession, path: str):
    """COCO files (any number, one document each, a document within a task) to tables, with the path as `source`."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("doc"))
    return coco_tables(docs)


_MARKS = {"images": "\u0001", "annotations": "\u0002", "categories": "\u0003"}
_OTHER_MARK = "\u0004"


def _unescaped(value):
    """A piece without its escapes; few have any."""
    return F.when(F.contains(value, F.lit("\\")), F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)


def _skeleton(bare, inside):
    """Brackets of a piece without escapes outside its strings, with a mark before the opening bracket that a key has;
    `inside` says that it begins in a string."""
    # The sign keeps the end of a string from being taken for a key.
    text_ = F.concat(F.lit('"\u0006'), bare) if inside else bare

    def brackets(v):
        v = F.regexp_replace(v, r'"[^"]*+(?:"|$)', "\u0005")
        return F.regexp_replace(F.regexp_replace(v, r"\x05\s*:\s*([\[{])", f"{_OTHER_MARK}$1"), r"[^\[\]{\x01-\x04]++", "")

    named = text_
    for part, mark in _MARKS.items():
        named = F.regexp_replace(named, rf'"{part}"\s*:\s*\[', f"{mark}[")
    has = reduce(lambda a, b: a | b, [F.contains(bare, F.lit(f'"{part}')) | F.contains(bare, F.lit(f'{part}"')) for part in _MARKS])
    return F.when(has, brackets(named)).otherwise(brackets(text_))


def _runs(batch):
    """(first row, row after the last) of each run of one block in a batch; rows of a block come together and in order."""
    source, block = batch.column("source"), batch.column("block")
    change = pc.or_(pc.not_equal(source[1:], source[:-1]), pc.not_equal(block[1:], block[:-1]))
    edges = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    return zip(edges, edges[1:])


def _rises(skeletons):
    """Opening less closing brackets of each skeleton; few differ."""
    coded = skeletons.dictionary_encode()
    each = [s.count("[") + s.count("{") - s.count("]") for s in coded.dictionary.to_pylist()]
    return np.array(each, np.int64)[coded.indices.to_numpy()]


def _block_sums(batches):
    """Of each block the parity of its quotes, and by how much it is deeper at its end if it begins outside (out) or
    inside (within) a string."""
    key = None
    for b in batches:
        done = []
        quotes, out, within = b.column("quotes").to_numpy(), _rises(b.column("out")), _rises(b.column("within"))
        for i, j in _runs(b) if b.num_rows else ():
            if (at := (b.column("source")[i].as_py(), b.column("block")[i].as_py())) != key:
                if key is not None:
                    done.append((*key, odd, *rise))
                key, odd, rise = at, 0, [0, 0]
            upto = (odd + np.cumsum(quotes[i:j])) & 1
            before = (upto - quotes[i:j]) & 1
            for inside in (0, 1):
                # The brace a piece ends at counts unless it is in a string.
                rise[inside] += int(np.where(before != inside, within[i:j], out[i:j]).sum() - (upto == inside).sum())
            odd = int(upto[-1])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _SUMS.types)], schema=_SUMS)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*key, odd, *rise), _SUMS.types)], schema=_SUMS)


_SUMS = pa.schema([("source", pa.string()), ("block", pa.int64()), ("odd", pa.int64()), ("out", pa.int64()), ("within", pa.int64())])


def _layout(skeleton):
    """(opening less closing brackets, {depth before it: [(mark, how many of its kind up to it)]}) of a skeleton."""
    rise, at, kinds = 0, {}, {}
    for c in skeleton:
        if c in "[{":
            rise += 1
        elif c == "]":
            rise -= 1
        else:
            kinds[c] = kinds.get(c, 0) + 1
            at.setdefault(rise, []).append((c, kinds[c]))
    return rise, at


def _after_key(value, mark, nth):
    """What follows the opening bracket of the nth list of a part in a piece."""
    for n, found in enumerate(_KEYS[mark].finditer(value), 1):
        if n == nth:
            return value[found.end():]
    return value


def _elements(batches):
    """Elements of the known parts, in order of their block. In a document of several blocks, what ends at the first end of
    a block and what is left after its last are fragments. The last row of a block has what it counted."""
    layouts, key = {}, None

    def tail():
        kept = "" if mark == _OTHER_MARK or alone else "".join(f"{v}}}" for v in held)
        return (*key, alone, True, False, k, mark, None, fresh, kept, [n[m] for m in (None, *_MARKS.values())], sorted(seen))

    for b in batches:
        done = []
        for i, j in _runs(b) if b.num_rows else ():
            part = b.slice(i, j - i)
            if (at := (part.column("source")[0].as_py(), part.column("block")[0].as_py())) != key:
                if key is not None:
                    done.append(tail())
                key, alone, inside, depth = at, *(part.column(c)[0].as_py() for c in ("alone", "inside", "depth"))
                if inside is None:
                    raise ValueError(f"the blocks of {key[0]} changed while it was read")
                k, mark, fresh, held, seen, n = 0, None, False, [], set(), dict.fromkeys((None, *_MARKS.values()), 0)
            for value, quotes, out, within in zip(*(part.column(c).to_pylist() for c in ("value", "quotes", "out", "within")), strict=True):
                skeleton = within if inside else out
                inside ^= quotes & 1
                if (layout := layouts.get(skeleton)) is None:
                    if len(layouts) == _LAYOUTS:
                        layouts.clear()
                    layout = layouts[skeleton] = _layout(skeleton)
                found = layout[1].get(1 - depth)
                depth += layout[0] - (not inside)
                if found:
                    seen.update(m for m, _ in found)
                    mark, nth = found[-1]
                    held, fresh = [] if mark == _OTHER_MARK else [_after_key(value, mark, nth)], True
                elif mark != _OTHER_MARK:
                    held.append(value)
                if depth == 2 and not inside:
                    if mark != _OTHER_MARK:
                        done.append((*key, alone, not alone and k == 0, True, 0, mark, n[mark], fresh, "".join(f"{v}}}" for v in held), None, None))
                        n[mark] += 1
                    held, fresh, k = [], False, k + 1
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _ROWS.types)], schema=_ROWS)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(tail(), _ROWS.types)], schema=_ROWS)


_KEYS = {mark: re.compile(rf'(?<!\\)"{part}"\s*:\s*\[') for part, mark in _MARKS.items()}
_LAYOUTS = 10_000  # remembered
# n: ends of elements in the block before this row, counts: elements of no part yet and of each part in the block.
_ROWS = pa.schema([
    ("source", pa.string()), ("block", pa.int64()), ("alone", pa.bool_()), ("fragment", pa.bool_()), ("ends", pa.bool_()), ("n", pa.int64()), ("part", pa.string()),
    ("i", pa.int64()), ("fresh", pa.bool_()), ("body", pa.string()), ("counts", pa.list_(pa.int64())), ("seen", pa.list_(pa.string()))])
_ROWS_SQL = "source string, block bigint, alone boolean, fragment boolean, ends boolean, n bigint, part string, i bigint, fresh boolean, body string, counts array<bigint>, seen array<string>"


@contextmanager
def _same_blocks(spark):
    """Files are cut into the same blocks by every read in here, however many cores come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(before or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def read_large_coco(spark: SparkSession, path: str):
    """`read_coco` for documents of any size: a document is read by as many tasks as its bytes make.

    Text splits at closing braces, wherever a task's share (a block) begins. A first read sums up the blocks of documents
    that have several; running sums over these, a row a block, tell which begin inside a string and how deep. A second
    read then takes each block from there: a brace that closes at depth two of a known part ends an element. Text moves
    nowhere but for the elements that go over the end of a block. Memory is bounded by one element.
    """
    bare, by_block = F.col("bare"), Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_block), F.lit(0))
    meta = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "source"), ("file_block_start", "block"))]
    alone = (F.col("_metadata.file_block_length") == F.col("_metadata.file_size")).alias("alone")

    def pieces(rows, *more):
        split = rows.select("*", _unescaped(F.col("value")).alias("bare"))
        return split.select("source", "block", *more, (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).cast("long").alias("quotes"),
                            _skeleton(bare, False).alias("out"), _skeleton(bare, True).alias("within"))

    with _same_blocks(spark):
        read = spark.read.option("lineSep", "}").text(path).select(*meta, alone, "value")
        # Documents of one block need no first read; counting pieces takes no look into them.
        several = read.filter("not alone").count() > 0
        known = read.withColumns({"inside": F.lit(0).cast("long"), "depth": F.lit(0).cast("long")})
        if several:
            sums = cut(pieces(read.filter("not alone")).mapInArrow(_block_sums, "source string, block bigint, odd bigint, out bigint, within bigint"))
            start = sums.withColumn("inside", before("odd") % 2)
            start = start.withColumn("depth", before(F.when(F.col("inside") == 1, F.col("within")).otherwise(F.col("out")))).select("source", "block", "inside", "depth")
            # A row for each block of a document that has several.
            known = read.join(F.broadcast(start), ["source", "block"], "left")
            known = known.withColumns({c: F.when(F.col("alone"), 0).otherwise(F.col(c)).cast("long") for c in ("inside", "depth")})
        rows = cut(pieces(known, "alone", "inside", "depth", "value").mapInArrow(_elements, _ROWS_SQL), codec="zstd")
    last = rows.filter("not ends")
    have = last.select("source", F.explode_outer("seen").alias("m")).groupBy("source").agg(F.count_distinct(F.when(F.col("m") != _OTHER_MARK, F.col("m"))).alias("parts"))
    if have.filter(F.col("parts") < len(_MARKS)).take(1):
        raise ValueError("document lacks images, annotations or categories")
    found = rows.filter("not fragment").select("source", "block", "part", "i", "body")
    if several:
        found = _stitched(rows, last.filter("not alone"), found, by_block, before)
    each = {}
    for part, mark in _MARKS.items():
        body = F.regexp_replace("body", r"^\s*,?\s*", "")
        each_of = found.filter(F.col("part") == mark).select("source", F.col("i").cast("int").alias("pos"), body.alias("body"))
        each[part] = each_of.select("source", "pos", F.from_json("body", f"STRUCT<{_PARTS[part]}>").alias("r"), F.from_json("body", "MAP<STRING,STRING>").alias("m"))
    return _tables(each, ["source"])


def _stitched(rows, cuts, found, by_block, before):
    """Elements of documents of one and of several blocks, with the part and the number they have in their document."""
    marks = list(_MARKS.values())
    blocks = cuts.select("source", "block", "n", "part", "counts").withColumn("carried", F.last("part", ignorenulls=True).over(by_block))
    of = lambda m, i: F.get("counts", F.lit(i)) + F.when(F.col("carried") == m, F.get("counts", F.lit(0))).otherwise(0)
    own = [F.when(F.col("carried") == m, F.get("counts", F.lit(0))).otherwise(0) for m in marks]
    blocks = cut(blocks.select("source", "block", "carried", before("n").alias("ended"), F.array(*[before(of(m, i)) for i, m in enumerate(marks, 1)]).alias("earlier"), F.array(*own).alias("own")))
    pieces = rows.filter("fragment").join(F.broadcast(blocks.select("source", "block", "ended")), ["source", "block"])
    item = F.struct("block", "ends", "part", "i", "fresh", "body")
    whole = pieces.groupBy("source", (F.col("ended") + F.col("n")).alias("element")).agg(F.array_sort(F.collect_list(item)).alias("l"))
    whole = whole.withColumn("end", F.element_at("l", -1)).filter("end.ends")
    # The text before the key of a part is no part of its first element.
    body = F.aggregate("l", F.lit(""), lambda text_, x: F.when(x["fresh"], x["body"]).otherwise(F.concat(text_, x["body"])))
    found = found.unionByName(whole.select("source", "end.block", "end.part", "end.i", body.alias("body")))
    found = found.join(F.broadcast(blocks), ["source", "block"], "left")
    part = F.coalesce("part", "carried")
    nth = F.array_position(F.array(*[F.lit(m) for m in marks]), part).cast("int") - 1
    shift = F.get("earlier", nth) + F.when(F.col("part").isNotNull(), F.get("own", nth)).otherwise(0)
    return found.select("source", "block", part.alias("part"), (F.col("i") + F.coalesce(shift, F.lit(0))).alias("i"), "body")


def label_lines(files: DataFrame, body="body") -> DataFrame:
    """Lines of label texts: stem, line_num from 1; blank lines are skipped but counted."""
    lines = files.select("stem", F.posexplode(F.split(body, "\r?\n")).alias("_i", "line"))
    return lines.filter(F.length(F.trim("line")) > 0).select("stem", (F.col("_i") + 1).alias("line_num"), F.trim("line").alias("line"))


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Label lines of a folder of text files. Empty files give no row, so file counts must come from the
    image listing."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select(
        text.stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("body"))
    return label_lines(files)


def read_label_files(files: DataFrame, folder: str) -> DataFrame:
    """split, stem and body of the label files a listing (split, stem) names; many small files to a task."""

    def run(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            split, stem = b.column("split").to_pylist(), b.column("stem").to_pylist()
            bodies = []
            for s, n in zip(split, stem, strict=True):
                with store.open_input_stream(f"{base}/{s}/{n}.txt") as f:
                    bodies.append(f.read().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_pydict({"split": split, "stem": stem, "body": bodies})

    return files.select("split", "stem").mapInArrow(run, "split string, stem string, body string")


def image_listing(paths: DataFrame, path="path") -> DataFrame:
    """Image files of a listing by suffix in any case: path, file_name, stem."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^.]*)$", 1))
    return paths.filter(suffix.isin(*IMAGE_SUFFIXES)).select(
        F.col(path).alias("path"), text.basename(F.col(path)).alias("file_name"), text.stem(F.col(path)).alias("stem"))


def image_size(head: bytes):
    """(width, height) out of the first bytes of an image file, or None."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"BM" and len(head) >= 26:
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    if head[:4] == b"RIFF" and head[8:12] == b"WEBP" and len(head) >= 30:
        if head[12:16] == b"VP8X":
            return tuple(1 + int.from_bytes(head[i : i + 3], "little") for i in (24, 27))
        if head[12:16] == b"VP8L":
            bits = int.from_bytes(head[21:25], "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        return tuple(v & 0x3FFF for v in struct.unpack("<HH", head[26:30]))
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(head) and head[at] == 0xFF:
            kind, size = head[at + 1], int.from_bytes(head[at + 2 : at + 4], "big")
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", head[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


def with_image_size(listing: DataFrame, head_bytes=262_144) -> DataFrame:
    """Adds width and height, read from the first bytes of each file of `path`; null where they do not tell.

    PNG, JPEG, BMP and WebP are known; a file that is gone or cannot be read gives null.
    """
    names = listing.columns

    def run(batches):
        for b in batches:
            sizes = []
            for path in b.column("path").to_pylist():
                try:
                    store, at = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
                    with store.open_input_stream(at) as f:
                        sizes.append(image_size(f.read(head_bytes)) or (None, None))
                except OSError:
                    sizes.append((None, None))
            width, height = (pa.array([s[i] for s in sizes], pa.int32()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), width, height], [*names, "width", "height"])

    kinds = ", ".join(f"`{c}` {k}" for c, k in listing.dtypes)
    return listing.mapInArrow(run, f"{kinds}, width int, height int")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Image files directly in a folder; only names are read, not contents (see `with_image_size`)."""
    return image_listing(spark.read.format("binaryFile").load(folder).select("path", "length"))


def class_names(lines: DataFrame) -> DataFrame:
    """class_id and name from numbered lines (pos, value) of a class list; blank lines drop out."""
    return lines.filter(F.length(F.trim("value")) > 0).select(F.col("pos").cast("int").alias("class_id"), F.trim("value").alias("name"))


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """Class list from a text file with one name per line, or from `names` of a dataset description."""
    doc = spark.read.text(path, wholetext=True)
    if not path.endswith((".yaml", ".yml")):
        return class_names(doc.select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "value")))
    flow = F.regexp_extract("value", r"(?m)^names:\s*\[([^\]]*)\]", 1)
    listed = doc.select(F.posexplode(F.split(flow, ",")).alias("class_id", "name")).filter("trim(name) <> ''")
    block = F.regexp_extract("value", r"(?ms)^names:[ \t]*\r?\n((?:[ \t]+[^\n]*\n?|-[^\n]*\n?)+)", 1)
    items = doc.select(F.posexplode(F.regexp_extract_all(block, F.lit(r"(?m)^[ \t]*((?:-|[0-9]+:)[^\n]*)$"), F.lit(1))).alias("_i", "_t"))
    num = F.regexp_extract("_t", r"^([0-9]+):", 1)
    mapped = items.select(F.when(num != "", num.try_cast("int")).otherwise(F.col("_i")).alias("class_id"),
                          F.regexp_replace("_t", r"^(-|[0-9]+:)\s*", "").alias("name"))
    return listed.unionByName(mapped).select("class_id", F.trim(F.regexp_replace("name", "['\"\r]", "")).alias("name"))


def with_class_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Add class_name, class_<id> where the list has none."""
    return rows.join(names, "class_id", "left").withColumn(
        "class_name", F.coalesce("name", F.concat(F.lit("class_"), F.col("class_id")))).drop("name")


RESULT = "image STRING, model STRING, format STRING, raw_response STRING, parsed_output STRING"


def vlm_results(docs: DataFrame, doc="doc", name="file_name"):
    """(readable results with the columns of the document, names of unreadable ones)."""
    parsed = docs.withColumn("_ok", F.try_parse_json(doc).isNotNull()).withColumn("_d", F.from_json(doc, RESULT))
    good = parsed.filter("_ok").select(*[c for c in docs.columns if c != doc], "_d.*")
    return good, parsed.filter("not _ok").select(name)


def read_vlm_results(spark: SparkSession, folder: str):
    docs = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(
        text.basename(F.col("_metadata.file_path")).alias("file_name"), F.col("value").alias("doc"))
    return vlm_results(docs)


def predictions(docs: DataFrame, doc="doc") -> DataFrame:
    """Predictions of JSON documents: a bare list, or a list under one of the usual keys.

    Output: the other columns, pos, image_id, class_id, label, confidence, x1..y2.
    """
    by = [c for c in docs.columns if c != doc]
    shape = F.from_json(doc, ", ".join(f"{k} ARRAY<STRUCT<{_PREDICTION}>>" for k in _LIST_KEYS))
    bare = F.when(F.startswith(F.trim(F.col(doc)), F.lit("[")), F.from_json(doc, f"ARRAY<STRUCT<{_PREDICTION}>>"))
    # The lambda binds the parsed document, which is otherwise parsed again for each of its keys.
    keyed = F.get(F.transform(F.array(shape), lambda s: F.coalesce(*[s[k] for k in _LIST_KEYS])), F.lit(0))
    rows = docs.select(*by, F.coalesce(bare, keyed).alias("_l"))
    got = rows.select(*by, F.posexplode("_l").alias("pos", "p"))
    b = F.coalesce("p.bbox_2d", "p.bbox")
    return got.select(
        *by, "pos", F.col("p.image_id").alias("image_id"), F.coalesce("p.class_id", "p.category_id").alias("class_id"), F.col("p.label").alias("label"),
        F.coalesce("p.confidence", "p.score").alias("confidence"), *[F.get(b, F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("doc"))
    return predictions(docs)


def discover_splits(paths: DataFrame, path="path") -> DataFrame:
    """Split of each label file by its folder: <split>/labels, labels/<split>, or labels alone (all)."""
    before = F.regexp_extract(path, r"(?:^|/)(train|val|valid|test)/labels/[^/]*\.txt$", 1)
    after = F.regexp_extract(path, r"(?:^|/)labels/(train|val|valid|test)/[^/]*\.txt$", 1)
    flat = F.col(path).rlike(r"(?:^|/)labels/[^/]*\.txt$")
    name = F.when(before != "", before).when(after != "", after).when(flat, "all")
    found = paths.withColumn("split", F.when(name == "valid", "val").otherwise(name)).filter("split is not null")
    return found.withColumn("stem", text.stem(F.col(path)))


def read_split_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label lines of a data set by split: split, stem, line_num, line. Label files outside a split count
    (as `all`) only where there is no split."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    found = discover_splits(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))
    named = found.filter("split <> 'all'")
    kept = require_splits(found) if named.isEmpty() else named
    return label_lines(kept.withColumn("stem", F.struct("split", "stem"))).select("stem.split", "stem.stem", "line_num", "line")


def require_splits(found: DataFrame) -> DataFrame:
    if found.isEmpty():
        raise ValueError("no label folders found")
    return found


def read_pose_table(poses: DataFrame) -> DataFrame:
    """Pose rows of any source with NaN as NULL; refused when empty or without a camera pose."""
    nums = [f"{k}_{a}" for k in ("cam", "lidar") for a in "xyz"]
    return check_poses(poses.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in nums}))


def keyframe_boxes(images: DataFrame, anns: DataFrame, manifest: DataFrame, keys=()) -> DataFrame:
    """Reviewed boxes of the keyframes in a manifest, joined on the file's base name.

    images: keys, image_id, file_name; anns: keys, ann_id, image_id, category_id, x, y, w, h; manifest:
    keys, frame_idx, file_name. Boxes without extent and images outside the manifest drop out; nothing
    left raises.
    """
    keys = list(keys)
    m = manifest.select(*keys, "frame_idx", text.basename(F.col("file_name")).alias("_base"))
    im = images.select(*keys, "image_id", text.basename(F.col("file_name")).alias("_base")).join(m, [*keys, "_base"])
    out = anns.filter("w > 0 and h > 0").join(im.drop("_base"), [*keys, "image_id"])
    c = geo.xyxy_to_center(*geo.xywh_to_xyxy(*[F.col(k) for k in ("x", "y", "w", "h")]))
    out = out.select(*keys, "frame_idx", F.col("ann_id").alias("id"), "category_id", c[0].alias("cx"), c[1].alias("cy"), "w", "h")
    if out.isEmpty():
        raise ValueError("no keyframe box matches the manifest")
    return out


MARKS = "last_index BIGINT, reviewed ARRAY<BIGINT>, keyframes ARRAY<BIGINT>, annotated_marks ARRAY<BIGINT>, discarded ARRAY<BIGINT>"


def session_marks(docs: DataFrame, doc="doc") -> DataFrame:
    """One row per mark of progress documents: the other columns, kind, frame_idx."""
    by = [c for c in docs.columns if c != doc]
    d = docs.withColumn("_d", F.from_json(doc, MARKS))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_d.{k}").alias("ix")) for k in ("reviewed", "keyframes", "annotated_marks", "discarded")])
    return d.select(*by, F.explode(kinds).alias("k")).select(*by, "k.kind", F.explode("k.ix").alias("frame_idx"))


def read_session_marks(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("session"), F.col("value").alias("doc"))
    return session_marks(docs)


def per_class_annotations(docs: DataFrame, images: DataFrame, doc="doc") -> DataFrame:
    """Boxes of per-class files: image, class_name, pos, x1..y2, clipped to the image.

    docs: image, doc; images: image, width, height. Bad files and classes without a valid box drop out.
    """
    d = docs.withColumn("_d", F.from_json(doc, "class_name STRING, image STRING, bboxes ARRAY<ARRAY<DOUBLE>>"))
    rows = d.select("image", F.col("_d.class_name").alias("class_name"), F.posexplode("_d.bboxes").alias("pos", "b")).filter(F.size("b") == 4)
    c, keep = geo.clip_box([F.get("b", F.lit(i)) for i in range(4)], F.col("width").cast("double"), F.col("height").cast("double"))
    return rows.join(images, "image").filter(keep).select("image", "class_name", "pos", *[v.alias(n) for v, n in zip(c, ("x1", "y1", "x2", "y2"))])


def read_per_class_annotations(spark: SparkSession, folder: str, images: DataFrame) -> DataFrame:
    docs = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(
        F.regexp_extract("_metadata.file_path", r"([^/]*)/[^/]*$", 1).alias("image"), F.col("value").alias("doc"))
    return per_class_annotations(docs, images)
