"""Detection tables derived from the driver's tables, as SQL both Spark and DuckDB run alike.

The reference's inputs are camera data; these statements give the driver tables that shape: line items
become boxes, orders images, events frames of two cameras, parts keyframe boxes, customers poses.
Missed, spurious and re-classed detections, dropped frames and absent poses are part of the shape;
every row of the source table is used, but for the rows whose absence is that shape.
"""

import re

from pyspark.sql import DataFrame, SparkSession

from framelark.operators.scale import cut

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DERIVED = {
    "fx_gt": r"""
SELECT image_id, image_id * 100 + rn AS ann_id, CAST(l_suppkey % 5 AS INT) AS category_id,
       CAST((l_partkey * 7) % 80 AS DOUBLE) AS x1, CAST((l_suppkey * 13) % 60 AS DOUBLE) AS y1,
       CAST((l_partkey * 7) % 80 + 20 + l_partkey % 41 AS DOUBLE) AS x2,
       CAST((l_suppkey * 13) % 60 + 20 + l_suppkey % 31 AS DOUBLE) AS y2
FROM (SELECT l_orderkey AS image_id, l_partkey, l_suppkey,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
               l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS rn FROM lineitem) t
""",
    "fx_pred": r"""
SELECT image_id, ann_id * 2 AS pred_id,
       CASE WHEN ann_id % 11 = 0 THEN (category_id + 1) % 5 ELSE category_id END AS category_id,
       x1 + (ann_id % 7) - 3 AS x1, y1 + (ann_id % 5) - 2 AS y1,
       x2 + (ann_id % 7) - 3 AS x2, y2 + (ann_id % 5) - 2 AS y2,
       CAST((ann_id * 7919) % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS confidence
FROM fx_gt WHERE (ann_id * 31) % 10 < 9
UNION ALL
SELECT image_id, ann_id * 2 + 1, category_id, x1 + 200, y1, x2 + 200, y2,
       CAST((ann_id * 104729) % 997 AS DOUBLE) / CAST(997 AS DOUBLE)
FROM fx_gt WHERE ann_id % 8 = 0
""",
    "fx_image": r"""
SELECT o_orderkey AS image_id, CAST(640 AS INT) AS width, CAST(480 AS INT) AS height,
       concat(CAST(1700000000000000000 + o_orderkey * 100000000 AS STRING), '.jpg') AS file_name,
       1700000000000000000 + o_orderkey * 100000000 AS timestamp_ns,
       CASE WHEN o_orderkey % 100 < 70 THEN 'train' WHEN o_orderkey % 100 < 85 THEN 'test' ELSE 'val' END AS split
FROM orders
""",
    "fx_frame": r"""
SELECT side, ts AS timestamp_ns, concat(CAST(ts AS STRING), '.jpg') AS file_name
FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END AS side,
             1700000000000000000 + (event_id - event_id % 2) * 50000000 AS ts FROM events) t
WHERE event_id % 13 <> 0 AND event_id % 29 <> 0
""",
    "fx_keybox": r"""
SELECT video_id, frame_idx, p_partkey AS ann_id, category_id,
       CAST(obj * 70 + kf * 4 + p_partkey % 5 AS DOUBLE) AS x, CAST(obj * 30 + kf * 2 + p_partkey % 3 AS DOUBLE) AS y,
       CAST(30 + p_partkey % 11 AS DOUBLE) AS w, CAST(24 + p_partkey % 7 AS DOUBLE) AS h
FROM (SELECT p_partkey, p_partkey % 5 AS obj, ((p_partkey - p_partkey % 5) / 5) % 20 AS kf_raw,
             CAST(((p_partkey - p_partkey % 5) / 5) % 20 AS BIGINT) AS kf,
             CAST((p_partkey - p_partkey % 100) / 100 AS BIGINT) AS video_id,
             CAST(((p_partkey - p_partkey % 5) / 5) % 20 AS BIGINT) * 5 AS frame_idx,
             CAST(p_partkey % 5 % 3 AS INT) AS category_id FROM part) t
WHERE p_partkey % 17 <> 0
""",
    "fx_pose": r"""
SELECT c_custkey AS pose_id, concat(CAST(c_custkey AS STRING), '.jpg') AS filename,
       1700000000000000000 + c_custkey * 1000000000 + (c_custkey * 37 % 100) * 1000000 AS timestamp_ns,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 211 AS DOUBLE) END AS cam_x,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 97 AS DOUBLE) END AS cam_y,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 13 AS DOUBLE) END AS cam_z,
       CASE WHEN c_custkey % 27 = 0 THEN NULL ELSE CAST(c_custkey % 211 + 1 AS DOUBLE) END AS lidar_x,
       CASE WHEN c_custkey % 27 = 0 THEN NULL ELSE CAST(c_custkey % 97 + 1 AS DOUBLE) END AS lidar_y,
       CASE WHEN c_custkey % 27 = 0 THEN NULL ELSE CAST(c_custkey % 13 + 1 AS DOUBLE) END AS lidar_z
FROM customer
""",
    "fx_label_line": r"""
SELECT CAST(image_id AS STRING) AS stem, CAST(ann_id % 100 AS INT) AS line_num,
       CASE WHEN ann_id % 41 = 0 THEN concat('x ', g)
            WHEN ann_id % 43 = 0 THEN concat('-1 ', g)
            WHEN ann_id % 47 = 0 THEN concat(CAST(category_id AS STRING), ' 320 240 0.100 0.100')
            WHEN ann_id % 53 = 0 THEN concat(CAST(category_id AS STRING), ' 0.5 0.5 0.1')
            WHEN ann_id % 59 = 0 THEN concat(CAST(category_id AS STRING), ' 0.5 0.5 0.0005 0.2')
            WHEN ann_id % 10 = 0 THEN concat(CAST(category_id AS STRING), ' 0.1 0.1 0.3 0.1 0.3 0.', LPAD(CAST(ann_id % 1000 AS STRING), 3, '0'))
            ELSE concat(CAST(category_id AS STRING), ' ', g) END AS line
FROM (SELECT image_id, ann_id, category_id,
        concat('0.', LPAD(CAST(CAST(x1 AS INT) + 100 AS STRING), 3, '0'), ' 0.', LPAD(CAST(CAST(y1 AS INT) + 100 AS STRING), 3, '0'),
               ' 0.', LPAD(CAST(CAST(x2 - x1 AS INT) AS STRING), 3, '0'), ' 0.', LPAD(CAST(CAST(y2 - y1 AS INT) AS STRING), 3, '0')) AS g
      FROM fx_gt) t
""",
    "fx_vlm": r"""
SELECT image_id, concat(CASE WHEN image_id % 3 = 0 THEN concat('Here: ', '```json', chr(10)) ELSE '' END,
        CASE WHEN image_id % 37 = 0 THEN '[{"label": oops' ELSE concat('[', listagg(item, ', ') WITHIN GROUP (ORDER BY ann_id), ']') END,
        CASE WHEN image_id % 3 = 0 THEN concat(chr(10), '```') ELSE '' END) AS response
FROM (SELECT image_id, ann_id, concat('{"label": "', label, '", "bbox_2d": [', CAST(CAST(x1 AS INT) AS STRING), ', ', CAST(CAST(y1 AS INT) AS STRING), ', ',
          CAST(CAST(x2 AS INT) AS STRING), ', ', CAST(CAST(y2 AS INT) AS STRING), ']}') AS item FROM fx_label) t GROUP BY image_id
""",
    "fx_label": r"""
SELECT image_id, ann_id, x1, y1, x2, y2,
       CASE category_id WHEN 0 THEN 'Exit_Sign' WHEN 1 THEN 'ceiling light' WHEN 2 THEN 'a map on the wall' ELSE 'robot' END AS label
FROM fx_gt
""",
}

# Tables that number rows inside groups: queries and other tables read them several times, so they are written once.
WRITTEN = ("fx_gt",)

# Spark's ordered aggregate of text, and how the other engine writes it.
_LISTAGG = re.compile(r"listagg\((\w+), ', '\) WITHIN GROUP \(ORDER BY (\w+)\)")


def _deps(sql: str):
    return [n for n in [*BASE, *DERIVED] if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)]


class Tables:
    """Lazy access to base and derived tables of one scale folder: tables.fx_gt, tables.orders."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._made = spark, folder, {}

    def __getattr__(self, name) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in DERIVED:
                made = self.sql(DERIVED[name])
                self._made[name] = cut(made) if name in WRITTEN else made
            else:
                self._made[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        deps = _deps(text)
        text = text.replace("{", "{{").replace("}", "}}")
        for n in deps:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
        return self._spark.sql(text, **{n: getattr(self, n) for n in deps})


def with_tables(body: str, recursive=False, **ctes) -> str:
    """`body` preceded by the derived tables it needs (and the given named statements)."""
    need, seen = [], set()

    def visit(sql):
        for n in _deps(sql):
            if n in DERIVED and n not in seen:
                seen.add(n)
                visit(DERIVED[n])
                need.append((n, _LISTAGG.sub(r"string_agg(\1, ', ' ORDER BY \2)", DERIVED[n])))

    for sql in ctes.values():
        visit(sql)
    visit(body)
    named = need + list(ctes.items())
    if not named:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({s.strip()})" for n, s in named) + "\n" + body.strip()
