"""Frames, poses, keyframes and spans."""

from pyspark.sql import functions as F

from framelark.operators import frames, matching
from framelark.plans.registry import query


def _side(t, s):
    return t.fx_frame.filter(F.col("side") == s)


@query("pair_stereo", """
    SELECT timestamp_ns, left_name, right_name, row_number() OVER (ORDER BY timestamp_ns) - 1 AS pair_idx FROM (
      SELECT l.timestamp_ns, min(l.file_name) AS left_name, min(r.file_name) AS right_name FROM fx_frame l JOIN fx_frame r USING (timestamp_ns)
      WHERE l.side = 'left' AND r.side = 'right' GROUP BY 1)""")
def _(t):
    return frames.pair_stereo(_side(t, "left"), _side(t, "right"))


@query("stereo_counts", """
    SELECT count(*) FILTER (l AND r) AS pairs, count(*) FILTER (l AND NOT r) AS left_only, count(*) FILTER (r AND NOT l) AS right_only FROM (
      SELECT timestamp_ns, bool_or(side = 'left') AS l, bool_or(side = 'right') AS r FROM fx_frame GROUP BY 1)""")
def _(t):
    return frames.stereo_counts(_side(t, "left"), _side(t, "right"))


@query("pair_positional", """
    SELECT l.i AS pair_idx, l.file_name AS left_name, r.file_name AS right_name, l.file_name = r.file_name AS same_name
    FROM (SELECT file_name, row_number() OVER (ORDER BY file_name) - 1 AS i FROM fx_frame WHERE side = 'left') l
    JOIN (SELECT file_name, row_number() OVER (ORDER BY file_name) - 1 AS i FROM fx_frame WHERE side = 'right') r USING (i)""")
def _(t):
    return frames.pair_positional(_side(t, "left"), _side(t, "right"))


_NEAR = """
    SELECT q.{id}, CASE WHEN n.ts IS NULL THEN p.{v} WHEN p.ts IS NULL THEN n.{v} WHEN q.timestamp_ns - p.ts <= n.ts - q.timestamp_ns THEN p.{v} ELSE n.{v} END AS {v}
    FROM {q} q ASOF LEFT JOIN {m} p ON q.timestamp_ns >= p.ts ASOF LEFT JOIN {m} n ON q.timestamp_ns <= n.ts"""


@query("nearest_frame", _NEAR.format(id="pose_id", v="file_name", q="fx_pose", m="m"),
       m="SELECT timestamp_ns AS ts, min(file_name) AS file_name FROM fx_frame GROUP BY 1")
def _(t):
    got = frames.nearest_frame(t.fx_pose.select("pose_id", "timestamp_ns"), t.fx_frame, [], ("file_name",))
    return got.select("pose_id", F.col("near.file_name").alias("file_name"))


@query("nearest_synthetic_frame", "SELECT event_id, greatest(0, least(round_even(event_id * 377123 / 1000000, 0), (SELECT count(*) FROM fx_frame WHERE side = 'left') - 1))::BIGINT AS frame_idx FROM events")
def _(t):
    q = t.events.select("event_id", (F.col("event_id") * 377123).alias("timestamp_ns"))
    return frames.nearest_synthetic(q, t.fx_frame.filter("side = 'left'").agg(F.count("*")).scalar()).select("event_id", "frame_idx")


_POSE = "CASE WHEN cam_x IS NOT NULL THEN struct_pack(x := cam_x, y := cam_y, z := cam_z) WHEN lidar_x IS NOT NULL THEN struct_pack(x := lidar_x, y := lidar_y, z := lidar_z) END"


@query("pose_coalesce", f"SELECT pose_id, p.x AS x, p.y AS y, p.z AS z FROM (SELECT pose_id, {_POSE} AS p FROM fx_pose)")
def _(t):
    return t.fx_pose.withColumn("p", frames.pose_coalesce()).select("pose_id", "p.x", "p.y", "p.z")


@query("read_pose_table", "SELECT pose_id, timestamp_ns, cam_x, lidar_x FROM fx_pose")
def _(t):
    from framelark.sources.readers import read_pose_table
    return read_pose_table(t.fx_pose).select("pose_id", "timestamp_ns", "cam_x", "lidar_x")


_LOOK = dict(
    fr="""SELECT file_name, side, timestamp_ns FROM fx_frame
          UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey || '.jpg' ELSE c_custkey || '.png' END, 'left', 1600000000000000000 + c_custkey FROM customer""",
    m="SELECT timestamp_ns AS ts, min(pose_id) AS pose_id FROM fx_pose GROUP BY 1",
)


@query("pose_lookup", f"""
    SELECT n.file_name, n.side, coalesce(f.pose_id, i.pose_id, n.near) AS pose_id,
      CASE WHEN f.pose_id IS NOT NULL THEN 'filename' WHEN i.pose_id IS NOT NULL THEN 'filename_id' WHEN n.near IS NOT NULL THEN 'timestamp' END AS matched_by, p.p.x AS x
    FROM (SELECT q.file_name, q.side, CASE WHEN abs(CASE WHEN nx.ts IS NULL OR q.timestamp_ns - pv.ts <= nx.ts - q.timestamp_ns THEN pv.ts ELSE nx.ts END - q.timestamp_ns) <= 10000000000 THEN
            CASE WHEN nx.ts IS NULL OR q.timestamp_ns - pv.ts <= nx.ts - q.timestamp_ns THEN pv.pose_id ELSE nx.pose_id END END AS near
          FROM fr q ASOF LEFT JOIN m pv ON q.timestamp_ns >= pv.ts ASOF LEFT JOIN m nx ON q.timestamp_ns <= nx.ts) n
    LEFT JOIN fx_pose f ON f.filename = n.file_name
    LEFT JOIN fx_pose i ON i.pose_id = TRY_CAST(regexp_extract(n.file_name, '^([0-9]+)\\.[^.]*$', 1) AS BIGINT)
    LEFT JOIN (SELECT pose_id, {_POSE} AS p FROM fx_pose) p ON p.pose_id = coalesce(f.pose_id, i.pose_id, n.near)""", **_LOOK)
def _(t):
    cust = t.sql("SELECT CASE WHEN c_custkey % 2 = 0 THEN concat(c_custkey, '.jpg') ELSE concat(c_custkey, '.png') END AS file_name, 'left' AS side, 1600000000000000000 + c_custkey AS timestamp_ns FROM customer")
    fr = t.fx_frame.select("file_name", "side", "timestamp_ns").unionByName(cust)
    return frames.pose_lookup(fr, t.fx_pose).select("file_name", "side", "pose_id", "matched_by", F.col("pos.x").alias("x"))


@query("pose_lookup_by_time", """
    SELECT q.file_name, q.side, CASE WHEN abs(CASE WHEN nx.ts IS NULL OR q.timestamp_ns - pv.ts <= nx.ts - q.timestamp_ns THEN pv.ts ELSE nx.ts END - q.timestamp_ns) <= 10000000000 THEN
        CASE WHEN nx.ts IS NULL OR q.timestamp_ns - pv.ts <= nx.ts - q.timestamp_ns THEN pv.pose_id ELSE nx.pose_id END
      WHEN pv.ts IS NULL AND nx.ts - q.timestamp_ns <= 10000000000 THEN nx.pose_id END AS pose_id
    FROM fx_frame q ASOF LEFT JOIN m pv ON q.timestamp_ns >= pv.ts ASOF LEFT JOIN m nx ON q.timestamp_ns <= nx.ts""", m=_LOOK["m"])
def _(t):
    return frames.pose_lookup(t.fx_frame, t.fx_pose, "timestamp").select("file_name", "side", "pose_id")


_FOLDERS = """SELECT side AS folder, file_name FROM fx_frame
    UNION ALL SELECT 'mixed', CASE WHEN c_custkey % 10 = 0 THEN concat('frame_', c_custkey, '.png') ELSE concat(c_custkey, '.png') END FROM customer"""


@query("index_frames", """
    SELECT folder, file_name, numeric, i AS frame_idx, CASE WHEN numeric THEN ts ELSE i * 1000000 END AS timestamp_ns FROM (
      SELECT *, row_number() OVER (PARTITION BY folder ORDER BY CASE WHEN numeric THEN ts ELSE 0 END, file_name) - 1 AS i FROM (
        SELECT *, bool_and(ts IS NOT NULL) OVER (PARTITION BY folder) AS numeric FROM (
          SELECT *, TRY_CAST(split_part(file_name, '.', 1) AS BIGINT) AS ts FROM fold)))""", fold=_FOLDERS)
def _(t):
    return frames.index_frames(t.sql(_FOLDERS)).select("folder", "file_name", "numeric", "frame_idx", "timestamp_ns")


_IX = "SELECT side, file_name, timestamp_ns, row_number() OVER (PARTITION BY side ORDER BY timestamp_ns, file_name) - 1 AS frame_idx FROM fx_frame"


def _indexed(t):
    ix = frames.index_frames(t.fx_frame.select(F.col("side"), "file_name"), ["side"])
    return ix.select("side", "file_name", "timestamp_ns", "frame_idx")


@query("keyframes", "SELECT side, frame_idx, (frame_idx - 3) // 10 AS keyframe_id, file_name FROM ix WHERE frame_idx >= 3 AND (frame_idx - 3) % 10 = 0", ix=_IX)
def _(t):
    return frames.keyframes(_indexed(t), ["side"], 10, 3).select("side", "frame_idx", "keyframe_id", "file_name")


@query("add_regular_keyframes", """SELECT side, frame_idx FROM ix WHERE frame_idx % 8 = 0
    UNION SELECT side, frame_idx FROM ix WHERE timestamp_ns % 1100000000 = 0""", ix=_IX)
def _(t):
    ix = _indexed(t)
    return frames.add_regular_keyframes(ix, ix.filter("timestamp_ns % 1100000000 = 0"), ["side"], 8)


@query("split_ranges", """SELECT side, frame_idx, CASE WHEN frame_idx <= n // 3 THEN 'a' ELSE 'b' END AS part FROM ix, (SELECT max(frame_idx) + 1 AS n FROM ix)
    WHERE frame_idx <= n // 3 OR frame_idx BETWEEN n // 2 AND n - 1""", ix=_IX)
def _(t):
    # The first third and the second half of the frames.
    ix = _indexed(t)
    n = ix.agg(F.max("frame_idx") + 1).first()[0] or 0
    return frames.split_ranges(ix, [("a", 0, n // 3), ("b", n // 2, n - 1)], n).select("side", "frame_idx", "part")


@query("divide_evenly", "SELECT side, frame_idx, (ntile(7) OVER (PARTITION BY side ORDER BY frame_idx) - 1)::INT AS part FROM ix", ix=_IX)
def _(t):
    return frames.divide_evenly(_indexed(t), 7, ["side"]).select("side", "frame_idx", "part")


_MARKS = "SELECT side, frame_idx FROM ix WHERE timestamp_ns % 700000000 = 0"


@query("next_marked_frame", """
    SELECT i.side, i.frame_idx, coalesce(n.frame_idx, (SELECT min(frame_idx) FROM mk WHERE mk.side = i.side)) AS next_mark,
      coalesce(p.frame_idx, (SELECT max(frame_idx) FROM mk WHERE mk.side = i.side)) AS prev_mark
    FROM ix i ASOF LEFT JOIN mk n ON n.side = i.side AND i.frame_idx < n.frame_idx ASOF LEFT JOIN mk p ON p.side = i.side AND i.frame_idx > p.frame_idx""", ix=_IX, mk=_MARKS)
def _(t):
    ix = _indexed(t)
    return frames.neighbor_marks(ix, ix.filter("timestamp_ns % 700000000 = 0"), ["side"])


@query("next_unlabeled_frame", """
    SELECT i.side, i.frame_idx, coalesce(n.frame_idx, (SELECT min(frame_idx) FROM op WHERE op.side = i.side)) AS next_unlabeled
    FROM ix i ASOF LEFT JOIN op n ON n.side = i.side AND i.frame_idx < n.frame_idx""", ix=_IX,
       op="SELECT side, frame_idx FROM ix WHERE NOT (timestamp_ns % 300000000 = 0 OR timestamp_ns % 500000000 = 0)")
def _(t):
    ix = _indexed(t)
    return frames.next_unlabeled(ix, ix.filter("timestamp_ns % 300000000 = 0"), ix.filter("timestamp_ns % 500000000 = 0"), ["side"])


@query("annotated_frames", """SELECT side, frame_idx FROM ix WHERE (timestamp_ns % 300000000 = 0 OR timestamp_ns % 700000000 = 0) AND timestamp_ns % 1100000000 <> 0""", ix=_IX)
def _(t):
    ix = _indexed(t)
    return frames.annotated_frames(ix.filter("timestamp_ns % 300000000 = 0"), ix.filter("timestamp_ns % 700000000 = 0"), ix.filter("timestamp_ns % 1100000000 = 0"), ["side"])


@query("anchor_spans", """
    SELECT video_id, a, b FROM (SELECT video_id, frame_idx AS a, lead(frame_idx) OVER (PARTITION BY video_id ORDER BY frame_idx) AS b FROM (
      SELECT DISTINCT k.video_id, k.frame_idx FROM fx_keybox k WHERE (k.frame_idx % 15 = 0 AND k.video_id % 2 = 0) OR k.video_id % 2 = 1)) WHERE b - a >= 2""")
def _(t):
    marks = t.fx_keybox.filter("frame_idx % 15 = 0 and video_id % 2 = 0")
    return frames.anchor_spans(t.fx_keybox, marks, ["video_id"])


@query("mosaic_neighbors", """
    SELECT side, file_name AS image, q AS quadrant, lead(file_name, 0) OVER (PARTITION BY side, q ORDER BY file_name) AS member FROM (SELECT NULL AS side, NULL AS file_name, 0 AS q) WHERE false
    UNION ALL SELECT side, m[1], q::INT, m[q + 1] FROM (
      SELECT side, list(file_name) OVER (PARTITION BY side ORDER BY file_name ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS m FROM fx_frame), (SELECT unnest(range(4)) AS q) WHERE len(m) = 4""")
def _(t):
    return matching.mosaic_neighbors(t.fx_frame, ["side"])


@query("waypoints", f"""
    SELECT side, frame_idx, waypoint, pose_id FROM (
      SELECT i.side, i.frame_idx, w.waypoint, CASE WHEN nx.ts IS NULL OR i.timestamp_ns - pv.ts <= nx.ts - i.timestamp_ns THEN pv.pose_id ELSE nx.pose_id END AS near,
        CASE WHEN nx.ts IS NULL OR i.timestamp_ns - pv.ts <= nx.ts - i.timestamp_ns THEN i.timestamp_ns - pv.ts ELSE nx.ts - i.timestamp_ns END AS dt
      FROM ix i JOIN (SELECT frame_idx, row_number() OVER (ORDER BY frame_idx) AS waypoint FROM (
          SELECT DISTINCT frame_idx FROM ix WHERE frame_idx % 4 = 0 AND frame_idx % 12 <> 0)) w USING (frame_idx)
      ASOF LEFT JOIN m pv ON i.timestamp_ns >= pv.ts ASOF LEFT JOIN m nx ON i.timestamp_ns <= nx.ts) JOIN (SELECT pose_id, {_POSE} AS p FROM fx_pose) ON pose_id = near
    WHERE p IS NOT NULL AND dt <= 10000000000""", ix=_IX, m=_LOOK["m"])
def _(t):
    ix = _indexed(t)
    w = frames.waypoints(ix.filter("frame_idx % 4 = 0"), ix.filter("frame_idx % 12 = 0"), ix, t.fx_pose)
    return w.select("side", "frame_idx", "waypoint", "pose_id")
