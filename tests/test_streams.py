"""Streamed jobs against loops, with rows in any order and batch."""

import os
import random

import loops
import pytest
from framelark.operators import convert
from framelark.streaming import ingest, propagate

SCHEMA = "video_id long, frame_idx long, cand_id long, x1 double, y1 double, x2 double, y2 double"


def video(rng, v, frames, objects):
    """Boxes that drift; some frames miss an object, and copies tie."""
    rows, n = [], 0
    for f in range(frames):
        for o in range(objects):
            if rng.random() < 0.02:
                continue
            for _ in range(rng.choice([1, 1, 2])):
                x, y = 60 * o + f * rng.choice([1, 2, 3]) + rng.randrange(3), 40 * o + rng.randrange(4)
                rows.append((v, f, 1000 * v + n, float(x), float(y), float(x + 30), float(y + 24)))
                n += 1
    return rows


def follow(seeds, cands):
    """Each seed frame by frame to the candidate with the best overlap, lost for good at the first miss."""
    by, out = {}, set()
    for c in cands:
        by.setdefault((c[0], c[1]), []).append(c)
    for v, seed, frame, *box in seeds:
        now = box
        while (v, frame + 1) in by:
            best = min(by[v, frame + 1], key=lambda c: (-loops.iou(now, c[3:]), c[2]))
            if loops.iou(now, best[3:]) < 0.3 or loops.iou(box, best[3:]) < 0.2:
                break
            frame, now = frame + 1, best[3:]
            out.add((v, seed, frame, best[2]))
    return out


def write(spark, folder, lots):
    """A file per lot, in order."""
    done = len(os.listdir(folder)) if os.path.exists(folder) else 0
    for i, rows in enumerate(lots):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/lot{done + i:03d}")


def run(spark, base, seeds, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    table = spark.createDataFrame(seeds, SCHEMA.replace("frame_idx long, cand_id long", "seed_id long, frame_idx long"))
    propagate.propagate(stream, table, base, **options).awaitTermination()
    out = spark.read.parquet(f"{base}/out").collect()
    assert len(out) == len({(r["video_id"], r["seed_id"], r["frame_idx"]) for r in out})
    return {(r["video_id"], r["seed_id"], r["frame_idx"], r["cand_id"]) for r in out}


@pytest.mark.parametrize("closing", ["marks", "lag"])
def test_frames_spread_over_batches(spark, tmp_path, closing):
    rng = random.Random(len(closing))
    frames = 12
    cands = [c for v in (1, 2) for c in video(rng, v, frames, 4)]
    seeds = [(c[0], 90_000 + c[2], c[1], *c[3:]) for c in cands if c[1] in (0, 3) and c[2] % 2 == 0]
    ahead = 2  # a candidate comes within that many lots of its frame
    lots = [[] for _ in range(frames // 4 + ahead + 1)]
    for c in cands:
        lots[c[1] // 4 + rng.randrange(ahead)].append(c)
    if closing == "marks":
        for v in (1, 2):
            for f in range(1, frames):
                lots[f // 4 + ahead].append((v, f, None, None, None, None, None))
    else:
        lots[-1] += [(v, f, None, None, None, None, None) for v in (1, 2) for f in range(1, frames)]
    for lot in lots:
        rng.shuffle(lot)
    base = str(tmp_path)
    # The job ends and starts again in between.
    write(spark, f"{base}/in", lots[:3])
    options = {"lag": 8} if closing == "lag" else {}
    early = run(spark, base, seeds, **options)
    write(spark, f"{base}/in", lots[3:])
    want = follow(seeds, cands)
    assert early <= want and len(want) > 25
    assert run(spark, base, seeds, **options) == want
    assert spark.read.parquet(f"{base}/late").count() == 0


def test_late_candidates_stand_apart(spark, tmp_path):
    box = (0.0, 0.0, 10.0, 10.0)
    seeds = [(1, 7, 0, *box)]
    base = str(tmp_path)
    lots = [[(1, 2, 20, *box), (1, 1, 10, 1.0, 0.0, 11.0, 10.0), (1, 1, None, None, None, None, None)],
            [(1, 1, 11, *box), (1, 2, None, None, None, None, None), (2, 1, 99, *box)]]  # 11 would have been better
    write(spark, f"{base}/in", lots)
    assert run(spark, base, seeds) == {(1, 7, 1, 10), (1, 7, 2, 20)}
    assert [r["cand_id"] for r in spark.read.parquet(f"{base}/late").collect()] == [11]


def test_a_closed_frame_without_candidates_loses_the_seed(spark, tmp_path):
    box = (0.0, 0.0, 10.0, 10.0)
    base = str(tmp_path)
    mark = lambda f: (1, f, None, None, None, None, None)
    write(spark, f"{base}/in", [[mark(1), (1, 2, 20, *box)], [mark(2)]])
    run_of = lambda: run(spark, base, [(1, 7, 0, *box)])
    assert run_of() == set() and os.path.exists(f"{base}/state/1")
    assert spark.read.parquet(f"{base}/state/1/waiting").count() == 0


def test_annotation_ids_go_on_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(2)
    names = ["cat", "dog", "cow", "bird", "fish"]
    rows = []
    for i in range(12):
        dets = [{"label": rng.choice(names[: 1 + i // 2][-3:] or names), "bbox_2d": [1, 2, rng.randrange(1, 40), 30]} for _ in range(rng.randrange(4))]
        rows.append((f"{100 + i}.jpg", 50, 40, "no json" if i % 5 == 4 else str(dets).replace("'", '"')))
    schema, base = "file_name string, width int, height int, response string", str(tmp_path)
    for i in range(0, 12, 3):
        spark.createDataFrame(rows[i : i + 3], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        if i in (3, 9):  # the job ends and starts again
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
            ingest.ingest_annotations(stream, base).awaitTermination()
    want = convert.vlm_to_annotations(spark.createDataFrame(rows, schema))
    for name, table in zip(("images", "annotations", "categories"), want):
        got = spark.read.parquet(f"{base}/{name}").select(*table.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, table.collect())), name
