"""Plain loops the operators are checked against."""

import random


def iou(a, b):
    w = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    area = lambda p: max(0.0, p[2] - p[0]) * max(0.0, p[3] - p[1])
    u = area(a) + area(b) - w * h
    return w * h / u if u > 0 else 0.0


def random_boxes(n, seed, spread=60, copies=0.3):
    """Boxes of many sizes with a good share of exact copies: (id, class, score, box)."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        if out and r.random() < copies:
            box = r.choice(out)[3]
        else:
            x, y, s = r.randint(0, spread), r.randint(0, spread), r.choice([6, 10, 16, 30])
            box = (float(x), float(y), float(x + s + r.randint(0, 4)), float(y + s + r.randint(0, 4)))
        out.append((i, r.randint(0, 2), r.choice([0.1, 0.2, 0.5, 0.9, r.random()]), box))
    return out


def nms(boxes, t):
    kept = []
    for b in sorted(boxes, key=lambda b: (-b[2], b[0])):
        if not any(iou(b[3], k[3]) > t for k in kept):
            kept.append(b)
    return {b[0] for b in kept}


def match(preds, gts, t):
    used, out = set(), {}
    for p in sorted(preds):
        best, at = 0.0, None
        for g in sorted(gts):
            v = iou(p[3], g[3])
            if g[0] not in used and v > best:
                best, at = v, g[0]
        if at is not None and best >= t:
            used.add(at)
            out[p[0]] = at
    return out


def cross_class(boxes, t):
    kept = []
    for b in sorted(boxes):
        hit = next((i for i, (_, k) in enumerate(kept) if k[1] != b[1] and iou(b[3], k[3]) >= t), None)
        if hit is None:
            kept.append((b[0], b))
        elif b[2] is not None and (kept[hit][1][2] is None or b[2] > kept[hit][1][2]):
            kept[hit] = (kept[hit][0], b)
    return {(b[0], slot) for slot, b in kept}


def nearest_centers(a, b, limit):
    pairs = sorted((((x[1] - y[1]) ** 2 + (x[2] - y[2]) ** 2) ** 0.5, x[0], y[0]) for x in a for y in b)
    ua, ub, out = set(), set(), set()
    for d, i, j in pairs:
        if d <= limit and i not in ua and j not in ub:
            ua.add(i), ub.add(j), out.add((i, j))
    return out


def kalman(start, steps, target, n, q=1.0, r=4.0):
    """One axis: smoothed positions of the interior frames; steps[p] is None where nothing was measured."""
    x, v = start, 0.0
    p00, p01, p11 = 10.0, 0.0, 10.0
    raw, out = start, []
    for s in steps:
        x += v
        p00, p01, p11 = p00 + 2 * p01 + p11 + q, p01 + p11, p11 + q / 4
        if s is not None:
            raw += s
            k0, k1 = p00 / (p00 + r), p01 / (p00 + r)
            y = raw - x
            x, v = x + k0 * y, v + k1 * y
            p00, p01, p11 = (1 - k0) * p00, (1 - k0) * p01, p11 - k1 * p01
        out.append(x)
    return [o + (i + 1) / n * (target - out[-1]) for i, o in enumerate(out[:-1])]


def inherit(boxes, start=1):
    """boxes: (side, frame, ann, preset) of a session, given frame by frame, left before right."""
    ids, last = {}, {}
    nxt = max([b[3] for b in boxes if b[3] is not None], default=start - 1) + 1
    for side_frame in sorted({(b[1], b[0]) for b in boxes}):
        frame, side = side_frame
        ref, now = last.get(side, []), []
        for b in sorted(x for x in boxes if (x[1], x[0]) == side_frame):
            if b[3] is not None:
                t = b[3]
            elif len(now) < len(ref) and ref[len(now)] not in now:
                t = ref[len(now)]
            else:
                t, nxt = nxt, nxt + 1
            now.append(t)
            ids[b[2]] = t
        last[side] = now
    return ids


def ground_tilt(points):
    """Tilt in degrees and inliers of the plane through the lowest slice, refitted on near points."""
    import numpy as np

    p = np.array(points)
    low = p[p[:, 2] <= np.quantile(p[:, 2], 0.15)]
    cur = low
    for _ in range(4):
        c = cur.mean(axis=0)
        n = np.linalg.eigh(np.cov((cur - c).T))[1][:, 0]
        n = -n if n[2] < 0 else n
        cur = low[np.abs((low - c) @ n) < 0.25]
    return float(np.degrees(np.arccos(np.clip(n[2], -1, 1)))), len(cur)
