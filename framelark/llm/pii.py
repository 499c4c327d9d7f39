"""Personal data: fixed patterns, and a character tagger that adds spans the patterns miss.

Every kind of span holds a digit or an at sign. The tagger is only ever right with such a character in the
span, so a window without any decodes to nothing by definition; windows are laid over all stretches of a
text that have one, wherever they are. Neighbouring windows overlap by half; each is decoded by itself, and
the spans of a whole text are then reconciled: of spans that overlap, the set with the largest total
posterior stays. A span that no window sees whole is put together from the pieces its windows see. Patterns
always win over the tagger.
"""

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.llm.crf_tagger import KINDS, PAD, TAGS, Tagger, char_ids

WINDOW = 64
REACH = 28  # characters around a digit or at sign that windows must cover
SURE = 0.95  # mean posterior of an added span
SAMPLE_ROWS = 256  # documents whose text gives the training windows
SAMPLE_CHARS = 4_000  # of each of them
EXAMPLES = 3_000  # training windows

_DIGITS_AT = re.compile(r"[0-9@]")
_DIGITS_AT_BYTES = re.compile(rb"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _only_digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(parts):
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _is_card(digits):
    return 13 <= len(digits) <= 19 and luhn(digits)


def _emails(text):
    # The part before the at sign never holds one, so a match is found from its at sign.
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        last = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", last)


def base_spans(text: str) -> list:
    """(kind, start, end) by kind, then start, in code points."""
    out = [("email", a, z) for a, z in _emails(text)]
    # A run of digits that fails as a start fails from its later digits too, hence the look behind.
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(_only_digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return out


# --- training data -------------------------------------------------------------------------------


def _digits(rng, n):
    return "".join(map(str, rng.integers(0, 10, n)))


def _card_number(rng, n=16):
    d = str(rng.integers(3, 6)) + _digits(rng, n - 2)
    return next(d + str(c) for c in range(10) if luhn(d + str(c)))


def _name(rng):
    return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9)))


def _entity(rng):
    """A kind and its text, in a usual or an unusual form."""
    kind, odd = KINDS[rng.integers(4)], rng.random() < 0.5
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == "email":
        local = _name(rng) + pick("", ".", "_", "+") + pick(_name(rng), _digits(rng, 2))
        end = pick("com", "org", "net", "example.com", "co.uk")
        return kind, pick(f"{local} @ {_name(rng)}.{end}", f"{local}@ {_name(rng)}.{end}", f"{local}@{_name(rng)} dot {pick('com', 'org')}") if odd else f"{local}@{_name(rng)}.{end}"
    if kind == "ip":
        parts = [str(x) for x in rng.integers(0, 256, 4)]
        return kind, pick("[.]", " . ", "(.)").join(parts) if odd else ".".join(parts)
    if kind == "card":
        d = _card_number(rng)
        groups = [d[i : i + 4] for i in range(0, 16, 4)]
        return kind, pick("  ", ".", "_", "/").join(groups) if odd else pick("", " ", "-").join(groups)
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    if odd:
        return kind, pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{pick('1', '44', '49')} {a} {b} {c}", f"({a}){b}{c}")
    return kind, pick(f"+1 ({a}) {b}-{c}", f"+{pick('44', '49', '33')} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"+1.{a}.{b}.{c}")


def _other_number(rng):
    """Text with digits or at signs that is no personal data."""
    pick = lambda *x: x[rng.integers(len(x))]
    hexes = lambda n: "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))
    upper = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[i] for i in rng.integers(0, 32, 16))
    n = _digits(rng, int(rng.integers(1, 9)))
    return pick(f'token = "{hexes(40)}"', f"password={hexes(18)}", f"AKIA{upper}", f"version {n[0]}.", f"{n[0]}.{n[-1]}.{_digits(rng, 1)}", n, f"{n}.{_digits(rng, 2)}",
                f"20{_digits(rng, 2)}-0{_digits(rng, 1)}-1{_digits(rng, 1)}", f"1{_digits(rng, 1)}/0{_digits(rng, 1)}/19{_digits(rng, 2)}", f"{n[0]},{_digits(rng, 3)},{_digits(rng, 3)}",
                f"CC BY-NC {n[0]}.0", f"@{_name(rng)}", f"1{_digits(rng, 1)}:3{_digits(rng, 1)}:2{_digits(rng, 1)}", hexes(32), f"#{n}", _digits(rng, 22), f"{n}%", f"x{n}@{n}", f"{_name(rng)}{n}",
                f"{_digits(rng, 4)} {_digits(rng, 4)}", f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(12)}", f"{_digits(rng, 3)}", f"{_digits(rng, 1)}x{_digits(rng, 2)}")


def examples(texts, n=None, seed=0):
    """Windows of character ids and tags: passages of `texts` with spans and other numbers set into them.

    Spans that the patterns find in the passages themselves are labelled too.
    """
    n = EXAMPLES if n is None else n
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["the and of to in is "]
    ids, gold = np.full((n, WINDOW), PAD, np.int64), np.zeros((n, WINDOW), np.int64)
    for i in range(n):
        t = texts[rng.integers(len(texts))]
        at = int(rng.integers(0, max(1, len(t) - 150)))
        rest, line, spans = t[at : at + 150], "", []
        if rng.random() < 0.1:
            rest = rest.upper()
        used = 0
        while len(line) < WINDOW + 40 and used < len(rest):
            step = int(rng.integers(5, 60))
            piece = rest[used : used + step].rpartition(" ")[0] or rest[used : used + step]
            used += step
            for kind, a, z in base_spans(piece):
                spans.append((kind, len(line) + a, len(line) + z))
            line += piece + " "
            if rng.random() < 0.7:
                if rng.random() < 0.5:
                    kind, text = _entity(rng)
                    spans.append((kind, len(line), len(line) + len(text)))
                else:
                    text = _other_number(rng)
                line += text + (" ", " ", ", ", ". ", ".\n", "\n")[rng.integers(6)]
        shift = int(rng.integers(0, 30))
        part = char_ids(line[shift : shift + WINDOW])
        ids[i, : len(part)] = part
        for kind, a, z in spans:
            a, z = a - shift, z - shift
            if a >= 0 and a < WINDOW:
                gold[i, a] = TAGS.index(f"B-{kind}")
                gold[i, a + 1 : min(z, WINDOW)] = TAGS.index(f"I-{kind}")
            elif a < 0 < z:  # begun before the window
                gold[i, 0] = TAGS.index(f"B-{kind}")
                gold[i, 1 : min(z, WINDOW)] = TAGS.index(f"I-{kind}")
    return ids, gold


def train(docs: DataFrame, id_col="doc_id", text_col="text", sample_rows=SAMPLE_ROWS) -> Tagger:
    """A tagger fitted on windows of at most `sample_rows` documents, chosen by a hash of their id."""
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id")).filter("doc_id is not null")
    chosen = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()]
    rows = common.columns(docs, doc_id=id_col, text=text_col).filter(F.col("doc_id").isin(chosen))
    rows = rows.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).filter("text is not null")
    texts = [r.text for r in rows.orderBy("doc_id", "text").limit(sample_rows).collect()]
    tagger = Tagger.fresh()
    tagger.fit(*examples(texts))
    return tagger


# --- decoding ------------------------------------------------------------------------------------


def window_starts(text: str) -> list:
    """Starts of half-overlapping windows over all stretches within REACH of a digit or at sign."""
    out, end, at = [], -1, -1
    for m in _DIGITS_AT.finditer(text):
        a, z = max(0, m.start() - REACH), m.start() + REACH
        if a > end:
            at = a
            out.append(at)
        end = max(end, z)
        while at + WINDOW < end:
            at += WINDOW // 2
            out.append(at)
    return out


def plausible(kind: str, text: str) -> bool:
    """Whether an added span has what its kind must have."""
    digits = _only_digits(text)
    if kind == "email":
        return text.count("@") == 1 and (" dot " in text or "." in text.partition("@")[2]) and len(text) >= 6
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and _is_ip(parts)
    if kind == "card":
        return _is_card(digits)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", text)


def reconcile(spans) -> list:
    """The non-overlapping spans (start, end, weight, kind) of largest total weight."""
    best_of = {}
    for a, z, weight, kind in spans:
        best_of[a, z, kind] = max(weight, best_of.get((a, z, kind), 0))
    spans = sorted(((a, z, w, k) for (a, z, k), w in best_of.items()), key=lambda s: (s[1], s[0], s[3]))
    ends = [s[1] for s in spans]
    best, take = [0.0], []
    for i, (a, _, weight, _) in enumerate(spans):
        j = int(np.searchsorted(ends[:i], a, side="right"))
        take.append((best[j] + weight > best[-1], j))
        best.append(max(best[-1], best[j] + weight))
    out, i = [], len(spans) - 1
    while i >= 0:
        if take[i][0]:
            out.append(spans[i])
            i = take[i][1] - 1
        else:
            i -= 1
    return out[::-1]


def _decoded(tagger: Tagger, texts, places):
    """(text, window, start, end, kind, posteriors, left, right) of every tag; left and right: cut by that edge of the window."""
    names = [t[2:] for t in TAGS]
    for first in range(0, len(places), 2048):
        part = places[first : first + 2048]
        ids = np.full((len(part), WINDOW), PAD, np.int64)
        for r, (i, at) in enumerate(part):
            c = char_ids(texts[i][at : at + WINDOW])
            ids[r, : len(c)] = c
        em = tagger.emissions(ids)
        tags = tagger.decode(em)
        some = np.flatnonzero(tags.any(axis=1))
        if not len(some):
            continue
        post, tags = tagger.posteriors(em[:, some]), tags[some]
        sure = np.take_along_axis(post.transpose(1, 0, 2), tags[:, :, None].astype(np.int64), 2)[:, :, 0]
        for r, (i, at) in enumerate(part[s] for s in some):
            row, a, size = tags[r], 0, len(texts[i])
            while a < WINDOW:
                if row[a] == 0:
                    a += 1
                    continue
                z = a + 1
                while z < WINDOW and row[z] and TAGS[row[z]][0] == "I":
                    z += 1
                yield i, at, at + a, min(at + z, size), names[row[a]], sure[r, a:z], a == 0 and at > 0, z >= WINDOW and at + WINDOW < size
                a = z


def stitched(pieces) -> list:
    """Spans (start, end, kind, posteriors) put together from pieces (start, end, kind, posteriors, left, right) that edges cut.

    A span begins with a piece cut at its right only, goes on with pieces of its kind that begin within what is
    there and reach further, and ends with one cut at its left only.
    """
    out, open_ = [], {}
    for a, z, kind, sure, left, right in sorted(pieces, key=lambda p: (p[0], p[1])):
        parts = open_.get(kind)
        if not left:
            open_[kind] = [(a, z, sure)]
        elif parts and a <= parts[-1][1] < z:
            parts.append((a, z, sure))
            if not right:
                start, values = parts[0][0], np.zeros(z - parts[0][0], np.float32)
                for b, y, s in parts:
                    values[b - start : y - start] = np.maximum(values[b - start : y - start], s[: y - b])
                out.append((start, z, kind, values))
                del open_[kind]
    return out


def tagged(tagger: Tagger, texts) -> list:
    """For each text the reconciled spans (start, end, weight, kind) of the tagger.

    A tag that an edge cuts is seen by the neighbouring window, which is laid if it is not there yet; what no
    window sees whole is put together from its pieces.
    """
    places = [(i, at) for i, t in enumerate(texts) for at in window_starts(t)]
    laid, whole, pieces = set(places), [[] for _ in texts], [[] for _ in texts]
    while places:
        more = []
        for i, at, start, end, kind, sure, left, right in _decoded(tagger, texts, places):
            if not left and not right:
                whole[i].append((start, end, kind, sure))
                continue
            pieces[i].append((start, end, kind, sure, left, right))
            for near in ([max(0, at - WINDOW // 2)] if left else []) + ([at + WINDOW // 2] if right else []):
                if (i, near) not in laid:
                    laid.add((i, near))
                    more.append((i, near))
        places = more
    out = []
    for text, seen, parts in zip(texts, whole, pieces, strict=True):
        seen.sort(key=lambda s: s[:2])
        starts, reach = [s[0] for s in seen], np.maximum.accumulate([0, *(s[1] for s in seen)])
        long = [s for s in stitched(parts) if reach[bisect_left(starts, s[1])] <= s[0]]  # overlaps none seen whole
        found = [(a, z, float(sure.sum()), kind) for a, z, kind, sure in seen + long if sure.mean() >= SURE and _DIGITS_AT.search(text, a, z)]
        out.append(reconcile(found))
    return out


def all_spans(tagger: Tagger, texts) -> list:
    """For each text (base spans, added spans), each (kind, start, end) by kind, then start."""
    out = []
    for text, more in zip(texts, tagged(tagger, texts), strict=True):
        base = base_spans(text)
        added = [(k, a, z) for a, z, _, k in more if plausible(k, text[a:z]) and not any(a < e and s < z for _, s, e in base)]
        out.append((base, sorted(added, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def _line(spans):
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def _find(weights):
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches):
        tagger = Tagger(weights)
        for b in common.blocks(batches):
            texts = common.raw(b.column("text"))
            some = [i for i, t in enumerate(texts) if _DIGITS_AT_BYTES.search(t)]
            counts, sha, lines, added = np.zeros((5, len(texts)), np.int64), [empty] * len(texts), [""] * len(texts), [""] * len(texts)
            for i, (base, more) in zip(some, all_spans(tagger, [texts[i].decode("utf-8", "replace") for i in some]), strict=True):
                for k, _, _ in base:
                    counts[KINDS.index(k), i] += 1
                counts[4, i] = len(more)
                if base or more:
                    sha[i] = hashlib.sha256(_line(base).encode()).hexdigest()
                    lines[i], added[i] = _line(base + more), _line(more)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c) for c in counts[:4]), pa.array(sha), pa.array(lines), pa.array(counts[4]), pa.array(added)],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "added"])

    return run


def find_personal_data(docs: DataFrame, tagger: Tagger, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, added.

    The counts and base_sha256 are of the fixed patterns; `spans` also has what the tagger adds, `added`
    that alone. Spans read kind:start:end in code points. Null and empty texts have none.
    """
    rows = common.columns(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, added string"
    return rows.mapInArrow(_find(tagger.w), schema)
