import itertools
import random
import re
import time

import pytest

from framelark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def slow(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    bits = ["MIT", "license", "License.", "apache", "general", "public", "licenses", "é", "mité", "İ", "the", "\n", " - ", "\x00", "a1"]
    rows = [(i, rng.choice([" ", "-", "\n", ""]).join(rng.choices(bits, k=rng.randrange(12))), "x") for i in range(1500)]
    rows += [(None, "MIT License", "x"), (9000, None, "x"), (9001, "", "x"), (9002, "mit license " * 40_000, "x"), (0, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = licenses.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(("text", "labels", "score"), [
    ("// SPDX-License-Identifier: MIT", {"mit"}, 1.0),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nfoo", {"mit", "apache", "bsd"}, 1.0),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 1.0),
    ("SPDX-License-Identifier: GPL-2.0-only WITH nothing-known", {"gpl"}, 0.4),
    ("SPDX-License-Identifier: Foo-1.0 OR MIT", {"mit"}, 1.0),
    ("SPDX-License-Identifier: Foo-1.0 AND MIT", {"mit"}, 0.4),
    ("SPDX-License-Identifier: MIT and all the rest of it", {"mit"}, 0.4),
    ("SPDX-License-Identifier:", set(), 0.0),
    ("License-Expression: GPL-3.0-or-later OR MPL-2.0", {"gpl", "mpl"}, 1.0),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}, 0.7),
    ("nothing here", set(), 0.0),
])
def test_tags(text, labels, score):
    _, _, _, found, best = licenses.scan(text.encode())
    assert (found, best) == (labels, score)


def test_parser_follows_precedence():
    names = ("mit", "isc", "foo")
    for ops in itertools.product(("and", "or"), repeat=3):
        for leaves in itertools.product(names, repeat=4):
            tokens = [leaves[0]]
            for op, leaf in zip(ops, leaves[1:], strict=True):
                tokens += [op, leaf]
            want = eval(" ".join(t if t in ("and", "or") else str(t != "foo") for t in tokens))  # noqa: S307
            assert licenses.evaluate(tokens)[1] == want
            grouped = ["(", *tokens[:3], ")", *tokens[3:]]
            want = eval(" ".join(t if t in ("and", "or", "(", ")") else str(t != "foo") for t in grouped))  # noqa: S307
            assert licenses.evaluate(grouped)[1] == want
    assert licenses.evaluate(["(", "mit"]) is None and licenses.evaluate([]) is None


def test_very_long_texts_take_linear_time():
    """One phrase, or one tag, all the way: a hundred thousand places in a second or two, not minutes."""
    n = 100_000
    start = time.perf_counter()
    words, starts, base, _, _ = licenses.scan("é mit license ".encode() * n)
    assert words == 3 * n and starts == list(range(1, 3 * n, 3)) and base == {"mit"}
    assert licenses.scan(b"SPDX-License-Identifier: MIT OR Apache-2.0 " * n)[3] >= {"mit", "apache"}
    assert time.perf_counter() - start < 30
