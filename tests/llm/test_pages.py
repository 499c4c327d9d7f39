import random

import numpy as np
import pytest

from framelark.llm import pages

HEAD = '<!DOCTYPE html><html><head><title>T&amp;</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>'


@pytest.mark.parametrize(("html", "want"), [
    (HEAD + "<nav><ul><li>a</li></ul></nav><!-- <p>x</p> --><div class=\"ad\">buy</div><article><h1>A &amp; b</h1><p><b>one\n two.<br><p>three <i>f</i>our</p></article><footer>&copy; f</footer></body></html>", "A & b\none two.\nthree four"),
    ("<article><p>a<script>x()</script>b</p><aside>side</aside><form>f</form><div class='post-comments'><p>c</p></div><p>d</article>after", "ab\nd"),
    ("<article><p>kept</p><article class=comment><p>reply</p></article><p>too", "kept\ntoo"),
    ("<main><h2>x</h2><div>y<span class='share-buttons'>z</span> w</div></main><div>out</div>", "x\ny w"),
    ("<article><p>a &am", "a &am"),
    ("<article><p>1 &lt; 2 &#233; &#x41; &nbsp; x &unknown; &amp</p>", "1 < 2 é A x &unknown; &"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul><pre>f\n  g</pre></article>", "a b\nc\nd\ne\nf g"),
    ("<article><a title='x > y' href=\"?a>b\">link</a> text <br/> more</article>", "link text more"),
    ("<article>unclosed <!-- comment", "unclosed"),
    ("<article><p>cut <a hre", "cut"),
    ("<nav>only menu</nav>", ""),
    ("", ""),
    ("<article></article>", ""),
    ("<article><header>h</header><p>t</p><div id=newsletter>n</div><div role='alert'>r</div></article>", "t"),
    ("<body class='menu-open'><article class='post has-comments'><p>t</p></article></body>", "t"),
])
def test_structure(html, want):
    assert pages.settled(pages.blocks(html)) == want


def test_long_and_hostile_pages():
    for page in ("<" * 200_000, "<a " * 50_000, '<a href="' * 20_000, "<div>" * 3_000 + "x", "&" * 100_000, "<!--" * 50_000, "<script>" + "<" * 100_000):
        pages.blocks(page)
    assert pages.settled(pages.blocks("<article><p>" + "word " * 200_000)) == "word " * 199_999 + "word"


def test_suffix_array_matches_sorting():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 300):
        t = rng.integers(0, 3, n).astype(np.uint64)
        order, rank = pages.suffix_array(t, 8)
        key = [tuple(t[i : i + 8].tolist()) for i in range(n)]
        assert [key[i] for i in order] == sorted(key)
        assert all((rank[i] == rank[j]) == (key[i] == key[j]) for i in range(n) for j in range(n))


def slow(rows, long):
    """Words of open pages on no other page of the host within a shared passage."""
    parsed = [(r[0], r[1], pages.blocks(r[2] or "")) for r in rows]
    host = lambda u: (u or "").split("//")[-1].split("/")[0] if u else ""
    seen, html = {}, {(r[0], r[1]): r[2] for r in rows}
    for p, u, found in parsed:
        s = [w for state, t in found if state in (1, 2) for w in t.split()]
        for i in range(len(s) - long + 1):
            seen.setdefault((host(u), tuple(s[i : i + long])), set()).add(html[p, u])
    out = []
    for p, u, found in parsed:
        text = pages.settled(found)
        if text is None:
            flat = [(b, state, w) for b, (state, t) in enumerate(found) if state in (1, 2) for w in t.split()]
            words = [w for _, _, w in flat]
            gone = {i + k for i in range(len(words) - long + 1) if len(seen[host(u), tuple(words[i : i + long])]) > 1 for k in range(long)}
            kept = {}
            for i, (b, state, w) in enumerate(flat):
                if state == 2 and i not in gone:
                    kept.setdefault(b, []).append(w)
            text = "\n".join(" ".join(v) for v in kept.values())
        out.append((p, u, text, len(text)))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choices([f"w{i}é" for i in range(30)], k=n))
    shared = [say(n) for n in (3, 8, 12, 30)]
    rows = []
    for i in range(120):
        host = rng.choice(["a.org", "a.org", "a.org", "b.net"])
        parts = [f"<div>{rng.choice(shared) if rng.random() < 0.5 else say(rng.randrange(25))} {say(rng.randrange(4))}</div>" for _ in range(rng.randrange(5))]
        if i % 3 == 0:
            parts.insert(len(parts) // 2, f"<article><p>{rng.choice(shared)}<p>{say(9)}</article>")
        rows.append((i, f"http://{host}/{i}", f"<nav>{shared[3]}</nav>" + "".join(parts) + "<footer>f</footer>"))
    rows += [(500, None, "<p>" + say(20)), (501, "http://a.org/x", None), (502, "http://a.org/y", ""), (None, "http://c.de/", "<div>" + shared[3]), (600, "http://u.de/", "<p>" + say(12)), rows[1]]
    rows.append(rows[-2])
    rows += [(i, f"http://copies.de/{i}", "<div>" + shared[3] + "</div><p>" + shared[2]) for i in (700, 701)]  # one page twice
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, n_chars int, host string")
    key = lambda r: tuple((x is None, x or type(x)()) if x is not None else (True, 0) for x in r)
    for parts in (1, 9):
        got = [tuple(r) for r in pages.main_text(frame.repartition(parts)).collect()]
        assert sorted(got, key=repr) == sorted(slow(rows, pages.LONG), key=repr)
    assert key and [r.n_chars > 0 for r in pages.main_text(frame).filter("page_id >= 700").collect()] == [True, True]
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_host_decides_on_every_page(spark):
    """Repeated passages are counted on pages with an article, and settle its marked phrases."""
    menu = "<div>" + " ".join(f"m{i}" for i in range(12)) + "</div>"

    def page(i, text, host="a.org"):
        return (i, f"http://{host}/{i}", f"{menu}<article><p>{text} {i}</p></article>")

    rows = [page(1, "see <a class='share-link'>this <i>paper</i></a> now"), page(2, "x <a class='share-link'>Share it</a> y"), page(3, "z <a class='share-link'>Share  it</a>"),
            page(4, "u <span class='ad share'>own</span> v"), page(5, "see <a class='share-link'>this</a> now", "b.org"), page(6, "<div class='related'>gone</div>w")]
    rows.append((7, "http://c.org/", "<article><p>" + " ".join(f"m{i}" for i in range(12))))
    want = {1: ("see this paper now 1", 12), 2: ("x y 2", 12), 3: ("z 3", 12), 4: ("u v 4", 12), 5: ("see now 5", 0), 6: ("w 6", 12), 7: (" ".join(f"m{i}" for i in range(12)), 0)}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts, hub in ((1, 1000), (5, 2)):
        got = pages.host_text(frame.repartition(parts), hub_rows=hub).collect()
        assert {r.page_id: (r.text, r.n_repeated) for r in got} == want
