import html
import re
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.helpers import SF, rows
from voxloom.llm import catalog, pagediff


def text(page, other=None):
    return pagediff.main_text(pagediff.page_of(page), pagediff.page_of(other) if other is not None else None)


def test_query_equals_the_articles(spark):
    pages = {r.page_id: r for r in catalog.table(spark, SF, "pages").collect()}
    got = catalog.op9_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_shared_lines_go():
    page = "<div>Site name</div><div>Story {}</div><div>More of {}</div><div>All rights</div>"
    assert text(page.format(1, 1), page.format(2, 2)) == "Story 1\nMore of 1"
    assert text(page.format(1, 1), page.format(1, 1)) == "Site name\nStory 1\nMore of 1\nAll rights"
    inside = "<div>Site</div><article><p>Quoted</p><p>Own {}</p></article>"
    assert text(inside.format(1), inside.format(2)) == "Quoted\nOwn 1"


def test_lines_beside_an_article_stay_unless_shared():
    page = "<div>Site</div><h1>Head {0}</h1><article><p>Teaser</p></article><div>Body {0}</div><div>Rights</div>"
    assert text(page.format(1), page.format(2)) == "Head 1\nTeaser\nBody 1"


def test_markup():
    assert text("<p>A &lt;b&gt; &amp; c<br>d</p><div>e <i>f</i>g</div>") == "A <b> & c d\ne fg"
    assert text("<title>t</title><script>if(a<b){'</p>'}</script><style>x</style><p>y</p>") == "y"
    assert text("<body class='menu'><nav>n</nav><p>x</p><div class='side-bar ad'>a</div><aside>b</aside></body>") == "x"
    assert text("<div id=comments><article>reader</article></div><form>f</form><p>y</p><footer>z</footer>") == "y"
    assert text("<p>a<nav>never closed") == "a"
    assert text("<article><header><h1>Title</h1></header><p>b<!-- c --></p><footer>d</footer></article><p>out</p>") == "Title\nb"
    assert text('<p title="a>b">t</p><a href=\'x">u</a>') == "t\nu"
    assert text("") == text("<!-- x") == text("<script>") == ""


def test_marks_spare_the_text():
    for outer in ("div class='content no-sidebar'", "div id=page class=sidebar", "form", "div class=search-results"):
        tag = outer.split()[0]
        assert text(f"<{outer}><nav>n</nav><main><p>Body</p></main></{tag}>") == "Body", outer
        assert text(f"<{outer}><nav>n</nav><div>Body</div></{tag}>") == "Body", outer
    assert text("<article class='post comments search'><p>Body</p></article>") == "Body"
    assert text("<main class='menu'><p>Body</p><div class='menu'>m</div></main>") == "Body"
    assert text("<main><p>Body</p><div class=comments><article>reader</article></div></main>") == "Body"


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def aligned(a, b):
    """Whether the places found in ``a`` are a common subsequence as long as the longest."""
    found = [a[i] for i in sorted(pagediff.shared_lines(a, b))]
    rest = iter(b)
    return len(found) == longest(a, b) and all(x in rest for x in found)


@given(st.lists(st.sampled_from("abcdefgh")), st.lists(st.sampled_from("abcdefgh")), st.sampled_from([0, 1, 16]))
def test_alignment_is_a_longest_common_subsequence(a, b, listed):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pagediff, "LISTED", listed)
        assert aligned(a, b)
        patch.setattr(pagediff, "ROW_BITS", 5)
        assert aligned(a, b)
    assert pagediff.shared_lines(["b", "x"], ["x", "b", "x"]) == {0, 1}


def test_long_pages_do_not_blow_up():
    assert len(pagediff.shared_lines(["x"] * 100_000, ["x"] * 99_000)) == 99_000
    few = ["ab"[k * k % 7 % 2] for k in range(30_000)]
    assert len(pagediff.shared_lines(few, ["c", *few[::-1], "c"])) > 20_000
    assert text("<p>" + "word " * 300_000 + "</p>").count(" ") == 299_999
    text("<" * 100_000 + '<a "' * 50_000 + "<div>" * 50_000)


def test_a_long_run_is_held_compressed(monkeypatch):
    monkeypatch.setattr(pagediff, "HANDED_ON", 1 << 18)
    body = "".join(f"<div>Sentence {k} of the long page</div>" for k in range(400))

    def batches():
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.int32()]
        for k in range(200):
            edit = f"<div>Top</div>{body}<div>Edit {k}</div>" if 0 < k < 199 else f"<div>Top</div><div>Own {k}</div>"
            row = (k, f"http://a/{k:04}", pagediff.zipped(edit.encode()), "a", f"/{k:04}", 0)
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, kinds)], list("abcdef"))

    tracemalloc.start()
    texts, done = 0, 0
    for b in pagediff._in_range(batches()):
        done += b.column("part").to_pylist().count("done")
        texts += sum(len(x or "") for x in b.column("text").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == 198 and texts > 2e6
    assert peak < 4e6


def test_neighbours(spark):
    page = "<div>Top of {0}</div><div>Own {1}</div>"
    data = [(k, f"http://{h}/p/{k}", page.format(h, k), "x") for h in ("a", "b") for k in range(5)]
    data += [(None, None, None, "x"), (20, "", "", "x"), (3, "http://a/p/3", page.format("a", 3), "x")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string").coalesce(1)
    got = rows(pagediff.extract(df).select("page_id", "url", "text"))
    assert got[(1, "http://a/p/1", "Own 1")] == 1 and got[(4, "http://b/p/4", "Own 4")] == 1
    assert got[(None, None, "")] == 1 and got[(20, "", "")] == 1
    assert sum(got.values()) == len(data)
    assert pagediff.extract(df.limit(0)).count() == 0


def test_neighbours_do_not_depend_on_ranges(spark):
    page = "<div>Top of the site</div><div>Own words of page {}</div>"
    data = [(k, f"http://a/p/{k:02}", page.format(k)) for k in range(40)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(4)
    for n in ("1", "7", "40", "97"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {r.page_id: r.text for r in pagediff.extract(df).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert got == {k: f"Own words of page {k}" for k in range(40)}, n


def test_copies_are_no_neighbours(spark):
    body = "".join(f"<div>Sentence {k} of page {{0}}</div>" for k in range(8))
    page = f"<div>Top of the site</div>{body}<div>Edit {{1}}</div>"
    data = [(k, f"http://a/p/1?v={k}", page.format(1, k // 2)) for k in range(12)]
    data.append((50, "http://a/p/2", page.format(2, 99)))
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(4)
    for n in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {r.page_id: r.text.split("\n") for r in pagediff.extract(df).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        for k in range(12):
            assert got[k] == [f"Sentence {j} of page 1" for j in range(8)] + [f"Edit {k // 2}"], n
        assert got[50] == [f"Sentence {j} of page 2" for j in range(8)] + ["Edit 99"], n
