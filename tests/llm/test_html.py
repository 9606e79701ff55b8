import html
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import html_wrapper as hw

PAGES = [
    ("http://a.b/c", '<html><body><div class="cookie-notice">We use cookies</div><header>H</header><main><p>A &amp; B<br>c<p>d<aside>no</aside>'
     '<form><input>f</form><div id="comments"><p>bad</div><table><tr><td>x<td>y</table><ul><li>1<li>2</ul></main><footer>F',
     "A & B c\nd\nx\ny\n1\n2"),
    (None, '<div><p>only <i>free</i>  text</p><div class=ad>buy</div></div><p', "only free text"),
    ("http://a.b/d", None, ""), ("u", "", ""), ("v", "&am &quo; 1 < 2 <!-- x", "&am &quo; 1 < 2"),
    ("w", "<article><script>var t='</p>';</script><style>p{}</style><p>x&nbsp;\n y</article>", "x y"),
    ("x", "<article>" + "<p>t</p>" * 3_000 + "</article>", "\n".join("t" * 3_000)),
    ("y", "<" * 3_000, "<" * 3_000), ("z", "<div>" * 2_000 + "deep", "deep"),
]


def plain(source):
    """The article of a generated page, by its known form."""
    article = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = re.split(r"</?p>|</?h1>", re.sub(r"<br>|</?b>", " ", article))
    return "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks) if x)


def test_generated_and_odd_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html")
    odd = spark.createDataFrame([(-i - 1, u, h) for i, (u, h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    every = pages.unionByName(odd).withColumns({"text": F.lit(1), "host": F.lit(2), "wrapper": F.lit(3)}).cache()
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()} | {-i - 1: t for i, (_, _, t) in enumerate(PAGES)}
    for limit in (8 << 20, 0):  # broadcast wrappers, salted join
        got = hw.extract(every, broadcast_bytes=limit)
        assert {r["page_id"]: r["text"] for r in got.collect()} == want
    assert hw.extract(every.limit(0)).collect() == []
    assert hw.extract(odd.unionByName(odd)).count() == 2 * len(PAGES)


def test_template_text_of_a_host_is_left_out(spark):
    pages = spark.createDataFrame([(i, "http://h.x/%d" % i, f"<div><p>Welcome to our site</p><p class=t>Story {i}</p></div>") for i in range(6)],
                                  "page_id long, url string, html string")
    assert {r["text"] for r in hw.extract(pages).collect()} == {f"Story {i}" for i in range(6)}


def test_alignment_makes_repeated_and_optional_groups():
    one = hw.fold(hw.read_page("<ul><li>a</li><li>b</li><li>c</li></ul><p>x</p>")[0])
    two = hw.fold(hw.read_page("<ul><li>a</li></ul><h2>new</h2><p>x</p>")[0])
    wrapper = hw.align(one, two)
    assert hw.as_expression(wrapper) == "<ul>(<li>#</li>)+</ul>(<h2>#</h2>)?<p>#</p>"
    assert hw.align(wrapper, one) == wrapper and hw.align(wrapper, two) == wrapper


def test_order_of_pages_does_not_matter():
    import json
    shapes = [json.dumps(hw.fold(hw.read_page(x)[0])) for x in ("<p>a</p>", "<p>a</p><p>b</p>", "<h1>t</h1><p>a</p>")]
    assert len({hw.merge_wrappers(list(s)) for s in (shapes, shapes[::-1], shapes + shapes)}) == 1


def test_slots_are_places_of_the_aligned_wrapper(spark):
    """Two slots of equal element names are told apart by the wrapper, also beside an optional block."""
    def page(i):
        more = f"<ul><li>point {i}</li></ul>" if i % 2 else ""
        return f"<div><p>Welcome to our site</p><h2>Title {i}</h2>{more}<p>Story {i}</p></div>"
    pages = spark.createDataFrame([(i, f"http://h.x/{i}", page(i)) for i in range(6)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in hw.extract(pages).collect()} == {
        i: f"Title {i}\n" + (f"point {i}\n" if i % 2 else "") + f"Story {i}" for i in range(6)}


def test_tree_of_small_groups_covers_every_page(spark):
    parts = ["<h1>t</h1>", "<ul><li>a</li></ul>", "<table><tr><td>x</td></tr></table>", "<blockquote>q</blockquote>"]
    sources = ["<p>a</p>" + "".join(x for k, x in enumerate(parts) if i >> k & 1) + "<hr>" for i in range(16)]
    pages = spark.createDataFrame([(f"http://h.x/{i}", s) for i, s in enumerate(sources)], "url string, html string")
    rows = hw.infer_wrappers(pages, width=3).collect()
    assert len(rows) == 1
    steps = hw.compile_wrapper(rows[0]["wrapper"])
    for source in sources:
        stream, blocks = hw.read_page(source)
        assert len(hw.match(steps, stream)) == len(blocks)
    assert hw.match(steps, ["<div>", "#", "</div>"]) is None


def test_copies_of_a_page_do_not_make_its_text_a_template(spark):
    odd = spark.createDataFrame([(-i - 1, u, h) for i, (u, h, _) in enumerate(PAGES)] + [
        (100 + i, f"http://near.x/{i}", f"<!-- {i} --><div><p>only</p><h2>page</h2></div>") for i in range(4)], "page_id long, url string, html string")
    want = {-i - 1: t for i, (_, _, t) in enumerate(PAGES)} | {100 + i: "only\npage" for i in range(4)}
    rows = hw.extract(odd.unionByName(odd).unionByName(odd).unionByName(odd)).collect()
    assert len(rows) == 4 * len(want) and {(r["page_id"], r["text"]) for r in rows} == set(want.items())
