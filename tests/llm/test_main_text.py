import html
import re

from varve.llm import main_text as M
from varve.llm import queries as Q

from .data import SF_DIR, frame, rows_by, table

SCHEMA = "page_id bigint, url string, html string"


def expected(page):
    """The generated pages' article, cut by hand: blocks are separated by p and h1 tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    body = re.sub(r"<[^>]*\Z", "", inner[1]) if inner else ""
    blocks = [re.sub(r"<br>", " ", b) for b in re.split(r"</?(?:p|h1)>", body)]
    texts = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_against_pages_cut_by_hand(spark):
    got = rows_by(Q.op2_main_text(spark, SF_DIR), "page_id")
    pages = table("pages")
    assert len(got) == len(pages)
    for page_id, url, page in zip(pages.page_id, pages.url, pages.html):
        text = expected(page)
        assert got[page_id]["text"] == text
        assert (got[page_id]["url"], got[page_id]["n_chars"]) == (url, len(text))


def text_of(page):
    return "\n\n".join(M.PageBlocks(page).blocks())


def test_furniture_and_broken_markup():
    assert text_of("<body><div class='cookie-notice'>no</div><article><h1>T &amp; U</h1><p>a <b>b<br>c<p>d</article>x") == "T & U\n\na b c\n\nd"
    assert text_of("<article><p>one</p><section class=comments><p>no</p></section><form>no</form><p>two") == "one\n\ntwo"
    assert text_of("<article>a<script>if (a<b) '</p>'</script>b<!-- c --><style>p{}</style></article>") == "ab"
    assert text_of("<main><ul><li>x<li>y</ul></main><p>out</p>") == "x\n\ny"
    assert text_of("plain &lt;b&gt; &#233;&nbsp;&am") == "plain <b> é &am"
    assert text_of("<p>kept <a href='x>y'>link</a> tail <b") == "kept link tail"
    assert text_of("<article><p>a</div>b</p></article>") == "a\n\nb"
    assert text_of("") == "" and text_of("<>< <3") == "<>< <3"
    assert text_of("<article><p>x</p><script>never closed") == "x"
    assert text_of("<p title=\"a'>b") in ("b", "")


def test_template_is_removed_per_host(spark):
    page = "<body><div><p>Legal text of the site</p></div><div><p>story {}</p></div></body>"
    rows = [(i, "http://A.example/x" if i % 2 else "https://a.example:80/y", page.format(i)) for i in range(8)]
    rows += [(50, "http://b.example/", page.format(0)), (51, None, None), (52, None, ""), (52, None, "")]
    got = M.extract_main_text(frame(spark, rows, SCHEMA)).collect()
    texts = sorted((r["page_id"], r["text"], r["n_chars"]) for r in got)
    assert texts[:8] == [(i, f"story {i}", 7) for i in range(8)]
    assert texts[8:] == [(50, "Legal text of the site\n\nstory 0", 31), (51, "", 0), (52, "", 0), (52, "", 0)]


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://a.example/", "<body><div><p>same story</p></div></body>") for i in range(30)]
    rows += [(100, "http://a.example/", "<body><article><p>reprint</p></article></body>")]
    df = frame(spark, [(*r, 1) for r in rows], SCHEMA + ", site int")
    got = M.extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r["text"] for r in got.collect()} == {"same story", "reprint"}
    assert M.extract_main_text(df.limit(0)).count() == 0


def test_wrapped_articles_of_a_host_stay(spark):
    for part in ("article", "main"):
        page = f"<body><div id=wrap><p>Legal text</p><section><{part}><h1>T</h1><p>story {{}}</p></{part}></section></div></body>"
        rows = [(i, "http://a.example/", page.format(i)) for i in range(6)]
        got = rows_by(M.extract_main_text(frame(spark, rows, SCHEMA)), "page_id")
        assert {k: r["text"] for k, r in got.items()} == {i: f"T\n\nstory {i}" for i in range(6)}


def test_recurring_parts_inside_articles_go(spark):
    # on a host of many other pages, whose number plays no part
    note = "<div class=x1><p>Read our offers</p></div>"
    tail = "<article class=x2>Say what you think</article>"
    page = "<body><article><h1>News</h1>" + note + "<p>story {0} goes on</p><ul><li>item {0}</ul>" + tail + "</article></body>"
    rows = [(i, "http://a.example/", page.format(i)) for i in range(4)]
    rows += [(i, "http://a.example/", f"<body><article><p>other {i}</p></article></body>") for i in range(10, 50)]
    got = rows_by(M.extract_main_text(frame(spark, rows, SCHEMA)), "page_id")
    assert {k: r["text"] for k, r in got.items()} == {
        **{i: f"News\n\nstory {i} goes on\n\nitem {i}" for i in range(4)},
        **{i: f"other {i}" for i in range(10, 50)},
    }


def test_reprints_stay_whole(spark):
    story = "<div id=text><p>A story that is printed again</p><ul><li>own list</ul></div>"
    page = "<body><p>head {0}</p><div id=wrap><article><h1>T</h1>" + story + "<div><p>ad {0}</p></div></article></div></body>"
    rows = [(i, "http://a.example/", page.format(i)) for i in range(5)]
    got = rows_by(M.extract_main_text(frame(spark, rows, SCHEMA)), "page_id")
    assert {k: r["text"] for k, r in got.items()} == {
        i: f"T\n\nA story that is printed again\n\nown list\n\nad {i}" for i in range(5)
    }


def test_furniture_word_in_a_longer_name_is_no_furniture(spark):
    page = (
        "<body><article><h1>Title</h1><section class='social-history'><p>It began early.</p></section>"
        "<p id='notice-of-death'>They died in May.</p><div class='share-buttons'>Share</div>"
        "<div class='comment-list'>First!</div></article></body>"
    )
    rows = spark.createDataFrame([(1, "https://one.test/a", page)], SCHEMA)
    assert M.extract_main_text(rows).first()["text"] == "Title\n\nIt began early.\n\nThey died in May."


def test_deep_page_takes_linear_work():
    depth = 20_000
    page = "<body><article><h1>Title</h1>" + "".join(f"<div>line {i}" for i in range(depth)) + "</div>" * depth + "</article></body>"
    parsed = M.PageBlocks(page)
    assert len(parsed.blocks()) == depth + 1
    # three numbers a subtree, however deep it stands
    assert len(parsed.ranges()) == depth
    assert parsed.ranges()[0][1:] == (1, depth + 1) and parsed.ranges()[-1][1:] == (depth, depth + 1)
    assert len(parsed.subtrees()) < depth
