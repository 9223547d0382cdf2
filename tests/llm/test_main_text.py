from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from farewind.llm import main_text
from farewind.llm.main_text import extract, read_page
from tests.llm.tables import prose

FIELDS = "page_id long, url string, html string"


def text(html, template=()):
    return extract(read_page(html), set(template))


CASES = {
    "<article><h1>A &lt;b&gt; c</h1><p><b>One\n two.<br><p>Three <i>fo</i>ur &amp; &#x41;&eacute;&nbsp;x.</article>": "A <b> c\nOne two.\nThree four & Aé x.",
    "<nav><ul><li><a>Home</a></ul></nav><article><p>Body.</p></article><footer>&copy; x</footer>": "Body.",
    "<script>var t='</p><article>no</article>';</script><article>x<style>p{}</style>y<script>z</script></article>": "xy",
    "<article><p>a</p><div class='ad'>Buy</div><aside>s</aside><form>f<p>g</p></form><p>b</p></article>": "a\nb",
    "<article><header><h1>T</h1></header><p>b</p><section id='comments'><p>c1</p></section></article>": "T\nb",
    "<main><p>x</p><article><p>a</p></article></main><div class=sidebar>s</div>": "x\na",
    "<article><p>text <span class=ad>buy now</span> goes on <button>go</button> here</p></article>": "text goes on here",
    "<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>": "one\ntwo\nc1\nc2",
    "<!-- <article>no</article> --><article>yes</article": "yes",
    "<header>Site name</header><div class=cookie-notice>We use cookies</div><article>Body</article><article class='comment'>hey</article>": "Body",
    "<article><p>1 < 2 and 3 > 2 &unknown; &amp;amp;</p></article>": "1 < 2 and 3 > 2 &unknown; &amp;",
    "": "", "   ": "", "just text": "just text", "<p>": "", "</p></b>": "", "<article></article>": "",
    "<html><head><title>t</title></head><body><div id=menu><a>m</a></div><div id=c><h2>H</h2><p>some longer text of an article.</p></div></body>": "H\nsome longer text of an article.",
    "<textarea>t</textarea><article><noscript>n</noscript><template>q</template>z</article>": "z",
}


@pytest.mark.parametrize("html", list(CASES))
def test_pages(html):
    assert text(html) == CASES[html]


def test_names_inside_an_article_tell_a_part_only_if_they_say_nothing_else():
    parts = "<div class='related-work'>work</div><div class='social-history'>history</div><section id='legal'>law</section>"
    aside = "<div class='related-posts'>r</div><div class='cookie-notice'>c</div><div class='ad-box'>a</div><div id='comments'>d</div>"
    assert text(f"<article><p>start</p>{parts}{aside}<p>end</p></article>") == "start\nwork\nhistory\nlaw\nend"


def test_an_article_split_over_sibling_divs_stays_whole():
    page = f"<body><div>x</div><div id=a><p>{prose(1, 70)}</p></div><div id=b><p>{prose(2, 30)}</p></div></body>"
    assert text(page) == f"{prose(1, 70)}\n{prose(2, 30)}"


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<div>", "<li><div>", "<p><span>", "<", "<td><b>"])
def test_a_megabyte_of_open_tags_ends_in_seconds(piece):
    begun = time.time()
    assert text(piece * (1_000_000 // len(piece))) is not None
    assert time.time() - begun < 30


def test_hostile_pages_end():
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text("<" * 20000).startswith("<")
    assert text("<a '" * 3000) is not None
    assert len(text("<article>" + "<p>x" * 20000)) == 39999


def site(host, n, shell):
    return [(i, f"http://{host}/{i}", shell.format(i=i, body=f"<p>{prose(i, 40)}</p><p>{prose(i + 1000, 60)}</p>")) for i in range(n)]


def test_template_texts_of_unnamed_parts_go(spark):
    """Nothing names the parts here: only that they repeat on the host's pages tells them."""
    shell = "<body><div><div>Our slogan stays the same on all the pages of this host.</div><div>{body}</div><div>Imprint of us</div></div></body>"
    rows = site("a.org", 12, shell)
    df = spark.createDataFrame(rows, FIELDS)
    found = {r["page_id"]: r["text"] for r in main_text.extract_pages(df).collect()}
    assert found == {i: f"{prose(i, 40)}\n{prose(i + 1000, 60)}" for i, _, _ in rows}


def brute_templates(pages, min_pages, min_share_pct):
    """Frames and template texts per host by plain dictionaries."""
    out = {}
    hosts = {}
    for _, url, html in pages:
        hosts.setdefault(url.split("/")[2], set()).add(html)
    for host, htmls in hosts.items():
        read = {html: read_page(html) for html in htmls}
        seen = {}  # token: (is_tag, {page: (count, first place)})
        for html, page in read.items():
            for token, n in page.tags.items():
                seen.setdefault(token, (True, {}))[1][html] = (n, page.first[token])
            for b in page.blocks:
                known = seen.setdefault(main_text.text_token(b), (False, {}))[1]
                known[html] = (known.get(html, (0, 0))[0] + 1, known.get(html, (0, b.at))[1])
        often = {t: s for t, s in seen.items() if len(s[1]) >= min_pages}
        widest = max((len(s[1]) for s in often.values()), default=0)
        often = {t: s for t, s in often.items() if 100 * len(s[1]) >= min_share_pct * widest}
        classes = {}
        for token, (is_tag, on) in often.items():
            classes.setdefault(frozenset((page, n) for page, (n, _) in on.items()), []).append(token)
        valid = []
        for vector, tokens in classes.items():
            orders = {tuple(sorted(tokens, key=lambda t: (often[t][1][page][1], t))) for page, _ in vector}
            if len(orders) == 1:
                valid.append((vector, tokens))
        frames = [
            (len(vector), len([t for t in tokens if often[t][0]]), [t for t in tokens if often[t][0]])
            for vector, tokens in valid if all(n == 1 for _, n in vector) and any(often[t][0] for t in tokens)
        ]
        if not frames:
            continue
        frame = max(frames, key=lambda f: f[:2])[2]
        template = set()
        for vector, tokens in valid:
            if not any(often[t][0] for t in tokens):
                continue
            for t in tokens:
                on = often[t][1]
                slots = {sum(often[e][1][page][1] < at for e in frame if page in often[e][1]) for page, (_, at) in on.items()}
                if not often[t][0] and len(slots) == 1 and all(page in often[frame[0]][1] for page in on):
                    template.add(t)
        out[host] = (set(frame), template)
    return out


def varied(host, n):
    """Pages of one host: a frame, a notice on every second page, rows that repeat, swapped parts."""
    rows = []
    for i in range(n):
        notice = "<div id=n><p>A notice on every second page.</p></div>" if i % 2 else ""
        swapped = "<i></i><dl><dt>one</dl><ol><li>two</ol>" if i % 3 else "<ol><li>two</ol><dl><dt>one</dl>"
        items = "".join(f"<tr><td>cell {k}" for k in range(i % 4))
        rows.append((i, f"http://{host}/{i}", f"<body><div id=top>Same top.</div>{notice}<section><p>{prose(i, 30)}</p><table>{items}</table></section>{swapped}<div id=end>Same end.</div></body>"))
    return rows


def test_templates_as_by_brute_force(spark):
    pages = varied("one.org", 14) + varied("two.org", 4) + site("a.org", 9, "<body><nav>n</nav><article>{body}<p>All share this.</p></article></body>")
    pages += [(99, "http://one.org/copy", pages[0][2])]
    df = spark.createDataFrame(pages, FIELDS).withColumn("host", main_text.host_of(F.col("url")))
    found = {r["host"]: (set(r["frame"]), set(r["template"] or ())) for r in main_text.deduce_templates(df).collect()}
    assert found == brute_templates(pages, main_text.MIN_PAGES, main_text.MIN_SHARE_PCT)
    assert set(found) == {"one.org", "a.org"} and found["one.org"][1]


def test_without_names_the_frame_gives_the_same_text(spark):
    """Article elements made divs, classes gone: the slot with the prose is still found."""
    shell = "<html><head><title>t {i}</title></head><body><ul><li><a>x{i}</a><li><a>y</a></ul><div class='ad'>Buy number {i} now.</div><article><h1>Head {i}</h1>{body}</article><div class='footer'>Imprint {i} of the house.</div></body></html>"
    rows = site("n.org", 14, shell)
    bare = [(i, u, h.replace("article>", "div>").replace(" class='ad'", "").replace(" class='footer'", "")) for i, u, h in rows]
    texts = [
        sorted((r["page_id"], r["text"]) for r in main_text.extract_pages(spark.createDataFrame(pages, FIELDS)).collect())
        for pages in (rows, bare)
    ]
    assert texts[0] == texts[1] and texts[0][3][1].startswith("Head 3\n")


def test_a_passage_shared_by_articles_stays(spark):
    shared = "<p>A passage that every article of the host holds, word for word.</p>"
    rows = site("b.org", 20, "<body><nav>n</nav><article>" + shared + "{body}</article></body>")
    rows += [(100 + i, "http://b.org/copy", rows[0][2]) for i in range(30)]
    df = spark.createDataFrame(rows, FIELDS)
    for row in main_text.extract_pages(df).collect():
        assert row["text"].startswith("A passage that every article")


def test_awkward_rows(spark):
    rows = [(1, None, "<article>a</article>"), (2, "nonsense", "<p>b</p>"), (3, "HTTP://U@X.org:80/p", None), (None, "http://x.org", ""), (3, "HTTP://U@X.org:80/p", None), (4, "u", "é\x00<p>z")]
    df = spark.createDataFrame(rows, FIELDS).selectExpr("*", "1 as host", "2 as text", "3 as template", "4 as n_chars")
    found = main_text.extract_pages(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in found.collect()), key=repr)
    assert got == sorted([(1, "a", 1), (2, "b", 1), (3, "", 0), (None, "", 0), (3, "", 0), (4, "é\x00\nz", 4)], key=repr)
    assert main_text.extract_pages(df.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["http://A.org/x", "https://u:p@b.org:8080?q", "ftp://c", "/relative", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(main_text.host_of(df.url)).collect()] == ["a.org", "b.org", "c", None, None, None]
