import html
import re

from icdspark.llm import html_extract as he
from icdspark.llm.queries import op8_html_extract

SF = "/root/testdata/sf0.001"


def plain(source):
    """The generator's pages: everything inside the article, a block for each heading and paragraph."""
    inside = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", source, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_brute_force(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op8_html_extract(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        text = plain(pages[r["page_id"]]["html"])
        assert r["text"] == text and r["n_chars"] == len(text) and r["url"] == pages[r["page_id"]]["url"]


def text_of(source):
    return "\n".join(he.parse(source)[0])


def test_markup_cases():
    assert text_of("<p>a &lt;b&gt; &amp;amp; &#233;&nbsp;c<br>d</p>") == "a <b> &amp; é c d"
    assert text_of("<article><header><h1>Title</h1></header><p>one<p>two</article><p>out") == "Title\none\ntwo"
    assert text_of("x < y and z > w <3 <p>ok") == "x < y and z > w <3\nok"
    assert text_of("<script>if (a < b) '</p>'</script>t<style>p{}</style><!-- c <p> -->u") == "tu"
    assert text_of("<div title='a > b'>in</div><script>never closed <p>x") == "in"
    assert text_of("<p>lost <b>bold<p>next</b> more</p>") == "lost bold\nnext more"
    assert text_of("") == text_of(None) == text_of("   ") == text_of("<p></p><div> </div>") == ""
    assert text_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert text_of("<p>&am &copy x &unknown; &") == "&am © x &unknown; &"


def test_raw_elements_without_an_end_lose_no_text():
    assert text_of("<p>a <svg width='1'/>b <math/> c</p><p>d") == "a b c\nd"
    assert text_of("<p>a <svg><path d='x'/><title>no</title></svg>b") == "a b"
    assert text_of("<p>a<select><option>one<p>b<object data=x><p>c<select><p>d") == "aone\nb\nc\nd"
    assert text_of("<p>a<style>p {} <p>b") == text_of("<p>a<script>b()<p>c") == "a"


def test_presentation_noise_goes():
    page = ("<body><header>top</header><nav>menu</nav><div class='sidebar left'>side</div><main><p>text"
            "<div id=comments><p>first!</div><aside>see also</aside><form><p>mail</form><div class=share>s</div>"
            "<div hidden>h</div><p>end</main><div class='cookie-notice'>ok</div><footer>f</footer>")
    assert text_of(page) == "text\nend"
    assert text_of("<body><div class=content><p>text</div><div class='ad'>buy</div>") == "text"
    assert text_of("<body class='has-sidebar'><p>text") == "text"
    assert text_of("<div class=header-image-free>x</div><div class=adventure>kept</div>") == "x\nkept"  # whole words only


def test_words_inside_other_words_say_nothing():
    body = "<article><h1>Title</h1><p>the story</p></article>"
    for around in ("div class=no-sidebar", "div class='content with-sidebar'", "div id=search-trees", "div class='page social'", "section class=widget"):
        assert text_of(f"<{around}>{body}</div></section>") == "Title\nthe story", around
    assert text_of("<article class='post widget-enabled'><p>the story</p></article>") == "the story"
    inside = "<article><div class=entry-header><h1>Title</h1></div><p class=market-share>shares rose<p class=free-form>and fell</article>"
    assert text_of(inside) == "Title\nshares rose\nand fell"


def test_votes_give_way_to_the_only_article():
    story = "<article><p>the story itself</p></article>"
    assert text_of(f"<div class=social>{story}<p>like us</p></div>") == "the story itself"
    # with an article outside, what is in the comments is no article
    assert text_of(f"{story}<div id=comments><article><p>first!</p></article></div>") == "the story itself"
    assert text_of(f"{story}<article class=comment><p>first!</p></article>") == "the story itself"
    assert text_of("<div class=widget><p>all that there is</p></div>") == "all that there is"


def test_articles_beside_the_main_text():
    long = "<p>" + "a long story " * 30 + "</p>"
    assert text_of(f"<div>{long}<article><p>a teaser</p></article></div>").startswith("a long story")
    assert text_of("<h1>Title</h1><article><p>the story</p></article><p>after") == "Title\nthe story"
    menu = "<ul><li><a href=a>one</a><li><a href=b>two</a><li><a href=c>three</a></ul>"
    assert text_of(f"<div>{menu}<p>text with <a href=d>a link</a> in it</p></div>") == "text with a link in it"
    assert text_of(menu) == "one\ntwo\nthree"  # a page of links alone


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(depth):
        source = "<div class=a>" * depth + "<p>deep</p>" * 50 + "</div>" * (depth // 2)
        begun = time.process_time()
        assert text_of(source) == "\n".join(["deep"] * 50)
        return time.process_time() - begun

    seconds(1000)
    assert seconds(40_000) < 20 * max(seconds(4_000), 0.02)


def test_a_repeated_paragraph_of_the_article_goes(make):
    def story(i, own):
        return f"<body><article><h1>Head {i}</h1><p>story {i} has its own words</p><p>Read more on our site.</p>{own}</article>"

    rows = [(i, f"http://a.example/{i}", story(i, "")) for i in range(12)]
    rows += [(20 + i, f"http://b.example/{i}", story(i, "")) for i in range(5)]
    rows += [(40 + i, "http://c.example/", story(1, f"<p>{i}</p>" if i == 9 else "")) for i in range(10)]  # copies of one page
    got = {r["page_id"]: r["text"] for r in he.extract(make(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head {i}\nstory {i} has its own words" for i in range(12))
    assert all(got[20 + i].endswith("Read more on our site.") for i in range(5))  # too few pages to tell
    assert all("Read more" in got[40 + i] for i in range(10))


def brute_tree(pages):
    """The tree over parsed pages in plain Python: which of the page's blocks stay."""
    from math import log2

    parsed = {i: (he.host_of(u), *he.parse(h)) for i, u, h in pages}
    texts, hosts = {}, {}
    for host, blocks, paths, starts, ends, contents, single in parsed.values():
        main = "\n".join(blocks)
        if paths:
            hosts.setdefault(host, set()).add(main)
        for path, content, one in zip(paths, contents, single, strict=True):
            texts.setdefault((host, path, one), set()).add((content, main))
    out = {}
    for i, (host, blocks, paths, starts, ends, contents, single) in parsed.items():
        stay = [True] * len(blocks)
        for path, a, b, content, one in zip(paths, starts, ends, contents, single, strict=True):
            seen = texts[host, path, one]
            own = sum(c == content for c, _ in seen)
            if one:
                low = own >= 8 and own >= 0.9 * len(hosts[host])
            else:
                n = len(seen)
                counts = [sum(c == x for c, _ in seen) for x in {c for c, _ in seen}]
                low = n >= 4 and own > 1 and -sum(k / n * log2(k / n) for k in counts) / log2(n) < 0.3
            if low:
                stay[a:b] = [False] * (b - a)
        out[i] = "\n".join(t for t, s in zip(blocks, stay, strict=True) if s)
    return out


def test_extract_equals_a_brute_force_tree(spark, make):
    import random

    rng = random.Random(7)
    rows = []
    for i in range(150):
        host = f"h{i % 4}.example"
        boxes = "".join(f"<div class=b{k}><p>{rng.choice(['same', 'same', 'same', f'own {i} {k}'])}</p></div>" for k in range(3))
        rows.append((i, f"http://{host}/{i}", f"<body><article><h1>t {rng.randint(0, 90)}</h1><p>text {i // 2}</p>"
                     f"<p>{'all have this' if i % 4 else rng.choice(['x', 'y'])}</p>{boxes}</article></body>"))
    got = {r["page_id"]: r["text"] for r in he.extract(make(rows, "page_id long, url string, html string")).collect()}
    assert got == brute_tree(rows)
    off = {r["page_id"]: r["text"] for r in he.extract(make(rows, "page_id long, url string, html string"), tree=False).collect()}
    assert sum(got[i] != off[i] for i in got) > 50
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert {r["page_id"]: r["text"] for r in op8_html_extract(spark, SF).collect()} == brute_tree(given)


def page(i, extra):
    return f"<body><div class=body><p>story {i} has its own words</p></div>{extra}</body>"


def test_style_tree_removes_what_a_host_repeats(make):
    same = "<div class=box><p>Follow us everywhere</p></div>"
    rows = [(i, f"http://a.example/{i}", page(i, same)) for i in range(6)]
    rows += [(10 + i, f"http://b.example/{i}", page(i, f"<div class=box><p>note {i}</p></div>")) for i in range(6)]
    rows += [(20, "http://c.example/", page(20, same))]
    got = {r["page_id"]: r["text"] for r in he.extract(make(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story {i} has its own words" for i in range(6))
    assert all(got[10 + i].endswith(f"note {i}") for i in range(6))
    assert got[20].endswith("Follow us everywhere")  # one page shows nothing about its host


def test_copies_of_an_article_are_no_template(make):
    rows = [(i, "http://a.example/x", page(1, "")) for i in range(9)]
    rows += [(20 + i, "http://a.example/y", page(20 + i, "")) for i in range(2)]
    got = he.extract(make(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"].startswith("story") for r in got)


def test_importance_is_relative_entropy(make):
    rows = [("h", "p", c, m) for m, c in enumerate([1, 1, 1, 1, 1, 1, 1, 2])]  # 0.54 bits of 3
    branches = make(rows, "host string, path string, content long, main long")
    assert he.low_branches(branches).count() == 1
    assert he.low_branches(branches, min_importance=0.1).count() == 0
    assert he.low_branches(branches, min_pages=9).count() == 0


def test_own_text_of_a_low_branch_stays(make):
    same = "<div class=box><p>Follow us everywhere</p></div>"
    rows = [(i, f"http://a.example/{i}", page(i, same)) for i in range(7)]
    rows.append((7, "http://a.example/7", page(7, "<div class=box><p>a note that only this page has</p></div>")))
    got = {r["page_id"]: r["text"] for r in he.extract(make(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story {i} has its own words" for i in range(7))
    assert got[7] == "story 7 has its own words\na note that only this page has"


def test_odd_rows(make):
    schema = "page_id long, url string, html string, row string, host string, texts string, removed string"
    extra = ("x",) * 4
    rows = [(1, None, None, *extra), (2, "", "", *extra), (3, "http://[bad", "<p>a", *extra), (3, "http://[bad", "<p>a", *extra),
            (None, "u", "<p>b", *extra), (4, "u", "<div>" * 3000 + "deep", *extra), (5, "u", "<p>" + "long " * 60_000, *extra)]
    got = he.extract(make(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == "" and by[1]["n_chars"] == 0 and by[3]["text"] == "a" and by[4]["text"] == "deep"
    assert by[5]["n_chars"] == 60_000 * 5 - 1 and by[None]["text"] == "b"
    assert he.extract(make([], schema)).collect() == []
