import html
import re

from llm_fixtures import SF001, empty, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm.html_extract import extract, main_text, op2, path_scores


def test_layout_without_marked_article():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1><p>Welcome, to all. Enjoy!</p></header><div id=wrap>
    <div class="content"><h2>Title</h2><div class=txt><p>One para, with text; and more of it, as it goes.</p>
    <p>Two &amp; three,&nbsp;four <i>it</i>al<br>x.</p><ul><li>a, b</li><li>c</li></ul></div></div>
    <div class="sidebar"><p>Other, very long text. Which goes on, and on, and on; really. No end of it, ever.</p></div>
    <div id="comments"><p>I say, no! It is, as it were, wrong. I say, no! It is, as it were, wrong.</p></div></div><footer>foot</footer>"""
    assert main_text(page) == "Title\nOne para, with text; and more of it, as it goes.\nTwo & three, four ital x.\na, b\nc"


def test_boilerplate_longer_than_the_article():
    ad = "Buy, now, this. " * 40
    page = f"<body><nav><ul><li><a href=/>Home, page.</a></li></ul></nav><div class=ad>{ad}</div><article><h1>T</h1><p>Hi.</p>" \
           f"<aside>{ad}</aside><form><p>{ad}</p></form><p>Bye</p></article><div class=cookie-notice>{ad}</div>" \
           f"<section id=comments><article class=comment><p>{ad}</p></article></section></body>"
    assert main_text(page) == "T\nHi.\nBye"


def test_unequal_sections_without_an_article():
    long = [f"Part {i}, with text; and more of it, as it goes, on and on." for i in range(12)]
    for tag in ("main", "div id=content", "div"):
        page = f"<body><nav>menu</nav><{tag}><section><h2>A</h2>{''.join(f'<p>{x}</p>' for x in long[:9])}</section>" \
               f"<section><h2>B</h2>{''.join(f'<p>{x}</p>' for x in long[9:])}</section></{tag.split()[0]}></body>"
        assert main_text(page) == "\n".join(["A", *long[:9], "B", *long[9:]])
    page = f"<body><div class=one>{''.join(f'<p>{x}</p>' for x in long[:9])}</div><div class=two>{''.join(f'<p>{x}</p>' for x in long[9:])}</div>"
    assert main_text(page) == "\n".join(long)
    page = f"<body><main><section>{''.join(f'<p>{x}</p>' for x in long[:8])}</section><section><h2>B</h2>" \
           f"{''.join(f'<p>{x}</p>' for x in long[8:11])}</section></main><div class=two><p>{long[11]}</p></div>"
    assert main_text(page) == "\n".join([*long[:8], "B", *long[8:]])


def test_names_inside_an_article_condemn_less_than_half_of_it():
    body = [f"Part {i}, with text; and more of it, as it goes." for i in range(6)]
    for name in ("elementor-widget", "post-header-wrap", "notice-body"):
        for tag in ("article", "main"):
            one = f"<div class='{name}'>{''.join(f'<p>{x}</p>' for x in body)}</div>"
            each = "".join(f"<div class='{name}'><p>{x}</p></div>" for x in body)
            for inner in (one, each):
                assert main_text(f"<body><nav>menu</nav><{tag}>{inner}</{tag}></body>") == "\n".join(body)
            less = f"<div class=share-tags><p>Share, tag, and more; of it.</p></div>"
            assert main_text(f"<body><{tag}>{one}{less}</{tag}><div class=widget><p>{'Buy, now. ' * 90}</p></div>") == "\n".join(body)


def test_form_around_the_page():
    body = "<h1>T</h1><p>One, with text; and more.</p><p>Two, with text; and more of it.</p>"
    want = "T\nOne, with text; and more.\nTwo, with text; and more of it."
    for inner in (body, f"<article>{body}</article>", f"<fieldset><div>{body}</div></fieldset>"):
        page = f"<body><form id=aspnetForm>{inner}<select><option>no</select><button>Go</button></form></body>"
        assert main_text(page) == want
    assert main_text(f"<body>{body}<form><p>Search, now.</p></form></body>") == want


def test_items_between_paragraphs_of_the_body():
    items = [f"item {i}" for i in range(20)]
    para = ["One, with text; and more of it, as it goes, on and on.", "Two, with text; and more of it, as it goes, on and on."]
    page = f"<body><p>{para[0]}</p><ul>{''.join(f'<li>{x}</li>' for x in items)}</ul><p>{para[1]}</p></body>"
    assert main_text(page) == "\n".join([para[0], *items, para[1]])


def test_unclosed_raw_elements():
    for tag in ("svg", "canvas", "object", "math"):
        assert main_text(f"<article><p>a, b.</p><{tag}><p>c, d.</p><{tag}><p>e.</p></article>") == "a, b.\nc, d.\ne."
        assert main_text(f"<article><p>a, b.</p><{tag}>no</{tag}><p>c.</p></article>") == "a, b.\nc."
    assert main_text("<article><p>a, b.</p><script><p>c, d.</p></article>") == "a, b."


def test_repairs():
    assert main_text("<p>one<p>two<div>three</div></i></b>four") == "one\ntwo\nthree\nfour"
    assert main_text("<article><p><b>a<br><p>b</p><!-- <p>no</p> --><script>var t='</p><p>no';</script>c</article>") == "a\nb\nc"
    assert main_text("<article><p>cut <a href='x") == "cut"
    assert main_text("<article>a &lt;b&gt; &#233; &eacute; &unknown; 1 < 2 &amp;amp;</article>") == "a <b> é é &unknown; 1 < 2 &amp;"
    assert main_text("<ul><li>a, b.<li>c, d.</ul>") == "a, b.\nc, d."


def test_odd_pages():
    for page in (None, "", "   ", "<html></html>", "<script>x", "<!-- x", "<!doctype html>", "<nav>only a menu</nav>"):
        assert main_text(page) == ""
    assert main_text("just text") == "just text"
    assert len(main_text("<article>" + "<p>word, word.</p>" * 20000).split("\n")) == 20000
    assert main_text("<div>" * 300 + "deep, text." + "</div>" * 300) == "deep, text."


def test_scores_prefer_long_punctuated_paths():
    s = path_scores(["a/li"] * 4 + ["a/p"] * 4, [5] * 4 + [200] * 4, [0] * 4 + [9] * 4)
    assert min(s[4:]) > 5 * max(s[:4])


def test_query_finds_the_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = op2(spark, SF001).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        p = pages[r.page_id]
        body = p.html[p.html.index("<article>") + 9:p.html.index("</article>")]
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in want if x)
        assert (r.url, r.n_chars) == (p.url, len(r.text))


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, None, "kept"), (2, "<p>x, y.</p>", None)], "page_id long, html string, main_text string")
    got = extract(df)
    assert got.columns == ["page_id", "html", "main_text", "_main_text"]
    assert [r["_main_text"] for r in got.orderBy("page_id").collect()] == ["", "x, y."]
    assert extract(empty(df)).count() == 0


def seconds(page):
    import time
    at = time.perf_counter()
    text = main_text(page)
    return time.perf_counter() - at, text


def test_deep_and_unclosed_pages_take_linear_time():
    body = "Text, of some length; and more."
    assert main_text("<div>" * 100_000 + body) == body
    assert main_text("<ul><li>" * 20_000 + body) == body
    shapes = [lambda n: "<a href=\"x " * n, lambda n: "<a " * n, lambda n: "<a" * n, lambda n: "<a x='\"' y" * n,
              lambda n: "<!--" * n, lambda n: "<" * n, lambda n: "<div>a, b." * n, lambda n: "<div>" * n + "</ul>" * n + body,
              lambda n: "<ul><li><ul>" + "<div>" * n + "<li>x</li>" * n, lambda n: "<b>x" * n + "</i>" * n,
              lambda n: "<article>" + "<div class=widget>a." * n, lambda n: "<p>a, b.</p>" * n, lambda n: "<svg>" * n + body]
    for shape in shapes:
        seconds(shape(2000))
        one, four = seconds(shape(8000))[0], seconds(shape(32_000))[0]
        assert four < 12 * one + 0.5, shape(2)


def test_path_scores_equal_brute_force():
    import math
    import random
    r = random.Random(2)
    for _ in range(50):
        n = r.randint(1, 30)
        paths = [r.choice("abcd") for _ in range(n)]
        lengths, marks = [r.randint(1, 200) for _ in range(n)], [r.randint(0, 9) for _ in range(n)]
        ratio = lambda x, p: sum(v for v, q in zip(x, paths) if q == p) / paths.count(p)

        def smooth(x):
            w = lambda i, j: math.exp(-((i - j) ** 2) / 2) if abs(i - j) <= 3 else 0.0
            return [sum(w(i, j) * x[j] for j in range(n)) / sum(w(i, j) for j in range(n)) for i in range(n)]

        a, b = smooth([ratio(lengths, p) for p in paths]), smooth([ratio(marks, p) for p in paths])
        ma, mb = sum(a) / n or 1, sum(b) / n or 1
        fused = [x / ma * (y / mb) for x, y in zip(a, b)]
        want = [sum(f for f, q in zip(fused, paths) if q == p) / paths.count(p) for p in paths]
        assert all(abs(x - y) < 1e-9 for x, y in zip(path_scores(paths, lengths, marks), want))
