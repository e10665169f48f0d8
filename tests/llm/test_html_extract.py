from landgrid.llm.html_extract import extract_main_text as X

LONG = "A first sentence of the article, with commas, and some length to it so that it scores. " * 3


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_empty_and_broken():
    assert X(None) == "" and X("") == "" and X("<p></p>") == "" and X("<!-- only") == ""
    assert X("plain   text\n here") == "plain text here"
    assert X("<p>a<p>b") == "a\n\nb"
    assert X("a < b and 3 > 2") == "a < b and 3 > 2"


def test_furniture_goes():
    body = f"""<header class="site-header"><a href=/>Home</a><p>Slogan of the site, long, long, long enough.</p></header>
    <nav><ul><li><a href=/a>A</a></li></ul></nav><div id="cookie-notice"><p>{LONG} cookies</p></div>
    <div class="layout has-sidebar"><article><h1>Title</h1><p>{LONG}</p><div class="ad">Buy</div>
    <form><input><label>mail</label></form><script>var t="</p>";</script><style>p{{}}</style><p>Short &amp; last.</p>
    <section class="comments"><p>{LONG} reader</p></section></article>
    <aside><p>{LONG} aside</p></aside></div><footer>&copy; x</footer>"""
    assert X(page(body)) == f"Title\n\n{LONG.strip()}\n\nShort & last."


def test_scoring_without_semantics():
    body = f"""<div class="top"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div>
    <div class="wrap"><div class="x1"><p>{LONG}</p><p>{LONG}</p></div>
    <div class="x2"><a href=1>{LONG}</a></div></div>"""
    assert X(page(body)) == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_short_article_wins_over_nothing():
    assert X(page("<nav><a href=/>x</a></nav><article><p>Is.</p></article><footer>long footer text, with commas</footer>")) == "Is."


def test_unclosed_inline_and_truncated():
    assert X("<html><body><article><h1>A &am</h1><p><b>one<br>two<p>three</p></article><footer>f") == "A &am\n\none two\n\nthree"


def test_sections_join():
    body = f"<div id=c><div><p>{LONG}</p></div><div><p>{LONG}</p></div></div>"
    assert X(page(body)) == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_semantic_tags_only_add_weight():
    text, body = LONG.strip(), f"<p>{LONG}</p><p>{LONG}</p>"
    teaser = "<article><p>Read this too.</p></article>"
    assert X(page(f"<main>{teaser}<div class=x><h1>Title</h1>{body}</div></main>")) == f"Title\n\n{text}\n\n{text}"
    assert X(page(f"{teaser}<section>{body}</section>")) == f"{text}\n\n{text}"
    assert X(page(f"<article>{body}</article><div><p>{LONG}</p></div><p>The last, short.</p>")) == f"{text}\n\n{text}\n\n{text}\n\nThe last, short."
    assert X(page(f"<div class=a><article>{body}</article></div><div class=b><p>{LONG}</p></div>")) == f"{text}\n\n{text}\n\n{text}"
    assert X(page(f"<main><p>Loading.</p></main><div><div role='main'>{body}</div></div>")) == f"{text}\n\n{text}"
    assert X(page(f"<article><section><div>{body}</div></section><section><p>Short.</p></section></article>")) == f"{text}\n\n{text}\n\nShort."


def test_whitespace_and_entities():
    assert X("<article><p>a\n\t b&nbsp;c &#233;&#x41; &lt;b&gt;</p></article>") == "a b c éA <b>"


def test_query(spark, tmp_path):
    rows = [(1, "u", "<article><p>x</p></article>"), (2, None, None), (2, None, None), (None, "v", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    from landgrid.llm.html_extract import op1_html_extract

    out = sorted(tuple(r) for r in op1_html_extract(spark, str(tmp_path)).fillna(-1).fillna("").collect())
    assert out == [(-1, "v", "", 0), (1, "u", "x", 1), (2, "", "", 0), (2, "", "", 0)]


def test_extra_clashing_columns(spark):
    from landgrid.llm.html_extract import extract

    df = spark.createDataFrame([(1, "<p>t</p>", "old", 9)], "page_id long, html string, text string, n_chars int")
    assert extract(df).collect()[0].asDict() == {"page_id": 1, "n_chars": 9, "text": "t"}


def test_time_grows_with_the_length_alone():
    import time

    for unit in ("<div><p>", "<div>", "<b>", "<ul><li>", "<b><div></b>", "<div></i>", "<main><article>", "<header><div>", "<ul><li><a href=x>", "<div><hr>"):
        began = time.time()
        X(unit * 50_000 + LONG)
        assert time.time() - began < 8, unit


def test_very_long_page():
    assert len(X("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>")) == 20_000 * (len(LONG) - 1) + 2 * 19_999


def naive(root, nodes):
    """Lengths and points by walking up from every string, as the definition reads."""
    from landgrid.llm.html_extract import AGAINST, BLOCK, FOR, HEADINGS, NAME_WEIGHT, PARAGRAPH_FULL, _WORDS, _clean

    total, links, points, blocks = {}, {}, {}, {}
    for node in nodes:
        for c in (c for c in node.children if isinstance(c, str)):
            text = " ".join(_clean(c).split())
            chain = [node, *node.up()]
            block = next((x for x in chain if x.tag in BLOCK or x.tag in ("td", "th")), root)
            blocks.setdefault(block, [0, 0])
            blocks[block][0] += len(text)
            blocks[block][1] += sum(text.count(x) for x in ",，、")
            for x in [block, *block.up()]:
                total[x] = total.get(x, 0) + len(text)
                links[x] = links.get(x, 0) + len(text) * any(y.tag == "a" for y in chain)
    for block, (n, commas) in blocks.items():
        if not n or block.tag in HEADINGS:
            continue
        worth = min(1, n / PARAGRAPH_FULL) + commas + min(n / 100, 3)
        chain = list(block.up()) if block.tag in ("p", "pre", "td", "th", "li", "dd", "blockquote", "tr", "figcaption") else [block, *block.up()]
        for part, x in zip((1, 2, 6, 9, 12, 15), chain):
            if x.tag == "#root":
                break
            if x not in points:
                names = set(_WORDS.findall(x.attrs.lower()))
                points[x] = NAME_WEIGHT * (bool(names & FOR) - bool(names & AGAINST)) * (worth > 1)
            points[x] += worth / part
    return total, links, {x: v * (1 - (links[x] / total[x] if total[x] else 0)) for x, v in points.items()}


def test_scores_against_brute_force():
    import random

    from landgrid.llm.html_extract import _descendants, measure, parse

    rng = random.Random(4)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 60)):
            kind = rng.random()
            tag = rng.choice("div p section a b ul li h2 article main td table span blockquote".split())
            parts.append(f"<{tag} class='{rng.choice(['x', 'entry', 'meta', 'body tool'])}'>" if kind < 0.45 else f"</{tag}>" if kind < 0.7 else "some words, of text &amp; more " * rng.randint(1, 6))
        root = parse("".join(parts))
        nodes = [root, *_descendants(root)]
        total, links, points = naive(root, nodes)
        scored = measure(root)
        assert {x: x.text_len for x in nodes if x.text_len} == {x: v for x, v in total.items() if v}
        assert {x: x.link_len for x in nodes if x.link_len} == {x: v for x, v in links.items() if v}
        assert {id(x) for x in scored} == {id(x) for x in points}
        assert all(abs(x.score - points[x]) < 1e-9 for x in scored)
