import html
import re

from pyspark.sql import functions as F

from shelfwise.llm import html_content as H

W = H.weights_from({"footer": (0, 100), "/footer": (0, 100), "article": (0, 100), "/article": (0, 100), "p": (900, 3), "/p": (900, 3), "h1": (100, 0)})


def test_article_without_boilerplate():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
    <header class="top"><h1>Site name here</h1></header><div class="cookie-notice">We use cookies on this site, a lot of them</div>
    <nav><ul><li><a href="/">Home</a></li><li><a href="/x">Other</a></li></ul></nav><div id="sidebar"><p>Side text which is long enough to count here</p></div>
    <article><h1>Title &amp; more</h1><p>One <b>two</b>three
      four &lt;five&gt; caf&eacute;.<br>six</p><!-- no <p>comment</p> --><div class="ad">Buy now, cheap stuff, today only, buy now</div>
    <p>seven eight nine</p><form>Your name <input><button>Send</button></form><ul><li>first item</li><li>second item</li></ul>
    <section class="comments"><h2>Comments</h2><p>great post, I really liked it a lot</p></section></article>
    <aside>related things related things related things</aside><footer>&copy; footer words words words words words words words words</footer></body></html>"""
    assert H.main_text(page, W) == "Title & more\n\nOne twothree four <five> café. six\n\nseven eight nine\n\nfirst item\n\nsecond item"


def test_broken_and_empty_pages():
    assert H.main_text(None, W) == H.main_text("", W) == H.main_text("<br>", W) == ""
    assert H.main_text("just words", W) == "just words"
    assert H.main_text("<article><p>cut in the mid", W) == "cut in the mid"
    assert H.main_text("<article><p>cut in a tag</p><p clas", W) == "cut in a tag"
    assert H.main_text("<article><p>a b</p></article><footer>cut in the footer &am", W) == "a b"
    assert H.main_text("<div class='ad'>never closed<article><p>kept text here</p></article>", W) == "kept text here"
    assert H.main_text("<script>never closed <p>x</p>", W) == ""
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    assert len(H.main_text(long, W)) == 50_000 * 11 - 2
    assert H.main_text("a < b and <3 c", W) == "a < b and <3 c"


def test_names_cut_no_page_and_no_part_of_an_article():
    body = "<h1>Title</h1><p>one two three four five six</p>"
    for page in (f"<div class='page has-sidebar'><article>{body}</article></div>", f"<div class='widget'><main>{body}</main></div>",
                 f"<body><form>{body}</form></body>", f"<div id='content' class='no-banner'>{body}</div>", f"<div class='banner'>{body}</div><p>x</p>",
                 f"<form><aside>side words here</aside><article>{body}</article></form>"):
        assert H.main_text(page, W).startswith("Title\n\none two three four five six"), page
    page = ("<article><p>one two three four five six</p><h2 id='related-work'>Related work</h2><p>more words to read here</p><section id='skip-lists'>"
            "<p>a list that skips</p></section><p class='notice-period'>three months of notice</p><div class='share-prices'>prices rose and fell</div></article>")
    assert H.main_text(page, W) == ("one two three four five six\n\nRelated work\n\nmore words to read here\n\na list that skips\n\n"
                                    "three months of notice\n\nprices rose and fell")
    assert len(H.without_boilerplate([("open", "form", "<form>")] * 50_000)) == 1


def test_head_without_end_and_formulas():
    page = "<!doctype html><html><head><meta charset=utf-8><title>No</title><style>p{}</style><link rel=x><body><article><p>kept text here</p></article>"
    assert H.main_text(page, W) == H.main_text(page.replace("<body>", ""), W) == "kept text here"
    assert H.main_text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", W) == "so x=2 holds"


def test_tag_unseen_inside_a_sample_splits_no_article():
    w = H.weights_from({**{k: (0, 60) for k in ("div", "/div", "section", "/section", "article", "/article")}, "p": (900, 3), "/p": (900, 3)})
    words = " ".join(["word"] * 30)
    page = f"<div>menu</div><article><p>first {words}</p><div><section><p>{words}</p></section></div><p>last {words}</p></article><div>end</div>"
    assert H.main_text(page, w) == f"first {words}\n\n{words}\n\nlast {words}"
    assert -8.0 <= w["div"] < H.OTHER and w["article"] == H.WALL


def brute_region(scores):
    best, where = 0.0, (0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sum(scores[i:j]) > best + 1e-9:
                best, where = sum(scores[i:j]), (i, j)
    return best


def test_scan_finds_the_best_region():
    import random
    rng = random.Random(2)
    for _ in range(60):
        toks = [("text", "", "w " * rng.randint(1, 4)) if rng.random() < 0.5 else ("open", rng.choice(["p", "li", "a", "footer", "zz"]), "<x>") for _ in range(25)]
        scores = [len(t[2].split()) if t[0] == "text" else W.get(t[1], H.OTHER) for t in toks]
        lo, hi = H.region(toks, W)
        assert abs(sum(scores[lo:hi]) - brute_region(scores)) < 1e-9


def article_of(page):
    """Plain version for the table's pages."""
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)(?:>|\Z)", m[1]) if m else []
    out = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", x.replace("<br>", " "))).split()) for x in parts]
    return "\n\n".join(x for x in out if x)


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages, H.fit_weights(pages)).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article_of(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_nulls_repeats_clashes_and_empty_table(spark):
    rows = [(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("chosen", F.lit(1)).withColumn("tag", F.lit(1))
    w = H.fit_weights(df)
    got = sorted(map(tuple, H.extract(df, w).collect()), key=repr)
    assert got == sorted([(1, "u", "a b", 3)] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    empty = df.where("page_id > 5")
    assert H.extract(empty, H.fit_weights(empty)).collect() == []


def test_weights_of_repeated_pages_and_null_ids(spark):
    page = "<html><body><nav><a>x</a></nav><article><p>some words of text</p></article></body></html>"
    other = [page.replace("some", f"some{i}").replace("<p>", "<p><b>x</b>") for i in range(40)]
    rows = [(i, p) for i, p in enumerate(other)]
    schema = "page_id long, html string"
    want = H.fit_weights(spark.createDataFrame(rows, schema), sample=45)
    repeated = spark.createDataFrame(rows + [(0, other[0])] * 2000, schema)
    assert H.fit_weights(repeated, sample=45) == want
    assert H.fit_weights(spark.createDataFrame([(None, p) for _, p in rows], schema), sample=45) == want


PARAGRAPHS = "".join(f"<p>{' '.join(f'word{i}' for i in range(k, k + 40))}</p>" for k in (0, 40, 80))
TAIL = "last words of it"


def test_articles_keep_tables_lists_code_and_figures():
    # weights under which every such tag is dear
    dear = W | {k: -8.0 for name in "table tr td ul li a pre span figure img aside h2".split() for k in (name, "/" + name)}
    table = "<table>" + "".join(f"<tr><td>a{i}</td><td></td></tr>" for i in range(30)) + "</table>"
    links = "<ul>" + "".join(f"<li><a href='/{i}'>l{i}</a></li>" for i in range(30)) + "</ul>"
    code = "<pre><code>" + "".join(f"<span class='token comment'>c{i}</span> " for i in range(60)) + "</code></pre>"
    figures = "<figure><img src=x></figure>" * 10
    aside = "<aside>not this</aside>"
    for held in (table, links, code, figures, aside):
        for order in (f"<h1>Title</h1>{PARAGRAPHS}{held}<p>{TAIL}</p>", f"<h1>Title</h1>{held}{PARAGRAPHS}<p>{TAIL}</p>"):
            got = H.main_text(f"<nav>menu words</nav><article>{order}</article><footer>foot</footer>", dear)
            assert got.startswith("Title\n\n") and got.split("\n\n")[-1] == TAIL
            plain = re.sub(r"<aside>.*?</aside>", "", order)
            assert re.sub(r"\s+", "", got) == re.sub(r"<[^>]*>|\s+", "", plain)


def test_articles_beat_teasers_and_several_of_one_main_stay():
    teasers = "<div class='list'>" + "<p>teaser words that go on and on for a while</p>" * 30 + "</div>"
    assert H.main_text(f"{teasers}<article><p>short one</p></article>{teasers}", W) == "short one"
    two = "<article><h2>One</h2><p>first text</p></article><div class='ad'>buy</div><article><h2>Two</h2><p>second text</p></article>"
    assert H.main_text(f"{teasers}<main>{two}</main>", W) == H.main_text(f"<body>{two}</body>", W) == "One\n\nfirst text\n\nTwo\n\nsecond text"
    assert H.main_text(f"<main><h1>Title</h1><p>by me</p><article>{PARAGRAPHS}</article></main>", W).startswith("Title\n\nword0")
    assert H.main_text(f"<main><p>no article here</p><p>but words</p></main>{teasers}", W) == "no article here\n\nbut words"
    # an article left open ends with the next one; an empty one doesn't count
    assert H.main_text("<main><article><h1>T</h1><p>a b<article><p>c d</main><p>e f</p>", W) == "T\n\na b\n\nc d"
    assert H.main_text("<article></article><div><p>some words</p></div>", W) == "some words"
    more = f"<article>{PARAGRAPHS}</article><div class='more'><article><p>other one</p></article></div>"
    assert "other one" not in H.main_text(f"<body>{more}</body>", W)


def test_reader_comments_never():
    comment = "<p>" + "I liked this a lot " * 36 + "</p>"
    for held in (f"<div class='user-comment'>{comment}</div>", f"<ol class='comment-list'><li>{comment}</li></ol>", f"<section id=comments>{comment}</section>",
                 f"<article class='comment'>{comment}</article>", f"<div class='reader_comments x'>{comment}</div>"):
        for page in (f"<article><p>kept text</p></article>{held}", f"<article><p>kept text</p>{held}</article>", f"<main><p>kept text</p>{held}</main>",
                     f"<div><p>kept text that is long enough to be most of it {'word ' * 200}</p></div>{held}"):
            assert "liked" not in H.main_text(page, W) and H.main_text(page, W).startswith("kept text"), page


def test_quoted_angle_brackets():
    assert H.main_text("""<article><p title='a > b' data-x="</p>">kept <a href="?a>b">text</a></p></article>""", W) == "kept text"
    assert H.main_text("<article><p title=don't>it's kept</p><p class=\"open>and this</p></article>", W) == "it's kept\n\nand this"
    assert H.main_text("<script data-a='>'>var x</script><svg/><p>kept here</p>", W) == "kept here"
    assert H.main_text("<p " + "a=\"" * 20_000 + ">kept", W) in ("kept", "")
