from collections import defaultdict

import pytest

from gatewright.llm import html_consensus as op
from gatewright.llm.html_blocks import parse

SCHEMA = "page_id BIGINT, url STRING, html STRING, text STRING, host INT"
LONG = "Lorem ipsum dolor sit amet, consectetur. " * 6
FULL = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="x"><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="sidebar"><p>{LONG}</p></div>
<div class="wrap"><article class="post-17"><header><h1>Title &amp; more</h1><span>by me</span></header>
<p>First&nbsp;paragraph <b>bold</b><br>line <a href="#">link</a>.<p>Second &lt;p&gt; <i>one
  two</i><div class="ad">Buy</div><ul><li>a<li>b</ul><form><input name=q><p>search</p></form>
<table><tr><td>c<td>d<tr><td>e</table><!-- hidden <p>no</p> --><p hidden>gone</p><p>{LONG}</p>
<section class="comments"><p>{LONG}</p></section></article></div>
<aside>{LONG}</aside><footer>&copy; x</footer><script>if (a < b) {{ x("<p>") }}"""
EXPECTED = ["Title & more", "First paragraph bold line link.", "Second <p> one two", "a", "b", "c d", "e", LONG.strip()]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_full_page():
    assert op.extract(FULL, []).split("\n\n") == EXPECTED
    assert op.extract(FULL, [">body>nowhere", ">body.x>div.wrap>article.post-#"]).split("\n\n") == EXPECTED


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b", "a\n\nb"),
        ("a &am", "a &am"),
        ("<p>a</p><p", "a"),
        ("<p>a < b &lt; c</p>", "a < b < c"),
        ("<p title='x > y'>q</p>", "q"),
        ('<p title="broken>q</p>', "q"),
        ("<!-- never closed <p>a", ""),
        ("<script>never closed <p>a", ""),
        ("</p></div>a<br/>b", "a b"),
        ("<div>" * 500 + "deep", "deep"),
        ("<nav>only menu</nav>", ""),
    ],
)
def test_odd_pages(page, text):
    assert op.extract(page, []) == text


def test_long_and_hostile_pages_take_linear_time():
    op.extract("<p>" + "word " * 400_000, [])
    op.extract("<" * 200_000, [])
    op.extract('<p title="' * 20_000, [])


def plain_vote(rows):
    votes = defaultdict(lambda: defaultdict(float))
    for _, url, page in rows:
        if url and page and "//" in url:
            elements, blocks = parse(page)
            best = [x for x in op.ranked(elements, blocks)[: op.VOTES_PER_PAGE] if x[1] > 0]
            for k, s in best:
                votes[url.split("/")[2].lower()][elements[k].path] += s * s / sum(t * t for _, t in best)
    return {h: sorted(v, key=lambda p: (-round(v[p], 6), p)) for h, v in votes.items()}


def test_host_agrees_on_a_path(spark):
    page = "<body><div class='c'><p>%s</p></div><div class='box%d'><p>%s</p></div></body>"
    rows = [(i, "http://Site.example/a", page % (LONG, i, "short")) for i in range(6)]
    rows.append((6, "http://site.example/b", page % ("main but short", 6, LONG)))  # alone it would choose the box
    rows += [(7, "http://other.example/", page % ("main but short", 7, LONG)), (8, None, None), (9, "no url", "<p>x"), (9, "no url", "<p>x")]
    found = {r.agreed_host: r.paths for r in op.host_paths(pages(spark, rows)).collect()}
    assert found == plain_vote(rows)
    out = op.main_text(pages(spark, rows)).collect()
    texts = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert texts[6] == "main but short" and texts[7] == LONG.strip() and texts[8] == "" and texts[9] == "x"


def test_empty_table(spark):
    assert op.main_text(pages(spark, [])).count() == 0


TWO = "<body><div class='%s'><h1>T%d</h1><p>%s</p></div><p>%s</p></body>"


@pytest.mark.parametrize("rare", [1, 10])
def test_rare_template_is_not_outvoted(spark, rare):
    rows = [(i, "http://two.example/", TWO % ("common", i, LONG, "unmarked")) for i in range(90)]
    rows += [(100 + i, "http://two.example/", TWO % ("rare", i, LONG, "unmarked")) for i in range(rare)]
    for r in op.main_text(pages(spark, rows)).collect():
        assert r.text == f"T{r.page_id % 100}\n\n{LONG.strip()}"


def test_host_with_many_templates(spark):
    name = "abcdefghijklmnopqrst"
    rows = [(i, "http://many.example/", TWO % (name[i % 20], i, LONG, "unmarked")) for i in range(60)]
    rows.append((60, "http://many.example/", TWO % ("t", 60, "main but short", LONG * 2)))
    assert {r.page_id: r.text for r in op.main_text(pages(spark, rows)).collect()} == {
        i: f"T{i}\n\n" + (LONG.strip() if i < 60 else "main but short") for i in range(61)
    }


def test_host_agrees_on_the_body(spark):
    rows = [(i, "http://flat.example/", f"<body><p>{LONG}</p><div class='box'>more</div></body>") for i in range(9)]
    rows.append((9, "http://flat.example/", f"<body><p>short</p><div class='box'>{LONG}</div></body>"))
    rows += [(10 + i, "http://flat.example/", TWO % ("own", 10 + i, LONG, "unmarked")) for i in range(3)]
    texts = {r.page_id: r.text for r in op.main_text(pages(spark, rows)).collect()}
    assert texts[0] == LONG.strip() + "\n\nmore" and texts[9] == "short\n\n" + LONG.strip()
    assert texts[11] == "T11\n\n" + LONG.strip()


ARTICLE = f"<article><h1>T</h1><p>{LONG}</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='site has-sidebar'>{ARTICLE}</div>",
        f"<div class='with-comments'>{ARTICLE}</div>",
        f"<div id='no-banner'>{ARTICLE}</div>",
        f"<div class='search-results'>{ARTICLE}</div><p>x</p>",
        f"<div class='post comments-open'>{ARTICLE}</div>",
        f"<div class='search-results'><h2>T</h2><p>{LONG}</p></div>",
        f"<div data-hidden='false' title='a hidden thing'>{ARTICLE}</div>",
        f"<div id='comments' width='5' data-grid='x'><p>{LONG[:50]}</p></div>{ARTICLE}",
        f"{ARTICLE}<div class=comments><p>{LONG * 9}</p></div>",
        f"<h2>T</h2><p>{LONG}</p><div class=comments><article>{LONG * 9}</article></div>",
        f"{ARTICLE}<div class=sidebar><p>{LONG * 9}</p></div>",
        f"<form action='/x'><nav>menu</nav>{ARTICLE}<button>Send</button></form>",
        f"<form id='aspnetForm'><div><h2>T</h2><p>{LONG}</p></div></form>",
        f"<label>{ARTICLE}</label>",
        f"{ARTICLE}<form><p>Sign up for our letters</p></form>",
        f"{ARTICLE}<div class='related-posts'><p>More of {LONG}</p></div>",
        f"{ARTICLE}<div class='menu-evening'><a href=/a>Soup of the day</a> <a href=/b>Bread</a></div>",
        f"<div class='widget'>{ARTICLE}<section class=replies>{LONG * 9}</section></div>",
    ],
)
def test_wrappers_and_marks(page):
    assert op.extract(f"<body>{page}</body>", []) == f"T\n\n{LONG.strip()}"


@pytest.mark.parametrize("name", ["share-price", "social-policy", "related-work", "tasting-menu", "search_history", "banner-years"])
def test_names_of_subjects_inside_an_article(name):
    page = f"<article><h1>T</h1><p>{LONG}</p><div class='{name}'><p>A subject of its own, <a href='/s'>seen</a> here.</p></div></article>"
    assert op.extract(f"<body>{page}</body>", []) == f"T\n\n{LONG.strip()}\n\nA subject of its own, seen here."


def plain_main_text(rows):
    """The whole query with dictionaries: votes, shares and lists per host, then the first agreed path with text."""
    hosts = defaultdict(list)
    for i, url, page in rows:
        hosts[url.split("/")[2].lower() if url and "//" in url else None].append((i, page or ""))
    out = {}
    for host, listed in hosts.items():
        sums = defaultdict(lambda: [0.0, 0.0, 0])
        for _, page in listed if host else []:
            elements, blocks = parse(page)
            scored = op.ranked(elements, blocks)
            best = [x for x in scored[: op.VOTES_PER_PAGE] if x[1] > 0]
            votes = defaultdict(float)
            for k, _ in scored:
                votes[elements[k].path, elements[k].tag in ("", "body")] += 0.0
            for k, s in best:
                votes[elements[k].path, elements[k].tag in ("", "body")] += s * s / sum(t * t for _, t in best)
            for (path, outer), v in votes.items():
                row = sums[path, outer]
                row[0] += v
                row[1] += max((w for (_, o), w in votes.items() if o != outer), default=0.0)
                row[2] += 1
        agreed = [(outer, -round(round(v, 6) / (n + 1), 6), path) for (path, outer), (v, r, n) in sums.items() if v > 0 and n >= 2 and round(v, 6) > round(r, 6)]
        for i, page in listed:
            out[i] = op.extract(page, [path for *_, path in sorted(agreed)])
    return out


def test_query_equals_the_plain_version(spark):
    import random

    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))
    kinds = ["<body><div class='c{0}'><h1>{1}</h1><p>{2}</p></div><div class='side'>{3}</div></body>", "<body><p>{2}</p><section class='s{0}'>{3}</section></body>", "<main><div><p>{2}</p></div><div class='d{0}'><p>{3}</p></div></main>"]
    rows = [(i, f"http://h{rng.randrange(5)}.example/p", rng.choice(kinds).format(rng.randrange(3), words(2), words(rng.randrange(60)), words(rng.randrange(60)))) for i in range(150)]
    rows += [(200, None, kinds[0].format(1, "a", "b", "c")), (201, "http://h1.example", None), (202, "http://h1.example", "")]
    assert {r.page_id: r.text for r in op.main_text(pages(spark, rows)).collect()} == plain_main_text(rows)


def test_pages_of_a_large_host_are_dealt_to_parts(spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<body><div class='c{i % 3}'><p>{LONG}</p></div><div class='box'><p>{'x ' * i}</p></div></body>") for i in range(60)]
    frame = pages(spark, rows + [(99, None, "<p>alone")])
    own = frame.select("page_id", "url", op.host_of(op.F.col("url")).alias("own_host"))
    agreed = op.staged(op.host_paths(frame, agreed_only=True), "test-paths")
    found = [sorted((r.page_id, r.paths) for r in op.with_paths(own, agreed, most).collect()) for most in (1 << 20, 0)]
    assert found[0] == found[1] and len(found[0]) == 61 and found[0][0][1]


def test_links_to_hidden_places_keep_their_texts():
    assert op.extract(f"<p>see <a href='/hidden-gems'>gems</a> {LONG}</p>", []) == f"see gems {LONG.strip()}"
    assert op.extract(f"<p title='hidden'>{LONG}</p><p hidden>no</p><p data-x=1 hidden=''>no</p>", []) == LONG.strip()
