import random
import time
from collections import Counter
from html.parser import HTMLParser

import pytest

from gaugeline.llm.html_text import best_stretch, count_kinds, extract_text, learn_weights, main_text

SCHEMA = "page_id long, url string, html string"
WORDS = "one two three four five six seven eight nine ten"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav><a>Home</a></nav>", ""),
        (f"<article><h1>Title</h1><p>{WORDS}<p>Next&nbsp;&amp; last</article>", f"Title\n{WORDS}\nNext & last"),
        (f"<body><p> {WORDS}\n more\t<b>bo</b>ld<br>end </p></body>", f"{WORDS} more bold end"),
        (f"<header>Site</header><main><header><h1>T</h1></header><p>{WORDS}</p><footer>Tags</footer></main><footer>f</footer>", f"T\n{WORDS}"),
        (f"<article><p>{WORDS}</p><div class='comments'><p>Nice post, {WORDS} {WORDS}</p></div></article>", WORDS),
        (f"<article><p>{WORDS}</p><form>Name <input> <button>Go</button></form><aside>See</aside><p>End.</p></article>", f"{WORDS}\nEnd."),
        (f"<article><p>a &lt;b&gt; c &#233; &copy 1 < 2 {WORDS}</p></article>", f"a <b> c é © 1 < 2 {WORDS}"),
        (f"<article><p>x &am<b>p;</b> {WORDS}</p>", f"x &amp; {WORDS}"),
        (f"<script>var a = '<p>no</p>'</script><style>p</style><!-- <p>no</p> --><p>{WORDS}</p>", WORDS),
        (f"<article><ul><li>{WORDS}<li>two</ul></article>", f"{WORDS}\ntwo"),
        (f"<div class=ad>Buy {WORDS}</div><article><p>{WORDS}</p></article>", WORDS),
        (f"<body class='has-sidebar'><div id=sidebar>x {WORDS}</div><div class='page menu'><article><p>{WORDS}</p></article></div>", WORDS),
        (f"<p hidden>{WORDS}</p><p style='display: none'>{WORDS}</p><p>{WORDS}</p>", WORDS),
        (f"<article><p>{WORDS}</div></p><p>b</p></article>", f"{WORDS}\nb"),
        ("<article><p>unclosed <b", "unclosed"),
        (f"<article><p title='a>b'>{WORDS}</p></article>", WORDS),
        (f"<article><p title=don't>{WORDS}</p><p a=b\"c d='x>y' e = \"z>\">more</p></article>", f"{WORDS}\nmore"),
        (f"<article><p>{WORDS} <span class='ad-free'>ad-free</span></p><p class='social-history'>x</p><div class='widget'>y</div></article>", f"{WORDS} ad-free\nx\ny"),
        (f"<article><p>{WORDS}</p><p class='notice'>We use cookies</p><div class='comment-list'>Nice</div></article>", WORDS),
        (f"<article><p>{WORDS}</p><ul class='relatedPosts big'><li>x</ul><div class='user-comments'>Hi</div></article>", WORDS),
        (f"<article><p>{WORDS} <b>x</b> <i>y</i>\n<b>z</b><b>!</b></p></article>", f"{WORDS} x y z!"),
        (f"<b><article><div></b><p>{WORDS}</p></div></article>", WORDS),
    ],
)
def test_main_text(html, text):
    assert main_text(html, {}) == text


@pytest.mark.parametrize(
    ("inner", "kept"),
    [
        ("<section id='discussion'><p>Text</p></section>", "Text"),
        ("<h2 id='related-work'>Text</h2>", "Text"),
        ("<h2 id='search'>Text</h2>", "Text"),
        ("<section aria-label='Related work'><p>Text</p></section>", "Text"),
        ("<div id='hidden-costs'>Text</div>", "Text"),
        ("<p><math><mi>Text</mi><annotation>TeX</annotation></math></p>", "Text"),
        ("<div id='comments'>Text</div>", ""),
        ("<section class='comments'>Text</section>", ""),
        ("<section role='search'>Text</section>", ""),
        ("<h2 id='search' hidden>Text</h2>", ""),
    ],
)
def test_ids_inside_an_article_name_its_subjects(inner, kept):
    assert main_text(f"<article><p>{WORDS}</p>{inner}</article>", {}) == "\n".join(filter(None, (WORDS, kept)))


def test_without_markup_the_densest_stretch_wins():
    links = "".join(f"<div><a href=x>link {k}</a></div>" for k in range(40))
    body = "".join(f"<div>{WORDS} {WORDS} {k}</div>" for k in range(5))
    assert main_text(f"<body>{links}{body}{links}</body>", {}) == "\n".join(f"{WORDS} {WORDS} {k}" for k in range(5))


def test_the_stretch_has_the_highest_sum():
    chance = random.Random(2)
    for _ in range(200):
        scores = [(k, chance.choice([-3.0, -1.0, 1.0, 2.0, 4.0]), False) for k in range(chance.randrange(1, 14))]
        sums = {(a, b): sum(s for _, s, _ in scores[a : b + 1]) for a in range(len(scores)) for b in range(a, len(scores))}
        found = best_stretch(scores)
        assert (sums[found] if found else 0) == max(0, *sums.values())


def test_weights_come_from_labelled_pages(spark):
    page = f"<nav>{'<a>x</a>' * 9}</nav><article>{f'<p>{WORDS}</p>' * 9}</article>"
    weights = learn_weights(spark.createDataFrame([(1, "u", page)] * 30 + [(2, "u", "<section>none</section>")], SCHEMA))
    assert weights["#word"] > 0 > weights["p"] > weights["a"]
    assert weights["#link"] < 0
    assert "section" not in weights
    counts = Counter()
    count_kinds("<i>no label</i>", counts)
    assert not counts


def test_rows_of_all_kinds(spark):
    rows = [(1, "u", f"<article>{WORDS}</article>"), (1, "u", f"<article>{WORDS}</article>"), (None, None, None), (2, "u", "<p>" + "word " * 100_000), (3, "u", "<div>" * 20_000)]
    found = extract_text(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, len(WORDS)), (1, len(WORDS)), (2, 499_999), (3, 0)]
    assert extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 30_000 + "</b>" * 30_000,
        "<b>" + "<article>" + "<div></b>" * 20_000,
        "<div class='ad'>" * 20_000,
        f"<article><p>{WORDS}</p></article>" * 8_000,
        "<b>" * 20_000 + "<hr>" * 20_000,
        "<p title=" + "'" * 200_000,
        "<a " + "b='c' " * 60_000,
        "<" * 200_000,
    ],
)
def test_hostile_pages_take_linear_time(page):
    started = time.process_time()
    main_text(page, {})
    assert time.process_time() - started < 3


class PlainReader(HTMLParser):
    """Events of a well-formed page by the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("tag", tag))

    def handle_endtag(self, tag):
        self.events.append(("tag", tag))

    def handle_data(self, data):
        self.events.append(("text", data))


def random_page(chance, depth=3):
    parts = []
    for _ in range(chance.randrange(1, 5)):
        words = " ".join(chance.choice(["word", "caf&eacute;", "a&amp;b", "x"]) for _ in range(chance.randrange(1, 6)))
        tag = chance.choice(["div", "b", "section", "i"])
        inner = random_page(chance, depth - 1) if depth and chance.random() < 0.6 else words
        parts.append(chance.choice([words, f"<{tag}>{inner}</{tag}>", f"<div>{inner}</div>", " \n"]))
    return " ".join(parts)


def plain_text(html, weights):
    """The best stretch by trying them all, and its blocks."""
    reader = PlainReader()
    reader.feed(html)
    reader.close()
    events = [(kind, value) for kind, value in reader.events if kind == "tag" or value.split()]
    scores = [weights[v] if kind == "tag" else float(len(v.split())) for kind, v in events]
    sums = [0.0]
    for score in scores:
        sums.append(sums[-1] + score)
    stretches = [(-(sums[b] - sums[a]), b, -a) for a in range(len(events)) for b in range(a + 1, len(events) + 1)]
    low, high, first = min(stretches, default=(0, 0, 0))
    if low >= 0:
        return ""
    out = "".join("\n" if kind == "tag" and v in ("div", "section") else "" if kind == "tag" else " ".join(f" {v} ".split(" ")).replace("\n", " ") for kind, v in events[-first:high])
    return "\n".join(" ".join(line.split()) for line in out.split("\n") if line.split())


def test_whole_pages_equal_trying_every_stretch():
    chance = random.Random(8)
    weights = {"div": -1.75, "section": -2.25, "b": -0.375, "i": -0.625}
    for _ in range(300):
        page = random_page(chance)
        assert main_text(page, weights) == plain_text(page, weights), page
