import html
import itertools
import random
import re

from ebbline.llm import html_mincut as h
from ebbline.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a = "</p><p>no";</script></head>
<body class="page"><header><a href="/">Site name</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies. <button>OK</button></div>
<article><h1>The title</h1><p>First   paragraph &lt;with&gt; <b>bo</b>ld &eacute;&#233;&#xe9; text.<br>Second line, and a few words more.
<p>Unclosed <a href="x">link</a> paragraph that goes on for a while.</p><!-- no <p>comment</p> -->
<aside>Read also this and that.</aside><p>Last one.</p>
<div class="comments"><p>I disagree with this long comment, which has sentences. Really.</p></div></article>
<form><input value="q"><p>Search here for things that you like.</p></form>
<div class="sidebar"><p>Most read things of today.</p></div><footer>&copy; 2024</footer></body></html>"""


def test_page():
    assert h.main_text(PAGE) == (
        "The title First paragraph <with> bold ééé text. Second line, and a few words more. Unclosed link paragraph that goes on for a while. Last one."
    )


def test_pages_without_main_element():
    body = "".join(f"<p>This is paragraph number {i} with enough words to look like running text, is it not?</p>" for i in range(5))
    page = f"<div id=nav><a href=1>One</a> <a href=2>Two</a></div><div>{body}</div><div class='footer-links'><a href=3>Imprint</a></div>"
    text = h.main_text(page)
    assert "number 0" in text and "number 4" in text and "One" not in text and "Imprint" not in text


def test_given_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op8_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        plain = html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


def cut_cost(label, gains, edges):
    own = sum(g if g > 0 and not on else -g if g <= 0 and on else 0 for g, on in zip(gains, label))
    return own + sum(c for (i, j), c in edges.items() if label[i] != label[j])


def test_min_cut_is_the_cheapest_labelling():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        gains = [rng.randint(-6, 6) for _ in range(n)]
        edges = {(i, j): rng.randint(1, 5) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5}
        found = h.min_cut(gains, edges)
        best = min(cut_cost(label, gains, edges) for label in itertools.product([False, True], repeat=n))
        assert cut_cost(found, gains, edges) == best


def test_a_long_page_with_unsure_blocks():
    page = "".join(f"<div><p>word {i}</p></div>" for i in range(4000))
    assert h.main_text(f"<article>{page}</article>").count("word") == 4000
    assert h.main_text(page) in ("", h.main_text(f"<article>{page}</article>"))


def test_broken_html():
    for text in ("<", "<p", "a < b", "<!--", "<script>x", "<p class='x", "</p></p>", "<![CDATA[x]]>", "<a b=\"" * 50, "&#0;&bogus;&amp", "\x00"):
        h.main_text(text)
    assert h.main_text("<article><p>a &lt b &amp; c &bogus; d < e") == "a < b & c &bogus; d < e"
    assert h.main_text("<article><p>x<script>if (a < b) '</p>'</script>y</p></article>") == "xy"


def test_words_within_attribute_values_are_no_attributes():
    for link in ('href="/hidden-costs"', 'title="a hidden valley"', "href=/a/hidden", "title='class=nav hidden' href=x", 'data-hidden="x" data-class="ad"'):
        assert h.main_text(f"<article><p>The <a {link}>linked words</a> stay in this paragraph.</p></article>") == "The linked words stay in this paragraph."
    assert h.main_text('<article data-title="The hidden sidebar"><p>Text.</p></article>') == "Text."
    for own in ("hidden", 'HIDDEN=""', 'class="x"hidden', "aria-hidden = 'true'", 'id=x hidden'):
        assert h.main_text(f"<article><p>Shown.</p><p {own}>Not shown.</p></article>") == "Shown."


def test_formulas_stay():
    formula = "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation encoding='application/x-tex'>E=m</annotation></semantics></math>"
    assert h.main_text(f"<article><p>So {formula} holds.</p></article>") == "So E=m holds."


STORY = "<h1>The title</h1>" + "".join(f"<p>Paragraph {i} of the story has a few more words than others.</p>" for i in range(3))
TOLD = "The title " + " ".join(f"Paragraph {i} of the story has a few more words than others." for i in range(3))


def test_layout_classes_on_wrappers():
    aside = '<div class="sidebar"><p>Most read things of the whole day, with sentences.</p></div><div id="comments"><article><p>I disagree. Really.</p></article></div>'
    for name in ("layout has-sidebar", "content no-sidebar", "site cookie-consent", "page-with-sidebar", "sidebar-left", "content-sidebar", "hasSidebar", "site notice"):
        for part in ("article", "main"):
            assert h.main_text(f'<div class="{name}"><{part}>{STORY}</{part}>{aside}</div>') == TOLD, (name, part)
        assert h.main_text(f'<div class="{name}"><div class="story">{STORY}</div>{aside}</div>') == TOLD, name
    assert h.main_text(f'<div class="sidebar-left"><article>{STORY}</article></div>{aside}') == TOLD


def test_names_of_a_part_with_main_words():
    title, rest = STORY.split("</h1>")
    assert h.main_text(f'<article><div class="article-header">{title}</h1></div>{rest}</article>') == TOLD
    assert h.main_text(f'<article><div class="header">{title}</h1></div>{rest}</article>') == TOLD
    for name in ("post-comments", "main-nav", "relatedPosts", "share", "cookie-notice", "site-footer"):
        assert h.main_text(f'<article>{STORY}<div class="{name}"><p>Some other text of the page, with an end.</p></div></article>') == TOLD, name


def test_articles_beside_the_main_part_stay_out():
    other = "<article><p>Something else that others wrote here.</p></article>"
    for name in ("sidebar", "related", "comments"):
        assert h.main_text(f'<article>{STORY}</article><div class="{name}">{other}</div>') == TOLD, name
    assert h.main_text(f"<article>{STORY}</article><footer><div class='content'>{other}</div></footer><aside>{other * 9}</aside>") == TOLD


LINKS = "<ul>" + "".join(f"<li><a href=/{i}>See {i}</a></li>" for i in range(3)) + "</ul>"


def test_link_lists_and_headings_within_the_article():
    links = "See 0 See 1 See 2"
    for page in (f"{STORY}{LINKS}", f"{STORY}<h2>See also</h2>{LINKS}", f"{STORY}<aside>Advert.</aside>{LINKS}<aside>Advert.</aside>", f"{STORY}<p><a href=/x>More</a></p>"):
        text = h.main_text(f"<nav>{LINKS}</nav><article>{page}</article><footer>{LINKS}</footer>")
        assert text == TOLD + page.count("See also") * " See also" + (f" {links}" if LINKS in page else " More"), page


def test_headings_and_short_lines_without_article():
    menu = f"<div class='menu'>{LINKS}</div><div>{LINKS}</div>"
    rest = STORY.split("</h1>")[1]
    first, second, third = (f"{p}</p>" for p in rest.split("</p>")[:3])
    told = [f"Paragraph {i} of the story has a few more words than others." for i in range(3)]
    for heading in ("<h1>Title</h1>", "<h2><a href=/t>Title</a></h2>", "<div><h1>Title</h1></div>", "<h1><span>Title</span></h1>"):
        assert h.main_text(f"{menu}<div>{heading}{rest}</div>{menu}") == "Title " + " ".join(told), heading
    for line in ("<h2>Part</h2>", "<h3><a href=/t>Part</a></h3>", "<p>Part</p>", "<ul><li>Part</li></ul>", "<p>Part:</p>"):
        part = "Part:" if ":" in line else "Part"
        assert h.main_text(f"{menu}<div>{first}{line}{second}{third}</div>{menu}") == f"{told[0]} {part} {told[1]} {told[2]}", line
    assert h.main_text(f"{menu}<div>{first}{second}{LINKS}</div>") == " ".join(told[:2])  # nothing says that these links belong to the text


def test_edge_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<article>Text of a page.</article>"), (4, "u", "<nav>x</nav>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    found = {(r.page_id, r.url): r.text for r in h.extract(pages).collect()}
    assert h.extract(pages).count() == 6
    assert found[2, None] == "" and found[3, "u"] == "" and found[4, "u"] == "" and found[None, "u"] == "Text of a page."
    assert h.extract(pages.limit(0)).count() == 0


def built_page(rng):
    """A page without article, main part or telling names, and its right text: headings that are links and short lines belong to
    the story or to the lists of links by where they stand."""
    words = "sea wind rain old calm stone bread light town field river night song horse winter".split()

    def sentence():
        return " ".join(rng.choice(words) for _ in range(rng.randint(14, 30))).capitalize() + "."

    def links():
        return "<ul>" + "".join(f"<li><a href=/{rng.randint(0, 99)}>{' '.join(rng.sample(words, 2))}</a></li>" for _ in range(rng.randint(3, 6))) + "</ul>"

    def lists():
        out = ""
        for _ in range(rng.randint(1, 3)):
            out += f"{links()}<p>{rng.choice(words).capitalize()}</p>{links()}"
        return f"<div>{out}</div>"

    story, told = "", []
    for part in range(rng.randint(2, 4)):
        title = " ".join(rng.sample(words, 2)).capitalize()
        heading = f"<a href=/t>{title}</a>" if rng.random() < 0.5 else title
        story += f"<h2>{heading}</h2>"
        told.append(title)
        for _ in range(rng.randint(2, 4)):
            told.append(sentence())
            story += f"<p>{told[-1]}</p>"
    return f"<div>{lists()}<div>{story}</div>{lists()}</div>", " ".join(told)


def test_pages_that_need_the_edges():
    """The cut turns blocks against their own cost, and is right where costs alone are not."""
    rng, turned, blocks, right, alone = random.Random(8), 0, 0, 0, 0
    for _ in range(200):
        page, told = built_page(rng)
        found = h.blocks(page)
        texts = [b.text for b in found]
        gains = [h.block_cost(b, t, h.Costs()) for b, t in zip(found, texts)]
        kept = h.min_cut(gains, h.smoothness(found, h.Costs()))
        turned += sum(k != (g > 0) for k, g in zip(kept, gains))
        blocks += len(found)
        right += h.main_text(page) == told
        alone += " ".join(t for t, g in zip(texts, gains) if g > 0) == told
    assert right >= 190 and alone <= 20, (right, alone)
    assert 0.05 < turned / blocks < 0.5, turned / blocks
