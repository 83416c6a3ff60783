import html
import math
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

from outletlab.llm.html_text import Tree, _select, extract_text, main_text
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF, words


def test_query_gives_the_articles(spark):
    """The pages' articles hold only headings and paragraphs, so their text is known."""
    got = {r.page_id: r for r in QUERIES["op2_html_text"](spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def page(body):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_boilerplate_is_left_out():
    a, b, c = words(1, 60), words(2, 80), words(3, 50)
    source = page(
        "<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div id=cookie-notice>We use cookies, lots of them, please agree.</div>"
        f"<div class='main'><aside><p>{words(4, 90)}</p></aside><h2>Title &amp; more</h2><p>{a}</p><div class=ad><p>{words(5, 70)}</p></div>"
        f"<p>{b[:50]}<b>{b[50:90]}</b>\n\t{b[90:]}</p><ul><li>first item<li>second <i>item</i></ul><blockquote>{c}</blockquote>"
        f"<form><p>{words(6, 60)}</p><input name=q></form><script>if (a < b) document.write('<p>{words(7, 90)}</p>')</script></div>"
        f"<section class='comments'><p>{words(8, 120)}</p><p>{words(9, 120)}</p></section><footer>&copy; {words(10, 40)}</footer>")
    want = ["Title & more", a, " ".join((b[:90] + " " + b[90:]).split()), "first item", "second item", c]
    assert main_text(source).split("\n\n") == want


def test_names_do_not_take_the_article_out():
    a, b = words(1, 60), words(2, 80)
    inner = f"<div class='ad banner'>{words(3, 40)}</div><h1>Head</h1><p>{a}</p><p>{b}</p>"
    for wrapped in (f"<div class='layout has-sidebar'><article class='widget'>{inner}</article></div>", f"<div id=content-with-menu>{inner}</div>"):
        assert a in main_text(page(wrapped)) and b in main_text(page(wrapped))
    assert main_text(page(f"<div class='layout has-sidebar'><article>{inner}</article></div>")) == "\n\n".join(["Head", a, b])


def test_anchors_and_headings_of_an_article_stay():
    a, b, c = words(1, 60), words(2, 80), words(3, 50)
    for inner in (f"<h2 id='related-work'>Related work</h2><p>{b}</p>", f"<h2 class='search'>Related work</h2><p>{b}</p>",
                  f"<section id='legal'><h2>Related work</h2><p>{b}</p></section>", f"<section aria-label='search'><h2>Related work</h2><p>{b}</p></section>"):
        for wrap in ("<article>{}</article>", "<div class=text>{}</div>"):
            source = page(wrap.format(f"<h1>Head</h1><p>{a}</p>{inner}<p>{c}</p>") + "<div id=sidebar>other things</div>")
            assert main_text(source) == "\n\n".join(["Head", a, "Related work", b, c]), source


def test_a_name_does_not_take_most_of_the_page_out():
    a, b = words(1, 60), words(2, 80)
    inner = f"<h1>Head</h1><p>{a}</p><div class='ad'>{words(3, 20)}</div><p>{b}</p>"
    for names in ("id='content' class='post has-sidebar'", "class='legal'"):
        assert main_text(page(f"<div {names}>{inner}</div><div>Some other text left.</div>")) == "\n\n".join(["Head", a, b])
    comments = f"<div class='comments'><p>{words(4, 200)}</p><p>{words(5, 200)}</p></div>"
    assert main_text(page(f"<div class='text'><h1>Head</h1><p>{a}</p><p>{b}</p></div>{comments}")) == "\n\n".join(["Head", a, b])


def test_hidden_is_an_attribute_not_a_word():
    a = words(1, 60)
    for attributes in ("title='The hidden life'", 'data-x="it is hidden"', "data-x='a aria-hidden=true'", "title='class=ad'", "data-class='ad'"):
        assert main_text(page(f"<article><h1>Head</h1><p {attributes}>{a}</p></article><p>rest</p>")).split("\n\n")[:2] == ["Head", a], attributes
        assert a in main_text(page(f"<article {attributes}><p>{a}</p></article><p>rest</p>")), attributes
    for attributes in ("hidden", "class=x hidden=''", "aria-hidden='true'", "aria-hidden=true", "style='color: red; display : none'", "style=display:none"):
        assert main_text(page(f"<article><p>{a}</p><p {attributes}>not shown</p></article>")) == a, attributes


def test_broken_markup_entities_and_nesting():
    assert main_text("") == "" and main_text("<p></p>") == "" and main_text("<script>var x = '<p>a</p>'") == ""
    assert main_text("plain &lt;text&gt; &eacute;&#233;&#xe9; a < b") == "plain <text> ééé a < b"
    assert main_text("<body><article><p>one<p>two &nbsp; x<br>y<!-- gone --><p>three") == "one\n\ntwo x y\n\nthree"
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    assert main_text(page(deep)) == "deep text"
    assert main_text('<p x="1"">hello</p><p>b') == "hello\n\nb"
    table = "<table><tr><td>a1<td>b1<tr><td>a2<td>b2</table>"
    assert main_text(page(table)).split("\n\n") == ["a1", "b1", "a2", "b2"]


def test_time_grows_with_the_page_only():
    began = time.process_time()
    for piece in ("<div>", "<p><b>", "<a href='", "<div class=ad>", "<header>", "</p><li>", "<b></i>", "<", '<a b="', "<!--", "<article><div class=menu>"):
        main_text(piece * 20_000 + "x")
    assert time.process_time() - began < 20


def test_rows_nulls_and_other_columns(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>hallo</p>", None), (3, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, "hallo"), (1, ""), (1, ""), (3, "")]
    assert extract_text(pages.limit(0)).collect() == []


def test_reader_comments_go_wherever_they_stand():
    a, b, c = words(1, 60), words(2, 80), words(3, 50)
    said = f"<p>{words(4, 90)}</p><p>{words(5, 40)}</p>"
    for tag, name in (("div", "id='comments'"), ("ol", "id='comments'"), ("section", "id='comments'"), ("div", "id=respond"),
                      ("div", "id='disqus_thread'"), ("section", "class='comments'"), ("div", "class='comment-list'"), ("ul", "aria-label='Comments'")):
        for wrap in ("<article>{}</article>", "<main>{}</main>", "<div class=text>{}</div>"):
            source = page(wrap.format(f"<h1>Head</h1><p>{a}</p><p>{b}</p><p>{c}</p><{tag} {name}>{said}</{tag}>"))
            assert main_text(source) == "\n\n".join(["Head", a, b, c]), source
    for kept in (f"<h2 id='comments'>Comments on it</h2><p>{c}</p>", f"<section id='comments-on-the-law'><h2>Comments on it</h2><p>{c}</p></section>"):
        assert main_text(page(f"<article><h1>Head</h1><p>{a}</p>{kept}<p>{b}</p></article>")) == "\n\n".join(["Head", a, "Comments on it", c, b]), kept


def test_topic_words_take_nothing_out_of_an_article():
    a, b, c = words(1, 60), words(2, 80), words(3, 50)
    for inner in (f"<p class='alert'>{b}</p>", f"<section class='privacy'><h2>Its title</h2><p>{b}</p></section>", f"<div class='legal notice'><p>{b}</p></div>",
                  f"<ul class='menu'><li>{b}</li></ul>"):
        source = page(f"<div class='menu'><a href=/>Home</a></div><article><h1>Head</h1><p>{a}</p>{inner}<p>{c}</p></article>")
        assert main_text(source) == "\n\n".join(["Head", a, *["Its title"] * ("Its" in inner), b, c]), inner
    for inner in (f"<p class='alert'>{b}</p>", f"<section class='privacy'><p>{b}</p></section>"):
        assert main_text(page(f"<div class=text><h1>Head</h1><p>{a}</p>{inner}<p>{c}</p></div>")) == "\n\n".join(["Head", a, b, c]), inner
    advert = f"<div class='ad'>{words(7, 30)}</div><p class='sponsored'>{words(8, 30)}</p>"
    assert main_text(page(f"<article><h1>Head</h1><p>{a}</p>{advert}<p>{c}</p></article>")) == "\n\n".join(["Head", a, c])


def test_unnamed_notices_and_footers_go():
    a, b = words(1, 60), words(2, 80)
    short = "A short closing line."
    text = f"<div><h1>Head</h1><p>{a}</p><p>{b}</p><p>{short}</p></div>"
    notice, footer = "We use cookies to improve the site. Accept.", "Copyright 2020 Someone. All rights reserved."
    want = "\n\n".join(["Head", a, b, short])
    menu = "<div><a href=/a>Home</a> <a href=/b>News</a> <a href=/c>About</a></div>"
    for source in (f"{menu}{text}<div>{notice}</div><div>{footer}</div>", f"<div>{notice}</div>{menu}{text}<div><p>{footer}</p></div>",
                   f"<div>{menu}{text}<div>{notice}</div></div><div>{footer}</div>"):
        assert main_text(page(source)) == want, source
    plain = f"<div>{a}</div><div>{b}</div><div>{words(3, 90)}</div>"  # the body itself is the article
    assert main_text(page(f"<div>{notice}</div>{plain}<div>{footer}</div>")) == "\n\n".join([a, b, words(3, 90)])
    about = f"<p>{a}</p><p>Nobody reads a cookie notice, says the copyright office.</p><p>{b}</p>"  # a topic of the article's own
    assert main_text(page(f"{menu}<div>{about}</div>")).count("\n\n") == 2


def test_the_title_before_the_text_stays():
    a, b = words(1, 60), words(2, 80)
    post = f"<div class=post><p>{a}</p><p>{b}</p></div>"
    menu = "<div class=menu><a href=/>Home</a></div>"
    for source in (f"{menu}<h1>Title</h1>{post}", f"{menu}<div><h1>Title</h1>{post}</div>", f"{menu}<div><div><h1>Title</h1>{post}</div></div>"):
        assert main_text(page(source)) == "\n\n".join(["Title", a, b]), source
    own = f"<h1>Site</h1><div class=post><h1>Title</h1><p>{a}</p><p>{b}</p></div>"  # the text has its own title
    assert main_text(page(own)) == "\n\n".join(["Title", a, b])


class Plain(HTMLParser):
    """Nodes of a well-formed page: name, parent and own text."""

    def __init__(self, source):
        super().__init__()
        self.nodes, self.stack = [["root", None, ""]], [0]
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        self.nodes.append([tag, self.stack[-1], ""])
        self.stack.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.nodes[self.stack[-1]][2] += data


def plain_best(source):
    """The text of the node with the largest sum of its children's densities, all counts by recursion."""
    nodes = Plain(source).nodes
    below = lambda k: [j for j in range(len(nodes)) if nodes[j][1] == k]
    chars = lambda k: len("".join(nodes[k][2].split())) + sum(map(chars, below(k)))
    links = lambda k: chars(k) if nodes[k][0] == "a" else sum(map(links, below(k)))
    tags = lambda k: sum(1 + tags(j) for j in below(k))
    anchors = lambda k: sum((nodes[j][0] == "a") + anchors(j) for j in below(k))
    text = lambda k: "".join(nodes[k][2].split()) + "".join(map(text, below(k)))
    body = next(k for k, n in enumerate(nodes) if n[0] == "body")

    def density(k):
        c, lc, t, lt = chars(k), links(k), max(tags(k), 1), max(anchors(k), 1)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * max(lc, 1) + links(body) / chars(body) * c + math.e)
        return c / t * max(math.log(max(c / max(lc, 1) * t / lt, 1 + 1e-9)) / base, 0.0)

    inside = [body]
    for k in inside:
        inside += below(k)
    best = max(inside, key=lambda k: (sum(map(density, below(k))), density(k), -k))
    return nodes[best][0], text(best)


def test_density_sums_equal_a_plain_version():
    rng = random.Random(12)

    def some(depth):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            n = rng.choice((2, 8, 30, 60))
            if kind < 0.5 or depth == 0:
                parts.append(f"<p>{words(rng.random(), n)}" + f"<a>{words(rng.random(), n // 4 + 1)}</a>" * rng.randrange(3) + "</p>")
            elif kind < 0.6:
                parts.append(f"<ul><li><a>{words(rng.random(), 2)}</a></li><li>{words(rng.random(), 3)}</li></ul>")
            else:
                parts.append(f"<{(tag := rng.choice(('div', 'section')))}>{some(depth - 1)}</{tag}>")
        return "".join(parts)

    for _ in range(120):
        source = f"<html><body>{some(3)}</body></html>"
        tree = Tree(source)
        _, best = _select(tree, [False] * len(tree.name))
        inside = [k == best for k in range(len(tree.name))]
        for k in range(best + 1, len(tree.name)):
            inside[k] = inside[tree.parent[k]]
        own = Counter("".join("".join(t.split()) for k, t in tree.parts if inside[k]))
        name, text = plain_best(source)
        assert (tree.name[best], own) == (name, Counter(text)), source
