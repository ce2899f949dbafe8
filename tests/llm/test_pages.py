from __future__ import annotations

import html
import random
from html.parser import HTMLParser

import pytest

from tagwright.llm import pages
from tagwright.llm.queries import op10_html_extraction

LONG = "word " * 59 + "end"

# A page, and its blocks of main text; L stands for sixty words.
CASES = {
    "headings whose ids are anchors": (
        "<article><h1>A</h1><p>L</p><h2 id='social-history'>Social history</h2><p>x y</p><h2 id=cookies>Cookies</h2><p>z</p></article>",
        ["A", "L", "Social history", "x y", "Cookies", "z"],
    ),
    "names that only hold such a word": (
        "<article><p>L</p><section class='related-work'><h2>Related work</h2><p>Others did.</p></section>"
        "<div class='share-price'>It rose.</div><section id=cookies><p>Bake them.</p></section></article>",
        ["L", "Related work", "Others did.", "It rose.", "Bake them."],
    ),
    "names of parts inside an article": (
        "<article><p>L</p><div class='share-buttons'><a href=a>One</a></div><div class='related-posts'><p>L</p></div>"
        "<div class='feedback-list'><p>I like it.</p></div><section id=comments><p>Me too.</p></section><p>End.</p></article>",
        ["L", "End."],
    ),
    "a name that is not in the list, beside the article": (
        "<article><p>L</p></article><ul class=voices><li>I like it very much and all the rest too</ul>", ["L"],
    ),
    "short news": (
        "<nav><a href=x>Home</a></nav><h1>Short news</h1><p>one two three four five six seven eight nine ten eleven twelve</p>",
        ["Short news", "one two three four five six seven eight nine ten eleven twelve"],
    ),
    "short last paragraph": ("<p>L</p><p>The end.</p><footer>c</footer>", ["L", "The end."]),
    "linked menu before, list of links behind": (
        "<div><a href=a>Home</a> <a href=b>News</a></div><p>L</p><h2>More</h2><ul><li><a href=1>World</a><li><a>Sport</a></ul>", ["L"],
    ),
    "form around a page": ("<form id=aspnet><div class=menu><a>Home</a></div><main><h1>T</h1><p>L</p></main></form>", ["T", "L"]),
    "title above the article": ("<nav><a>x</a></nav><h1>Title</h1><article><p>L</p></article><h2>More</h2><p>L</p>", ["Title", "L"]),
    "lists and tables without an article": (
        "<h1>T</h1><p>Take these:</p><ul><li>two eggs<li>some flour</ul><table><tr><th>Name<td>Ann</table><p>Mix.</p>",
        ["T", "Take these:", "two eggs", "some flour", "Name", "Ann", "Mix."],
    ),
    "blocks without paragraphs": (
        "<div><a>Home</a></div><div>L</div><div>A second short text.</div><div>L</div><div class=site-footer>imprint</div>",
        ["L", "A second short text.", "L"],
    ),
    "main with comments": (
        "<main><h1>T</h1><p>Intro</p><p>L</p><section class='comments'><p>L</p></section></main><p>out</p>", ["T", "Intro", "L"],
    ),
    "links in an article": ("<article><p>L</p><p><a href=x>See here</a></p><p>End</p></article>", ["L", "See here", "End"]),
    "nothing but links": ("<div><a>One</a></div><ul><li><a>Two</a><li><a>Three</a></ul>", []),
}


@pytest.mark.parametrize("case", CASES)
def test_main_text(case):
    page, blocks = CASES[case]
    got = pages.main_text(page.replace("L<", LONG + "<"), pages.default_tree())
    assert got == "\n\n".join(LONG if b == "L" else b for b in blocks)


def test_the_tree_goes_by_words_and_links():
    tree = pages.default_tree()
    used = set()

    def walk(node):
        if node.keep is None:
            used.add(pages.FEATURES[node.feature])
            walk(node.left)
            walk(node.right)

    walk(tree)
    assert {"words", "density", "density before", "density after"} <= used
    rows, label = pages.labelled_rows()
    assert [pages.keeps(tree, row) for row in rows] == list(label)
    folds = [[j for j in range(len(rows)) if j % 5 == k] for k in range(5)]
    right = 0
    for fold in folds:
        rest = [j for j in range(len(rows)) if j not in set(fold)]
        other = pages.train_tree(rows[rest], label[rest])
        right += sum(pages.keeps(other, rows[j]) == label[j] for j in fold)
    assert right / len(rows) >= 0.85


class PlainReader(HTMLParser):
    """Blocks of a well-formed page, character by character."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.text, self.silent = [], "", 0

    def cut(self):
        if self.text.split():
            self.blocks.append(" ".join(self.text.split()))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template"):
            self.silent += 1
        elif tag == "br":
            self.text += " "
        elif tag in pages.BLOCKS:
            self.cut()

    def handle_endtag(self, tag):
        if tag in ("script", "style", "template"):
            self.silent -= 1
        elif tag in pages.BLOCKS:
            self.cut()

    def handle_data(self, data):
        if not self.silent:
            self.text += data


def random_page(rng: random.Random, depth: int = 0) -> str:
    words = ["a &amp; b", "caf&eacute;", "x", " y\t", "&lt;p&gt;", "\n", "&#8212;", "1 < 2", ""]
    parts = []
    for _ in range(rng.randint(0, 5)):
        kind = rng.randint(0, 6)
        if kind < 2 or depth > 4:
            parts.append(rng.choice(words))
        elif kind == 2:
            parts.append(rng.choice(["<br>", "<!-- <p>no</p> -->", "<script>if (a<b) x('</p>')</script>", "<style>p{}</style>"]))
        elif kind == 3:
            tag = rng.choice(["b", "i", "span", "a"])
            parts.append(f"<{tag} title='a > b'>{rng.choice(words)}</{tag}>")
        else:
            tag = rng.choice(["div", "section", "ul", "h2", "article", "blockquote"])
            parts.append(f"<{tag} class=\"x\">{random_page(rng, depth + 1)}</{tag}>")
    return "".join(parts)


def test_blocks_against_a_plain_reader():
    rng = random.Random(5)
    for _ in range(400):
        page = random_page(rng)
        reader = PlainReader()
        reader.feed(page)
        reader.close()
        reader.cut()
        assert [b.text for b in pages.blocks_of(page)] == reader.blocks, page


def test_whole_table_against_a_plain_reader(spark):
    """The given pages: what stands in the article, nothing else."""
    sf = "/root/testdata/sf0.001"
    want = {}
    for row in spark.read.parquet(f"{sf}/pages.parquet").collect():
        reader = PlainReader()
        start = row.html.index("<article>")
        reader.feed(row.html[start : row.html.index("</article>", start)] + "</article>")
        reader.close()
        want[row.page_id] = "\n\n".join(reader.blocks)
    got = op10_html_extraction(spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_a_very_long_page():
    page = "<nav><a>x</a></nav><article>" + f"<p>{LONG}</p>" * 20_000
    assert pages.main_text(page, pages.default_tree()) == "\n\n".join([LONG] * 20_000)
    assert pages.main_text("<article><p>" + "w " * 10**6, pages.default_tree()) == ("w " * 10**6).strip()
    deep = "<div>" * 5_000 + html.escape("a < b") + "</div>" * 5_000
    assert pages.main_text("<article>" + deep, pages.default_tree()) == "a < b"
