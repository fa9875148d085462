"""Elements by nesting depth: hand-written review pages, odd markup, and a plain parser."""

from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.operators import extract as X
from critiq.operators import markup as M
from critiq.operators.markup import Element

PAGE = "publisher string, version string, umbrella_item string, page int, html string"


def block(user, title, body, rating="4.0", date="on March 5, 2017", link="", classes="a-section review aok-relative"):
    # Class names and ids of the shop's pages.
    return (f'<div data-hook="review" id="customer_review-{user}" class="{classes}"><div class="a-row"><div><i class="a-icon">'
            f'<span class="a-icon-alt">{rating} out of 5 stars</span></i></div>'
            f'<a data-hook="x" class="a-size-base a-link-normal review-title a-color-base a-text-bold" href="#">{title}</a></div>'
            f'<span class="a-size-base a-color-secondary review-date">{date}</span>{link}'
            f'<div class="inner"><span class="a-size-base review-text">{body}</span><span>after the body</span></div></div>')


def page(*blocks, total="1,234", after=""):
    return (f'<html><head><script>var t = "<div id=\'cm_cr-review_list\'>";</script></head><body><!-- <div class="a-section review"> -->'
            f'<span class="a-size-medium totalReviewCount"> {total} </span><div id="cm_cr-review_list" class="a-section">{"".join(blocks)}</div>{after}</body></html>')


def extracted(spark, *pages):
    rows = [("P", "V", "77", i, h) for i, h in enumerate(pages)]
    return [tuple(r[c] for c in ("page", "block_pos", "user_id", "review_item", "rating", "title", "body", "review_ts"))
            for r in M.reviews(spark.createDataFrame(rows, PAGE), ["publisher", "version", "umbrella_item", "page"], "umbrella_item")
            .orderBy("page", "block_pos").collect()]


def test_fields_end_at_their_own_tag(spark):
    link = '<a class="a-size-mini a-link-normal a-color-secondary" href="/x/product-reviews/88AB">Kindle</a>'
    got = extracted(spark, page(
        block("R1A", "One &amp; <b>two</b>", 'Body <span>inner <span>deep</span></span> end<br>line', link=link),
        block("R2B", "Two", 'see <a href="/product-reviews/99">5.0 out of 5 stars</a>', rating="3")))
    assert got == [(0, 0, "R1A", "88AB", 4.0, "One & two", "Body inner deep end line", 1488672000),
                   (0, 1, "R2B", "77", 3.0, "Two", "see 5.0 out of 5 stars", 1488672000)]  # neither rating nor edition from the body


def test_container_and_blocks_end_at_their_own_tag(spark):
    outside = block("OUT", "outside", "of the list")
    got = extracted(spark, page(block("A1", "a", "b") + '<div class="a-section">no review</div>', after=outside), outside, page())
    assert [g[2] for g in got] == ["A1"]
    inner = block("A1", "outer", "text" + block("B2", "inner", "its text"))
    got = extracted(spark, page(inner, block("C3", "c", "d")))
    assert [(g[1], g[2], g[5]) for g in got] == [(0, "A1", "outer"), (1, "C3", "c")]  # the outer of two counts


def test_odd_markup(spark):
    got = extracted(
        spark, None, "", "no tags < at > all", '<div id="cm_cr-review_list">' + block("U1", "never", "closed"),
        page(block("U2", "t", "stray</div></div></span> ends")), page("</div></span>" + block("U3", "t", "b")),
        page(block("U4", "t", '<img alt="a > b" src="x"/>shown<span/>')), page(block("U5", "", "", rating="none", date="later")),
        page(block("U6", "x" * 50_000, "word " * 100_000)), page(block("U7", "one", "b", classes="a-section review-x")),
        page('<DIV ID="customer_review-U8" CLASS=\'a-section review\'><SPAN CLASS="a-icon-alt">2 out of 5 stars</SPAN></DIV>'))
    by_user = {g[2]: g for g in got}
    assert set(by_user) == {"U1", "U2", "U4", "U5", "U6", "U8"}  # a stray end tag closes U3's list before it
    assert by_user["U1"][5:7] == ("never", "closed") and by_user["U2"][6] == "stray"
    assert by_user["U4"][6] == "shown" and by_user["U5"][4:] == (None, "", "", None)
    assert len(by_user["U6"][5]) == 50_000 and by_user["U6"][6] == ("word " * 100_000).strip()
    assert by_user["U8"][4] == 2.0


def test_totals(spark):
    rows = [(1, page()), (2, page(total=" 0 ")), (3, page(total="many")), (4, None), (5, "<p>no total</p>"),
            (6, '<span class="totalReviewCount"><b>12</b></span><span class="totalReviewCount">7</span>')]
    got = {r["id"]: r["stated_total"] for r in M.stated_totals(spark.createDataFrame(rows, "id int, html string"), ["id"]).collect()}
    assert got == {1: 1234, 2: 0, 3: None, 4: None, 5: None, 6: 12}


class Plain(HTMLParser):
    """Outer elements of one name with a class, by counting its tags."""

    def __init__(self, name, cls):
        super().__init__()
        self.name, self.cls, self.depth, self.found = name, cls, 0, []

    def handle_starttag(self, tag, attrs):
        if self.depth and tag == self.name:
            self.depth += 1
        elif not self.depth and tag == self.name and self.cls in (dict(attrs).get("class") or "").split():
            self.depth = 1
            self.found.append([])
        elif self.depth:
            self.found[-1].append(" ")

    def handle_endtag(self, tag):
        if self.depth and tag == self.name:
            self.depth -= 1
        if self.depth:
            self.found[-1].append(" ")

    def handle_data(self, data):
        if self.depth:
            self.found[-1].append(" " + data + " ")


def test_nested_elements_against_a_plain_parser(spark):
    rng = np.random.default_rng(7)

    def made(depth=0):
        out = []
        for _ in range(rng.integers(1, 5)):
            kind = rng.integers(0, 5)
            if kind < 2 or depth > 4:
                out.append(f"w{rng.integers(0, 99)}")
            else:
                name = str(rng.choice(["div", "span", "b"]))
                cls = str(rng.choice(["x", "y", "x y"]))
                out.append(f'<{name} class="{cls}">{made(depth + 1)}</{name}>')
        return " ".join(out)

    pages = [(i, f'<main>{made()}</main>') for i in range(60)]
    frame = spark.createDataFrame(pages, "id int, html string")
    rows = M.blocks(frame, ["id"], Element(("main",)), Element(("div",), ("x",)), {})
    got = {}
    for r in rows.groupBy("id", "block").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("t")).orderBy("id", "block").collect():
        got.setdefault(r["id"], []).append(" ".join(r["t"].split()))
    for i, h in pages:
        p = Plain("div", "x")
        p.feed(h)
        assert got.get(i, []) == [" ".join("".join(f).split()) for f in p.found]


def test_paragraphs_without_end_tags(spark):
    html = '<article><h1>t</h1><p>one<br>more<p>two</p>between<p class="z"> three </p><ul><li>x</li></ul></article><p>outside'
    got = X.paragraphs(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("paragraph_no").collect()
    assert [r["text"] for r in got] == ["one more", "two", "three"]


def test_extract_reviews_casts_ids(spark):
    frame = spark.createDataFrame([("P", "V", "8", 1, page(block("12", "t", "b"), block("R9", "t", "b")))], PAGE)
    assert [(r["user_id"], r["review_item"]) for r in X.extract_reviews(frame).orderBy("block_pos").collect()] == [(12, 8), (None, 8)]


@pytest.mark.parametrize("tag,name,value", [('<a href="x">', "href", "x"), ("<a  HREF = 'y z'>", "href", "y z"), ("<a>", "href", ""),
                                            ('<a data-href="q" href="r">', "href", "r"), ('<a title="it\'s">', "title", "it's")])
def test_attributes(spark, tag, name, value):
    assert spark.createDataFrame([(tag,)], "tag string").select(M.attribute(name)).first()[0] == value
