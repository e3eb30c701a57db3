"""Node tables of pages: against ElementTree on well-formed pages, and the rules for real ones."""

from __future__ import annotations

import random
import time
import xml.etree.ElementTree as ET
from html import escape

from pyspark.sql import functions as F

from reviewlake.functions import html as H
from reviewlake.operators import extract as X


def _nodes(spark, pages):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return {r.i: [(n.pos, n.tag, n.classes, n.text, n.parent, n.end) for n in r.n]
            for r in rows.select("i", H.node_table(F.col("html")).alias("n")).collect()}


def _walked(page):
    """The same table by ElementTree."""
    out = []

    def text(t, parent):
        if t:
            out.append((len(out), None, None, t, parent, len(out) + 1))

    def element(e, parent):
        at = len(out)
        out.append(None)
        text(e.text, at)
        for child in e:
            element(child, at)
            text(child.tail, at)
        out[at] = (at, e.tag, e.get("class").split() if e.get("class") else None, None, parent, len(out))
    element(ET.fromstring(page), -1)
    return out


def _random_page(rng, size):
    tags = ["div", "span", "section", "b", "em", "article"]

    def one(depth):
        tag = rng.choice(tags)
        cls = rng.choice(["", ' class="a"', ' class="a b"', " class='b c'", ' id="x" class="c" title="&lt;p&gt; class=z"'])
        inner = []
        for _ in range(rng.randint(0, 4) if depth < 6 else 0):
            inner.append(one(depth + 1) if rng.random() < .6 else escape(rng.choice(["text", "a & b", "x < y", "é 日本", " "])) + rng.choice(["!", ""]))
        merged = "".join(inner)
        return f"<{tag}{cls}>{merged}</{tag}>"
    return "<html>" + "".join(one(0) for _ in range(size)) + "</html>"


def test_well_formed_pages_as_element_tree_reads_them(spark):
    rng = random.Random(2)
    pages = [_random_page(rng, k % 12 + 1) for k in range(60)]
    got = _nodes(spark, pages)
    for i, page in enumerate(pages):
        assert got[i] == _walked(page), page


def _texts(spark, page, selector, descendants=False):
    return spark.createDataFrame([(page,)], "h string").select(H.texts(F.col("h"), selector, descendants).alias("t")).first().t


def test_real_pages(spark):
    own = {
        "upper": ("<DIV CLASS='x'>A</DIV>", ["A"]), "mixed": ("<Div ID=1 Class=x>A</dIV>", ["A"]),
        "comment": ("<!-- <div class='x'>no</div> --><div class='x'>A<!-- b -->C</div>", ["A", "C"]),
        "script": ("<script>var a = \"<div class='x'>no</div>\";</script><div class=x>A</div>", ["A"]),
        "style": ("<STYLE>div.x > b {}</STYLE><div class=x>A</div>", ["A"]),
        "quoted": ("<div title='a > b' class='x'>A</div>", ["A"]), "in-title": ('<div title="class=x">no</div><div class="x">A</div>', ["A"]),
        "unclosed-p": ("<div class=x><p>one<p>two</div><div>no</div>", []), "void": ("<div class=x>a<br>b<img src=x>c</div>d", ["a", "b", "c"]),
        "stray": ("<div class=x>a</span></b>b</div></div>no", ["a", "b"]), "unclosed-span": ("<div class=x><span>in</div>out<div class=x>A</div>", ["A"]),
        "open-comment": ("<div class=x>A<!-- never closed </div><div class=x>no</div>", ["A"]), "lone": ("<div class=x>1 < 2 && 3 <</div>", ["1 < 2 && 3 <"]),
        "cut": ("<div class=x>A<div", ["A"]), "two-classes": ("<div class='  w   x\ty '>A</div>", ["A"]), "self": ("<div class=x/>no", []),
        "doctype": ("<!DOCTYPE html><?xml x?><div class=x>A</div>", ["A"]), "entity": ("<div class=x>&lt;b&gt; &amp;amp;</div>", ["<b> &amp;"]),
        "bad-end": ("<div class=x>A</></ div>B</div>", ["A", "B"]), "none": ("", []), "text": ("only text", []),
    }
    for name, (page, want) in own.items():
        assert _texts(spark, page, "div.x") == want, name
    lists = "<ul><li class=a>one<li class=a>two<ul><li class=a>in</ul><li class=a>three</ul>after"
    assert _texts(spark, lists, "li.a") == ["one", "two", "in", "three"]
    assert _texts(spark, "<p class=a>one<p class=a>two<div>out</div>", "p.a") == ["one", "two"]
    table = "<table><tr><td class=a>1<td class=a>2<tr><td class=a>3</table><p class=a>4"
    assert _texts(spark, table, "td.a") == ["1", "2", "3"] and _texts(spark, table, "p.a") == ["4"]
    nested = "<div class=x>a<div class=x>b<i>c</i></div>d<i>e</i></div>"
    assert _texts(spark, nested, "div.x") == ["a", "b", "d"] and _texts(spark, nested, "div.x", True) == ["b", "c", "e"]
    assert spark.createDataFrame([(None,)], "h string").select(H.node_table(F.col("h")).alias("n")).first().n == []


def test_reviews_in_comments_and_scripts_are_none(spark):
    block = '<div class="_2wrUUKlw"><a href="/Profile/{}">x</a><q class="IRsGHoPm"><span>The room was clean</span></q></div>'
    page = f"<html><!-- {block.format('old')} --><script>{block.format('js')}</script><DIV>{block.format('ann').upper().replace('_2WRUUKLW', '_2wrUUKlw')}</DIV></html>"
    rows = spark.createDataFrame([(1, page)], "doc_id int, html string")
    assert [r.id_user for r in X.extract_reviews(rows).collect()] == ["/PROFILE/ANN"]
    assert rows.select(X.count_blocks("html")).first()[0] == 1


def test_time_grows_with_the_page(spark):
    def timed(n):
        page = "<div class='x'><span>a</span><b>c</b></div>" * (n // 5)
        rows = spark.createDataFrame([(page,)], "h string")
        start = time.time()
        assert rows.select(F.size(H.node_table(F.col("h")))).first()[0] == n
        return time.time() - start
    timed(2000)
    small, large = min(timed(2000) for _ in range(2)), timed(40_000)
    assert large < 20 * small + 10, (small, large)


def test_deep_and_crowded_tags(spark):
    deep = "<b>" * 3000 + "x" + "</b>" * 3000
    many = "<div " + " ".join(f'a{k}="v{k}"' for k in range(3000)) + " class='x'>A</div>"
    got = _nodes(spark, [deep, many, "<" * 20_000, "<a " * 5000, "&" * 20_000, '<div class="' + "x " * 20_000 + '">A</div>'])
    assert len(got[0]) == 3001 and got[0][2999][4:] == (2998, 3001)
    assert got[1][1][3] == "A"
