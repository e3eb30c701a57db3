"""HTML pages as a table of nodes, and selectors over it.

``node_table`` reads a page once and gives its elements and text nodes in
document order. Node i is ``(pos = i, tag, attrs, classes, text, parent, end)``:
its descendants are the nodes i + 1 to ``end`` - 1, so a subtree is a slice and
"inside" is a comparison of numbers. ``text`` is null for elements, ``tag`` for
texts; the parent of a top node is -1.

Reading follows the rules that matter for real pages: names without regard to
case, comments and declarations left out, ``script``, ``style``, ``textarea`` and
``title`` as raw text, void elements, quoted ``>`` in attributes, end tags that
close what is open inside, stray end tags ignored, and ``p``, ``li``, ``dt``,
``dd``, ``option`` and table parts closed by what can't stand inside them.

Everything is a JVM expression on one row. The open elements are the state of
an ``aggregate`` over the page's tokens. Appending to an array copies it, so the
tokens are worked on ``PIECE`` at a time and the pieces' results joined once:
the work grows with the page, not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.common import let
from reviewlake.functions.entities import decode_entities, encode_entities  # noqa: F401

PIECE = 64
QUOTED = 100          # quoted values of a tag that may hold ">"; in later ones it ends the tag

# HTML void elements (no closing tag, no content).
VOID_ELEMENTS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
# Elements whose content is text up to their end tag.
RAW_ELEMENTS = ["script", "style", "textarea", "title"]
# Opening tags that end an open element, and what that element must stand inside of.
PARAGRAPH_ENDS = ["address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
                  "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li",
                  "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "dt", "dd"]
SCOPES = ["applet", "button", "caption", "html", "marquee", "object", "table", "td", "template", "th"]
LISTS = ["ol", "ul", "menu"]
# (opening tags, elements they end, elements that shield them)
ENDED_BY = [
    (["li"], ["li"], [*LISTS, *SCOPES]),
    (["dt", "dd"], ["dt", "dd"], ["dl", *SCOPES]),
    (["option"], ["option"], ["select", "optgroup", "datalist"]),
    (["optgroup"], ["optgroup"], ["select"]),
    (["td", "th"], ["td", "th"], ["tr", "table"]),
    (["tr"], ["tr"], ["tbody", "thead", "tfoot", "table"]),
    (["tbody", "thead", "tfoot"], ["tbody", "thead", "tfoot"], ["table"]),
]
# An end tag of any other name doesn't close one of these.
SPECIAL = sorted({*PARAGRAPH_ENDS, *SCOPES, "body", "colgroup", "frameset", "head", "iframe", "noscript", "select", "tbody",
                  "tfoot", "thead", "tr", "svg", "math"} - set(VOID_ELEMENTS))

_NAME = r"[a-zA-Z][^\s/>]*"
_TAG = rf"""</?[a-zA-Z][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+){{0,{QUOTED}}}+[^>]*+>"""
_RAW = "|".join(rf"<{n}(?=[\s/>])[^>]*+>.*?(?=</{n}[\s/>]|\z)" for n in RAW_ELEMENTS)
_TEXT = rf"[^<]++(?:<(?![a-zA-Z/!?])[^<]*+){{0,{QUOTED}}}+"
_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*+(?:>|\z)|{_RAW}|{_TAG}|</[^>]*+>|{_TEXT}|</?[a-zA-Z][^>]*+\z|<"   # the last tag may be cut off
_ATTRIBUTE = r"""(?s)[\s/"']([^\s/>="']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)"""
_TEXT_KIND, _OPEN, _CLOSE, _SINGLE = 0, 1, 2, 3

_STATE = "struct<names:array<string>,nodes:array<int>,n:int,parents:array<int>,ends:array<struct<pos:int,end:int>>>"
_TOKENS = "struct<kind:int,name:string,raw:string>"


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _token(kind: int, name: Column, raw: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), name.alias("name"), raw.alias("raw"))


def _is_letter(c: Column) -> Column:
    return c.between("a", "z") | c.between("A", "Z")


def _tokens(html: Column) -> Column:
    """array<struct<kind, name, raw>> of a page; a raw element is two tokens."""
    none = F.lit(None).cast("string")

    def typed(t: Column) -> Column:
        second, third = F.substring(t, 2, 1), F.substring(t, 3, 1)

        def tag(n: Column) -> Column:
            single = t.endswith("/>") | n.isin(VOID_ELEMENTS)
            return F.when(single, F.array(_token(_SINGLE, n, t))).otherwise(F.array(_token(_OPEN, n, t)))

        def raw(n: Column) -> Column:
            open_ = F.regexp_extract(t, r"(?s)^(<[^>]*+>)", 1)
            text = F.substring(t, F.length(open_) + 1, F.length(t))
            body = F.when(n.isin("script", "style"), text).otherwise(decode_entities(text))
            return F.concat(F.array(_token(_OPEN, n, open_)),
                            F.when(F.length(text) > 0, F.array(_token(_TEXT_KIND, none, body))).otherwise(nothing))

        nothing = F.array().cast(f"array<{_TOKENS}>")
        opening = let(F.lower(F.regexp_extract(t, f"^<({_NAME})", 1)), lambda n: F.when(n.isin(RAW_ELEMENTS), raw(n))
                      .when(t.endswith(">"), tag(n)).otherwise(nothing))
        closing = F.array(_token(_CLOSE, F.lower(F.regexp_extract(t, f"^</({_NAME})", 1)), none))
        return (F.when(~t.startswith("<"), F.array(_token(_TEXT_KIND, none, decode_entities(t))))
                .when(_is_letter(second), opening)
                .when((second == "/") & _is_letter(third), F.when(t.endswith(">"), closing).otherwise(nothing))
                .when(second.isin("/", "!", "?"), nothing)
                .otherwise(F.array(_token(_TEXT_KIND, none, decode_entities(t)))))

    return F.flatten(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), F.lit(0)), typed))


def _first_of(names: Column, wanted: Column, shields: list[str]) -> Column:
    """How many open elements end with the innermost of ``wanted`` (names are
    innermost first), 0 if there is none or a shield stands before it."""
    at = F.array_min(F.filter(F.transform(wanted, lambda w: F.array_position(names, w)), lambda p: p > 0))
    return let(F.coalesce(at, F.lit(0)).cast("int"), lambda r: F.when(
        (r > 1) & F.exists(F.slice(names, 1, F.greatest(r - 1, F.lit(0))), lambda x: x.isin(shields)), 0).otherwise(r))


def _innermost(names: Column, name: Column, shields: list[str]) -> Column:
    """:func:`_first_of` for one name, quick where it is the innermost."""
    def found(r: Column) -> Column:
        return F.when((r > 1) & F.exists(F.slice(names, 1, F.greatest(r - 1, F.lit(0))), lambda x: x.isin(shields)), 0).otherwise(r)
    return F.when(F.get(names, 0) == name, 1).otherwise(let(F.array_position(names, name).cast("int"), found))


def _ending(names: Column, token: Column) -> Column:
    """How many open elements a token ends."""
    name = token["name"]
    # a table part may end with its own table, whatever is open inside
    by_close = (F.when(F.get(names, 0) == name, 1)
                .when(name.isin("table", "td", "th", "tr", "tbody", "thead", "tfoot"), _innermost(names, name, ["table"]))
                .when(name.isin(SPECIAL), _innermost(names, name, ["table", "td", "th", "template"]))
                .otherwise(_innermost(names, name, SPECIAL)))
    by_open = F.lit(0)
    for opening, ended, shields in reversed(ENDED_BY):
        by_open = F.when(name.isin(opening), _first_of(names, _strings(ended), shields)).otherwise(by_open)
    by_open = F.when(name.isin([x for opening, _, _ in ENDED_BY for x in opening]), by_open).otherwise(0)
    paragraph = F.when(name.isin(PARAGRAPH_ENDS) & F.array_contains(names, "p"), _innermost(names, F.lit("p"), SCOPES)).otherwise(0)
    return (F.when(token["kind"] == _TEXT_KIND, 0).when(token["kind"] == _CLOSE, by_close).otherwise(F.greatest(by_open, paragraph)))


def _step(state: Column, token: Column) -> Column:
    def ended(r: Column) -> Column:
        names, nodes, n, kind = state["names"], state["nodes"], state["n"], token["kind"]
        is_node, is_open = kind != _CLOSE, kind == _OPEN
        left = lambda x: F.when(r > 0, F.slice(x, r + 1, F.size(x))).otherwise(x)                     # noqa: E731
        end = lambda p, e: F.struct(p.alias("pos"), e.alias("end"))                                   # noqa: E731
        ends = F.when(r > 0, F.concat(state["ends"], F.transform(F.slice(nodes, 1, r), lambda p: end(p, n)))).otherwise(state["ends"])
        return F.struct(
            F.when(is_open, F.concat(F.array(token["name"]), left(names))).otherwise(left(names)).alias("names"),
            F.when(is_open, F.concat(F.array(n), left(nodes))).otherwise(left(nodes)).alias("nodes"),
            F.when(is_node, n + 1).otherwise(n).alias("n"),
            F.when(is_node, F.array_append(state["parents"], F.coalesce(F.get(nodes, r), F.lit(-1)))).otherwise(state["parents"])
            .alias("parents"),
            F.when(is_node & ~is_open, F.array_append(ends, end(n, n + 1))).otherwise(ends).alias("ends"))

    return let(_ending(state["names"], token), ended)


def _attributes(raw: Column, name: Column) -> Column:
    """array<struct<name, value>> of an opening tag, in order."""
    def parts(a: Column) -> Column:
        at = F.instr(a, "=")
        value = F.when(at > 0, F.trim(F.substring(a, at + 1, F.length(a)))).otherwise("")
        inner = let(value, lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
        return F.struct(F.lower(F.trim(F.when(at > 0, F.substring(a, F.lit(1), at - 1)).otherwise(a))).alias("name"),
                        let(inner, decode_entities).alias("value"))

    rest = F.substring(raw, F.length(name) + 2, F.length(raw))
    return F.when(raw.contains("="), F.transform(F.regexp_extract_all(rest, F.lit(_ATTRIBUTE), F.lit(1)), parts)).otherwise(
        F.array().cast("array<struct<name:string,value:string>>"))


def attribute(node: Column, name: str) -> Column:
    """Value of an attribute of a node, null without it; the first one counts."""
    return F.get(F.filter(node["attrs"], lambda a: a["name"] == name), 0)["value"]


def node_table(html: Column) -> Column:
    """array<struct<pos, tag, attrs, classes, text, parent, end>> of a page, in
    document order. A null page has no nodes."""
    empty = F.array()
    start = F.struct(empty.alias("names"), empty.alias("nodes"), F.lit(0).alias("n"), empty.alias("parents"), empty.alias("ends")).cast(_STATE)
    whole = F.struct(start.alias("state"), empty.alias("parents"), empty.alias("ends")).cast(
        f"struct<state:{_STATE},parents:array<array<int>>,ends:array<array<struct<pos:int,end:int>>>>")

    def table(tokens: Column) -> Column:
        def piece(acc: Column, at: Column) -> Column:
            fresh = F.struct(acc["state"]["names"].alias("names"), acc["state"]["nodes"].alias("nodes"), acc["state"]["n"].alias("n"),
                             empty.alias("parents"), empty.alias("ends")).cast(_STATE)
            done = F.aggregate(F.slice(tokens, at * PIECE + 1, PIECE), fresh, _step)
            return let(done, lambda s: F.struct(s.alias("state"), F.array_append(acc["parents"], s["parents"]).alias("parents"),
                                                F.array_append(acc["ends"], s["ends"]).alias("ends")))

        pieces = F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / PIECE).cast("int"))
        read = F.aggregate(pieces, whole, piece)

        def joined(r: Column) -> Column:
            open_ = F.transform(r["state"]["nodes"], lambda p: F.struct(p.alias("pos"), r["state"]["n"].alias("end")))
            ends = F.array_sort(F.concat(F.flatten(r["ends"]), open_))
            rows = F.arrays_zip(F.filter(tokens, lambda t: t["kind"] != _CLOSE).alias("t"), F.flatten(r["parents"]).alias("parent"),
                                ends.alias("e"))

            def node(x: Column) -> Column:
                t = x["t"]
                attrs = F.when(t["kind"] != _TEXT_KIND, _attributes(t["raw"], t["name"]))
                return let(attrs, lambda a: F.struct(
                    x["e"]["pos"].alias("pos"), t["name"].alias("tag"), a.alias("attrs"),
                    F.array_remove(F.split(F.translate(F.get(F.filter(a, lambda y: y["name"] == "class"), 0)["value"], "\t\n\r\f", "    "), " "), "")
                    .alias("classes"),
                    F.when(t["kind"] == _TEXT_KIND, t["raw"]).alias("text"), x["parent"].alias("parent"), x["e"]["end"].alias("end")))

            return F.transform(rows, node)

        return F.when(F.size(tokens) > 0, let(read, joined)).otherwise(F.array().cast(NODES))

    return let(_tokens(html), table)


NODES = ("array<struct<pos:int,tag:string,attrs:array<struct<name:string,value:string>>,classes:array<string>,text:string,"
         "parent:int,end:int>>")


def _matches(selector: str):
    """Whether a node is an element ``tag.c1.c2`` (no tag: any)."""
    tag, *classes = selector.split(".")

    def test(n: Column) -> Column:
        ok = n["tag"] == tag.lower() if tag else n["tag"].isNotNull()
        for c in dict.fromkeys(classes):
            ok = ok & F.coalesce(F.array_contains(n["classes"], c), F.lit(False))
        return ok
    return test


def candidates(nodes: Column, selectors: list[str]) -> Column:
    """The elements that one of ``selectors`` may match, by one look at each node:
    what each selector is then tested on."""
    classes = sorted({c for s in selectors for c in s.split(".")[1:]})
    bare = sorted({s for s in selectors if "." not in s})

    def test(n: Column) -> Column:
        ok = F.coalesce(F.arrays_overlap(n["classes"], _strings(classes)), F.lit(False)) if classes else F.lit(False)
        return n["tag"].isNotNull() & (ok | n["tag"].isin(bare) if bare else ok)
    return F.filter(nodes, test)


def elements(nodes: Column, selector: str) -> Column:
    """The nodes that ``selector`` matches, in document order."""
    return F.filter(nodes, _matches(selector))


def subtree(nodes: Column, node: Column, with_self: bool = False) -> Column:
    """The nodes inside ``node``; ``nodes`` may itself be a subtree with its root."""
    return let(node["pos"] - F.get(nodes, 0)["pos"], lambda at: F.slice(
        nodes, at + (1 if with_self else 2), node["end"] - node["pos"] - (0 if with_self else 1)))


def _outermost(found: Column) -> Column:
    """Those of the nodes (in document order) that stand in no other of them."""
    def step(acc: Column, n: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        return F.when((F.size(acc) > 0) & (n["pos"] < last["end"]), acc).otherwise(F.array_append(acc, n))
    return F.when(F.size(found) < 2, found).otherwise(F.aggregate(found, F.slice(found, 1, 0), step))


def own_texts(nodes: Column, found: Column) -> Column:
    """``X::text``: the text nodes right inside the ``found`` elements, in document order."""
    def of(e: Column) -> Column:
        inside = F.filter(subtree(nodes, e), lambda t: t["text"].isNotNull() & (t["parent"] == e["pos"]))
        return F.transform(inside, lambda t: F.struct(t["pos"].alias("pos"), t["text"].alias("text")))
    texts = F.flatten(F.transform(found, of))
    return let(texts, lambda x: F.transform(F.when(F.size(found) > 1, F.array_sort(x)).otherwise(x), lambda t: t["text"]))


def inner_texts(nodes: Column, found: Column) -> Column:
    """``X *::text``: the text nodes of elements inside the ``found`` ones, in document order."""
    def of(e: Column) -> Column:
        inside = F.filter(subtree(nodes, e), lambda t: t["text"].isNotNull() & (t["parent"] != e["pos"]))
        return F.transform(inside, lambda t: t["text"])
    return F.flatten(F.transform(_outermost(found), of))


def inner_attributes(nodes: Column, found: Column, name: str) -> Column:
    """``X *::attr(name)``: values in the elements inside the ``found`` ones."""
    def of(e: Column) -> Column:
        return F.filter(F.transform(subtree(nodes, e), lambda n: attribute(n, name)), lambda v: v.isNotNull())
    return F.flatten(F.transform(_outermost(found), of))


def first_attribute(found: Column, name: str) -> Column:
    """``X::attr(name)``, the first of them."""
    return F.get(F.filter(F.transform(found, lambda n: attribute(n, name)), lambda v: v.isNotNull()), 0)


def texts(html: Column, selector: str, descendants: bool = True) -> Column:
    """array<string> of a page: ``selector *::text``, or ``selector::text`` without ``descendants``."""
    of = inner_texts if descendants else own_texts
    return let(node_table(html), lambda nodes: let(elements(nodes, selector), lambda found: of(nodes, found)))


def attr_values(html: Column, selector: str, attr: str) -> Column:
    """array<string> of a page: ``selector::attr(attr)``."""
    found = elements(node_table(html), selector)
    return F.filter(F.transform(found, lambda n: attribute(n, attr)), lambda v: v.isNotNull())
