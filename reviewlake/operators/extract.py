"""Pages: gate (F4), hotel record (X1), review blocks (X2), sub-ratings (X3),
pagination links (X4).

Selectors are data (``HOTEL_SELECTORS``, ``REVIEW_SELECTORS``): a class change
on the site is a table edit. A page is read once into its node table
(``functions.html``); one look at the nodes finds the candidates of all
selectors, and each field is an expression on these. A page never leaves its
task and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import schemas as S
from reviewlake.functions import expr as E
from reviewlake.functions import html as H
from reviewlake.functions.common import let
from reviewlake.functions.language import language_tag

# Failure marks of a fetched page.
FAILED_BODY = "Emergency"
BANNED_MARK = "banned"

# CSS selectors of the review pages. (field, selector, mode)
# mode: "own_first" / "own_all" = the element's own text (``X::text``),
# "desc_first" / "desc_all" = its descendants' text (``X *::text``),
# "attr:<name>" = attribute of the first match.
HOTEL_SELECTORS = [
    ("grades", "span.oPMurIUj", "own_all"),
    ("name_hotel", "h1._1mTlpMC3", "own_first"),
    ("address_hotel", "span._3ErVArsu", "own_first"),
    ("ranking_hotel", "span._28eYYeHH", "own_first"),
    ("number_of_reviews", "span._3jEYFo-z", "own_first"),
    ("amenities", "div._2rdvbNSg", "own_all"),
    ("total_rating", "span._3cjYfwwQ", "own_first"),
    ("good_to_know", "div._2dtF3ueh", "own_all"),
    ("class_title", "svg._2aZlo29m", "attr:title"),
    ("mentions", "div._3oYukhTK", "desc_all"),
    ("description", "div._2f_ruteS._1bona3Pu._2-hMril5", "desc_all"),
]
SUBRATING_SELECTOR = "div._1krg1t5y"
SUBRATING_CATEGORIES = ["location", "cleanliness", "service", "value"]
SUBRATING_CLASS_POS = [1, 4, 7, 10]   # class position for the i-th sub-rating text
REVIEW_BLOCK = "div._2wrUUKlw"
REVIEW_SELECTORS = [
    ("responder_raw", "div._204cKjWJ", "own_first"),
    ("bubble_class", "span.ui_bubble_rating", "attr:class"),
    ("user_href", "a", "attr:href"),
    ("header", "div._2fxQ4TOx", "desc_all"),
    ("stay", "span._34Xs-BQm", "desc_all"),
    ("trip_type", "span._2bVY3aT5", "own_first"),
    ("helpful_votes", "span._3kbymg8R._3kbymg8R", "own_first"),
    ("reviewer_location", "span._1TuWwpYf", "desc_first"),
    ("review_title", "div.glasR4aX", "desc_first"),
    ("text_fragments", "q.IRsGHoPm", "desc_all"),
    ("response_fragments", "span.sT5TMxg3", "desc_all"),
]
NEXT_LINK = "a.ui_button.nav.next.primary"
NEXT_DISABLED = "span.ui_button.nav.next.primary.disabled"


def _select(nodes: Column, found: Column, selector: str, mode: str) -> Column:
    """One field; ``found`` are the candidates among ``nodes``."""
    def of(matches: Column) -> Column:
        if mode.startswith("attr:"):
            return H.first_attribute(matches, mode[5:])
        kind, _, which = mode.partition("_")
        texts = H.own_texts(nodes, matches) if kind == "own" else H.inner_texts(nodes, matches)
        return F.get(texts, 0) if which == "first" else texts
    return let(H.elements(found, selector), of)


def _fields(nodes: Column, selectors: list[tuple[str, str, str]], *more: tuple[str, str]) -> Column:
    """Struct of the fields of ``selectors``; ``more`` are (name, selector) of elements that are kept as they are."""
    wanted = [s for _, s, _ in selectors] + [s for _, s in more]
    return let(H.candidates(nodes, wanted), lambda found: F.struct(
        *[_select(nodes, found, s, mode).alias(f) for f, s, mode in selectors],
        *[H.elements(found, s).alias(f) for f, s in more]))


def page_gate(html: Column | str) -> Column:
    """``fetch_failed`` for the failure body, ``banned`` when the body
    contains the ban mark, else ``ok``."""
    h = F.col(html) if isinstance(html, str) else html
    return (F.when(h == FAILED_BODY, F.lit("fetch_failed"))
            .when(h.contains(BANNED_MARK), F.lit("banned"))
            .otherwise(F.lit("ok")))


def _names(texts: Column, cat: str):
    def test(i: Column) -> Column:
        return F.lower(F.get(texts, i)).contains(cat)
    return test


def subratings(html: Column) -> Column:
    """X3 of a page. Select the struct once and expand it (``s.*``)."""
    return let(H.node_table(html), lambda nodes: subratings_of(nodes, H.elements(nodes, SUBRATING_SELECTOR)))


def subratings_of(nodes: Column, found: Column) -> Column:
    """Struct of one rating per category. For the i-th sub-rating text
    naming a category, the class at ``SUBRATING_CLASS_POS[i]``; a later text
    wins; a text past the fourth has no position and is ignored (SURVEY D9)."""
    pos = F.array(*[F.lit(p) for p in SUBRATING_CLASS_POS])
    n = len(SUBRATING_CLASS_POS)

    def pick(ct: Column) -> Column:
        cls, txt = ct["classes"], ct["texts"]
        idx = F.when(F.size(txt) > 0, F.sequence(F.lit(0), F.least(F.size(txt), F.lit(n)) - 1))
        return F.struct(*[
            E.bubble_rating(F.get(cls, F.get(pos, F.array_max(F.filter(idx, _names(txt, cat))))))
            .alias(f"{cat}_rating")
            for cat in SUBRATING_CATEGORIES])

    return let(F.struct(H.inner_attributes(nodes, found, "class").alias("classes"), H.inner_texts(nodes, found).alias("texts")), pick)


def with_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the node table ``_nodes`` of each page instead of its HTML."""
    return pages.select(*[c for c in pages.columns if c != html], H.node_table(F.col(html)).alias("_nodes"))


def _hotel(nodes: Column) -> Column:
    """Raw struct of the hotel's fields, its sub-ratings included."""
    raw = _fields(nodes, HOTEL_SELECTORS, ("subratings", SUBRATING_SELECTOR))
    return let(raw, lambda r: F.struct(*[r[f].alias(f) for f, _, _ in HOTEL_SELECTORS],
                                       subratings_of(nodes, r["subratings"]).alias("sub")))


def _hotel_columns(raw: str, url: Column) -> list[Column]:
    f = lambda name: F.col(f"{raw}.{name}")                                   # noqa: E731
    as_is = ("name_hotel", "address_hotel", "ranking_hotel", "number_of_reviews", "amenities", "total_rating")
    return [E.hotel_id(url).alias("id_hotel"), *[f(c).alias(c) for c in as_is],
            *[f(f"sub.{c}_rating").alias(f"{c}_rating") for c in SUBRATING_CATEGORIES],
            f("good_to_know").alias("good_to_know"),
            E.class_rating(f"{raw}.class_title").alias("class_rating"),
            E.all_but_first(f"{raw}.mentions").alias("popular_mention_tags"),
            E.join_fragments(f"{raw}.description", empty_as_null=True).alias("description"),
            E.nth(f"{raw}.grades", 0).alias("location_grade"),
            E.nth(f"{raw}.grades", 1).alias("surrounding_restaurants"),
            E.nth(f"{raw}.grades", 2).alias("surrounding_attractions")]


def extract_hotels(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One HOTEL record per page (the caller keeps the first page, A3)."""
    kept = [c for c in pages.columns if c != html]
    raw = with_nodes(pages, html).select(*kept, _hotel(F.col("_nodes")).alias("_hotel"))
    return raw.select(*kept, *_hotel_columns("_hotel", F.col(url)))


def count_blocks(html: Column | str) -> Column:
    """Number of review blocks on a page (no explode)."""
    h = F.col(html) if isinstance(html, str) else html
    return F.size(H.elements(H.node_table(h), REVIEW_BLOCK))


def review_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """X2 split: one row per review block (``block_pos`` 0-based in the page) with
    the block's own node table, so nothing between the blocks is read with them."""
    kept = [c for c in pages.columns if c != html]
    nodes = F.col("_nodes")
    blocks = F.transform(H.elements(nodes, REVIEW_BLOCK), lambda b: H.subtree(nodes, b, with_self=True))
    return with_nodes(pages, html).select(*kept, F.posexplode(blocks).alias("block_pos", "block"))


def raw_reviews(nodes: Column) -> Column:
    """array<struct>: the raw fields of each review block of a page."""
    return F.transform(H.elements(nodes, REVIEW_BLOCK),
                       lambda b: let(H.subtree(nodes, b, with_self=True), lambda own: _fields(own, REVIEW_SELECTORS)))


def _review_columns(raw: str, as_of: Column | None, fallback_stay_date: bool) -> list[Column]:
    f = lambda name: F.col(f"{raw}.{name}")                                   # noqa: E731
    name, title = E.responder(f"{raw}.responder_raw")
    text = E.join_fragments(f"{raw}.text_fragments", empty_as_null=False)
    as_is = ("trip_type", "helpful_votes", "reviewer_location", "review_title")
    return [E.user_id(f"{raw}.user_href").alias("id_user"), E.nth(f"{raw}.header", 0).alias("name_user"),
            E.review_month(f"{raw}.header", f"{raw}.stay", as_of, fallback_stay_date).alias("review_date"),
            E.bubble_rating(f"{raw}.bubble_class").alias("review_rating"),
            language_tag(text).alias("review_language"), *[f(c).alias(c) for c in as_is], text.alias("review_text"),
            E.empty_to_null(E.join_fragments(f"{raw}.response_fragments", empty_as_null=False)).alias("review_response"),
            name.alias("responder"), title.alias("responder_title")]


def reviews_of(raw: DataFrame, reviews: str = "reviews", as_of: Column | None = None, fallback_stay_date: bool = False) -> DataFrame:
    """One REVIEW record per element of the array ``reviews`` (``raw_reviews``), with
    its ``block_pos`` and the language tag of its text (X5)."""
    kept = [c for c in raw.columns if c != reviews]
    return raw.select(*kept, F.posexplode(reviews).alias("block_pos", "_review")).select(
        *kept, "block_pos", *_review_columns("_review", as_of, fallback_stay_date))


def extract_reviews(pages: DataFrame, html: str = "html", as_of: Column | None = None,
                    fallback_stay_date: bool = False) -> DataFrame:
    """One REVIEW record per block."""
    kept = [c for c in pages.columns if c != html]
    raw = with_nodes(pages, html).select(*kept, raw_reviews(F.col("_nodes")).alias("_reviews"))
    return reviews_of(raw, "_reviews", as_of, fallback_stay_date)


def _links(nodes: Column) -> Column:
    found = _fields(nodes, [("next_href", NEXT_LINK, "attr:href")], ("off", NEXT_DISABLED))
    return let(found, lambda r: F.struct(r["next_href"].alias("next_href"), (F.size(r["off"]) > 0).alias("next_disabled")))


def _next_url(links: str) -> Column:
    return F.when(~F.col(f"{links}.next_disabled"), E.next_page_url(F.col(f"{links}.next_href")))


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Next href, disabled flag and the absolute next URL (NULL at the end)."""
    kept = [c for c in pages.columns if c != html]
    raw = with_nodes(pages, html).select(*kept, _links(F.col("_nodes")).alias("_links"))
    return raw.select(*kept, "_links.next_href", "_links.next_disabled", _next_url("_links").alias("next_url"))


def page_facts(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``(url, status, n_reviews, next_url, hotel, reviews)`` per page, from one
    reading of it. ``hotel`` is the HOTEL record, ``reviews`` the raw reviews; a
    failed or banned page has neither record, reviews nor link. Row-local."""
    status = page_gate(html)
    read = pages.select(F.col(url).alias("url"), status.alias("status"),
                        F.when(status == "ok", H.node_table(F.col(html))).alias("_nodes"))
    nodes, ok = F.col("_nodes"), F.col("status") == "ok"
    raw = read.select("url", "status", F.when(ok, _hotel(nodes)).alias("_hotel"), F.when(ok, _links(nodes)).alias("_links"),
                      F.when(ok, raw_reviews(nodes)).alias("reviews"))
    flat = raw.select("url", "status", "reviews", _next_url("_links").alias("next_url"), *_hotel_columns("_hotel", F.col("url")))
    return flat.select("url", "status", F.when(ok, F.size("reviews")).otherwise(0).alias("n_reviews"), "next_url",
                       F.when(ok, F.struct(*S.HOTEL_FIELDS)).alias("hotel"), "reviews")
