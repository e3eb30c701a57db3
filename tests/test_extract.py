"""Golden pages: every selector of the review site, the failure pages, the
last page with a disabled next button."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import extract as X
from reviewlake.operators.runlog import run_log

HEADER = """
<div><h1 class="_1mTlpMC3">Villa &amp; Spa</h1><span class="_3ErVArsu">1 Main St</span>
<span class="_28eYYeHH">#1 of 9</span><span class="_3jEYFo-z">120 reviews</span>
<span class="_3cjYfwwQ">4.5</span><div class="_2rdvbNSg">Pool</div><div class="_2rdvbNSg">Spa</div>
<div class="_1krg1t5y"><span class="a"><span class="ui_bubble_rating bubble_50"></span></span><span class="b">Location</span></div>
<div class="_1krg1t5y"><span class="a"><span class="ui_bubble_rating bubble_40"></span></span><span class="b">Cleanliness</span></div>
<div class="_1krg1t5y"><span class="a"><span class="ui_bubble_rating bubble_35"></span></span><span class="b">Service</span></div>
<div class="_1krg1t5y"><span class="a"><span class="ui_bubble_rating bubble_30"></span></span><span class="b">Value</span></div>
<div class="_1krg1t5y"><span class="a"><span class="ui_bubble_rating bubble_10"></span></span><span class="b">Value again</span></div>
<div class="_2dtF3ueh">Languages</div><svg class="_2aZlo29m" title="4.0 of 5 bubbles"></svg>
<div class="_3oYukhTK"><span>Popular mentions</span><span>pool</span><span>view</span></div>
<div class="_2-hMril5 _1bona3Pu _2f_ruteS"><p>Nice place.</p><p>Quiet.</p></div>
<span class="oPMurIUj">98</span><span class="oPMurIUj">12</span><span class="oPMurIUj">7</span></div>
"""
BLOCK_RESP = """<div class="_2wrUUKlw x"><div class="_2fxQ4TOx"><span><a href="/Profile/ann">Ann</a> wrote a review Jan 2020</span></div>
<span class="_1TuWwpYf"><span>Vienna</span></span><span class="ui_bubble_rating bubble_45"></span>
<div class="glasR4aX"><a href="/r1"><span>Great</span></a></div><q class="IRsGHoPm"><span>The pool was great &lt;3</span><span>and the staff too</span></q>
<span class="_2bVY3aT5">Trip type: Traveled with family</span><span class="_3kbymg8R _3kbymg8R">2 Helpful votes</span>
<div class="_204cKjWJ">Response from Jane Doe, General Manager at Villa</div><span class="sT5TMxg3"><span>Thank you</span></span></div>"""
BLOCK_PLAIN = """<div class="_2wrUUKlw"><div class="_2fxQ4TOx"><span><a href="/Profile/bob">Bob</a> wrote a review nonsense</span></div>
<span class="ui_bubble_rating bubble_20"></span><q class="IRsGHoPm"><span>Der Service und das Essen waren nicht gut</span></q></div>"""
NEXT = '<div class="ui_pagination"><a class="ui_button nav next primary" href="/Hotel_Review-g1234-d12345-Reviews-or5-V.html">Next</a></div>'
LAST = '<div class="ui_pagination"><span class="ui_button nav next primary disabled">Next</span></div>'
URL1 = "https://www.tripadvisor.ca/Hotel_Review-g1234-d12345-Reviews-V.html"
URL2 = "https://www.tripadvisor.ca/Hotel_Review-g1234-d12345-Reviews-or5-V.html"


def _pages(spark):
    rows = [(1, 1, URL1, f"<html><body>{HEADER}{BLOCK_RESP}{BLOCK_PLAIN}{NEXT}</body></html>"),
            (1, 2, URL2, f"<html><body>{HEADER}{BLOCK_PLAIN}{LAST}</body></html>"),
            (2, 1, "https://x/Hotel_Review-g5555-d55555-Reviews-F.html", "Emergency"),
            (3, 1, "https://x/Hotel_Review-g6666-d66666-Reviews-B.html", "<p>you are banned</p>")]
    return spark.createDataFrame(rows, "doc_id long, page_no int, url string, html string")


def test_page_gate(spark):
    got = [r.s for r in _pages(spark).select(X.page_gate("html").alias("s")).orderBy("doc_id").collect()]
    assert got == ["ok", "ok", "fetch_failed", "banned"]


def test_extract_hotels(spark):
    h = X.extract_hotels(_pages(spark).where("doc_id = 1 and page_no = 1")).collect()[0]
    assert h.id_hotel == "g1234-d12345" and h.name_hotel == "Villa & Spa"
    assert (h.address_hotel, h.ranking_hotel, h.number_of_reviews, h.total_rating) == (
        "1 Main St", "#1 of 9", "120 reviews", "4.5")
    assert h.amenities == ["Pool", "Spa"] and h.good_to_know == ["Languages"]
    # "Value again" is the fifth text: no class position, ignored
    assert (h.location_rating, h.cleanliness_rating, h.service_rating, h.value_rating) == (
        "5.0", "4.0", "3.5", "3.0")
    assert h.class_rating == "4.0" and h.popular_mention_tags == ["pool", "view"]
    assert h.description == "Nice place.\nQuiet."
    assert (h.location_grade, h.surrounding_restaurants, h.surrounding_attractions) == ("98", "12", "7")


def test_extract_hotels_missing_fields(spark):
    df = spark.createDataFrame([(URL1, "<html><body><h1 class='other'>x</h1></body></html>")],
                               "url string, html string")
    h = X.extract_hotels(df).collect()[0]
    assert h.name_hotel is None and h.amenities == [] and h.description is None
    assert h.location_rating is None and h.location_grade is None and h.popular_mention_tags == []


def test_extract_reviews(spark):
    r = X.extract_reviews(_pages(spark).where("doc_id = 1 and page_no = 1")).orderBy("block_pos").collect()
    assert len(r) == 2
    a, b = r
    assert (a.id_user, a.name_user, a.review_date, a.review_rating) == ("ann", "Ann", "01-2020", "4.5")
    assert a.review_text == "The pool was great <3\nand the staff too" and a.review_language == "en"
    assert (a.trip_type, a.helpful_votes, a.reviewer_location, a.review_title) == (
        "Trip type: Traveled with family", "2 Helpful votes", "Vienna", "Great")
    assert (a.review_response, a.responder, a.responder_title) == ("Thank you", "Jane Doe", " General Manager")
    # the last block stops at the pagination element; no response -> NULLs
    assert (b.id_user, b.review_date, b.review_rating, b.review_language) == ("bob", "00-0000", "2.0", "de")
    assert b.review_response is None and b.responder is None and b.trip_type is None


def test_review_without_user_link_is_rejected(spark):
    from reviewlake.operators.documents import rejected_reviews
    block = BLOCK_PLAIN.replace('<a href="/Profile/bob">Bob</a>', "<b>Bob</b>")
    df = spark.createDataFrame([(1, 1, URL1, f"<html>{block}{LAST}</html>")],
                               "doc_id long, page_no int, url string, html string")
    r = X.extract_reviews(df)
    assert r.count() == 1 and r.collect()[0].id_user is None
    assert [x.reason for x in rejected_reviews(r).collect()] == ["no user link"]


def test_block_ends_at_its_closing_tag(spark):
    ad = '<div class="ad"><span class="_2bVY3aT5">Sponsored</span><a href="/Profile/spam">x</a></div>'
    html = f"<html><body>{BLOCK_PLAIN}{ad}{BLOCK_PLAIN.replace('bob', 'cat')}{LAST}</body></html>"
    df = spark.createDataFrame([(1, 1, URL1, html)], "doc_id long, page_no int, url string, html string")
    r = X.extract_reviews(df).orderBy("block_pos").collect()
    assert [x.id_user for x in r] == ["bob", "cat"]
    assert all(x.trip_type is None for x in r)      # the ad's span is outside every block


def test_nested_same_tag_elements(spark):
    html = ('<div class="_2f_ruteS _1bona3Pu _2-hMril5"><div class="a">Para one</div>'
            '<div class="b"><br>Para <b>two</b></div><!-- c --></div><div class="_2rdvbNSg">Pool</div>'
            '<span class="_1TuWwpYf">own <span>City</span> tail</span>')
    df = spark.createDataFrame([(URL1, html)], "url string, html string")
    h = X.extract_hotels(df).collect()[0]
    assert h.description == "Para one\nPara \ntwo"
    assert h.amenities == ["Pool"]
    from reviewlake.functions import html as H
    r = df.select(H.texts(F.col("html"), "span._1TuWwpYf", descendants=False).alias("own"),
                  H.texts(F.col("html"), "span._1TuWwpYf", descendants=True).alias("desc")).collect()[0]
    assert r.own == ["own ", " tail"] and r.desc == ["City"]


def test_extract_links(spark):
    got = {(r.doc_id, r.page_no): (r.next_disabled, r.next_url)
           for r in X.extract_links(_pages(spark)).collect()}
    assert got[(1, 1)] == (False, URL2)
    assert got[(1, 2)] == (True, None)
    assert got[(2, 1)] == (False, None)


def test_run_log_keeps_reviews_before_failure(spark):
    pages = _pages(spark).withColumn("status", X.page_gate("html"))
    # hotel 1: pages 1, 2 ok; hotel 2 fails on page 1; add a failing page 3 to hotel 1
    extra = spark.createDataFrame([(1, 3, URL2 + "?p=3", "Emergency", "fetch_failed")],
                                  "doc_id long, page_no int, url string, html string, status string")
    pages = pages.unionByName(extra)
    blocks = X.review_blocks(pages.where("status = 'ok'")).select("doc_id", "page_no")
    got = {r.hotel_id: r for r in run_log(pages.drop("html"), blocks).collect()}
    h1 = got["g1234-d12345"]
    assert (h1.status, h1.n_reviews, h1.reason) == ("Empty", 3, "Readmore Element not Found")
    h2 = got["g5555-d55555"]
    assert (h2.status, h2.n_reviews) == ("Empty", 0)
    assert got["g6666-d66666"].reason == "banned"


def test_attributes_by_exact_name_and_either_quote(spark):
    from reviewlake.functions import html as H
    cases = [('<a class="n" href="/x" data-href="/y">', "/x"), ('<a data-href="/y" class="n" href="/x">', "/x"),
             ("<a class='n' href='/x'>", "/x"), ("<a class=n href=/x>", "/x"), ('<a-x class="n" href="/y"></a-x>', None),
             ('<a data-class="n" href="/y">', None), ('<a class="m n o" href="/a&amp;b">', "/a&b"), ('<a class="nn" href="/y">', None)]
    rows = spark.createDataFrame(cases, "h string, want string")
    got = rows.select("h", "want", F.get(H.attr_values(F.col("h"), "a.n", "href"), 0).alias("got")).collect()
    assert [(r.h, r.got) for r in got] == [(r.h, r.want) for r in got]


def test_character_references(spark):
    import html as std

    from reviewlake.functions import html as H
    texts = ["a &hellip; b", "caf&eacute;", "&#8217;&#x2019;&#X1F642;", "&amp;lt; &lt;", "R&D &unknown; &", "&nbsp;x", "&apos;&quot;",
             "&#0;&#xD800;&#x110000;", "plain", "&Uuml;ber &euro;5 &mdash; &ldquo;x&rdquo;"]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(H.decode_entities(F.col("t")).alias("t")).collect()]
    want = [std.unescape(t) if "&unknown" not in t else t for t in texts]
    assert got == want
