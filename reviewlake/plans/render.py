"""Review pages in the site's markup, rendered by Spark from the fixture views.

The driver's ``pages`` are generic web pages without the review site's
classes, so the extraction operators are checked on pages rendered here from
``fx_reviews`` (reviews, page numbers) and the conversation ids (hotel
fields). Every field follows a rule of the document id or review position,
stated once here and once as SQL in the oracles (``PAGE_URL_SQL``,
``PAGE_STATUS_SQL`` and the registry's page views). Extraction must give
back exactly what was rendered.

Pages that fail (``Emergency`` body) or are banned are mixed in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.entities import encode_entities
from reviewlake.plans import fixtures as FX
from reviewlake.session import table

SITE = "https://www.tripadvisor.ca"
BANNED_BODY = "<html><body>You have been banned</body></html>"
SUBRATING_NAMES = ["Location", "Cleanliness", "Service", "Value"]


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def page_path(doc: Column, page_no: Column) -> Column:
    """``/Hotel_Review-g…-d…-Reviews[-or<5(p-1)>]-Hotel_<doc>-City.html``."""
    offset = F.when(page_no > 1, F.concat(F.lit("-or"), _s((page_no - 1) * 5))).otherwise(F.lit(""))
    return F.concat(F.lit("/Hotel_Review-g"), _s(F.lit(100000) + doc), F.lit("-d"),
                    _s(F.lit(1000000) + doc), F.lit("-Reviews"), offset, F.lit("-Hotel_"), _s(doc),
                    F.lit("-City.html"))


def failed(doc: Column, page_no: Column) -> Column:
    return ((doc % 17 == 3) & (page_no == 2)) | ((doc % 13 == 6) & (page_no == 3))


def banned(doc: Column, page_no: Column) -> Column:
    return (doc % 19 == 4) & (page_no == 1)


def _review_block(r: DataFrame) -> Column:
    doc, pos = F.col("doc_id"), F.col("pos")
    month = F.date_format(F.to_date(F.concat(F.lit("2020-"), F.substring("review_date", 1, 2), F.lit("-01"))),
                          "MMM")
    when_text = F.when(F.col("review_date") == "00-0000", F.lit("recently")).otherwise(
        F.concat(month, F.lit(" "), F.substring("review_date", 4, 4)))
    has_resp = F.coalesce(F.length("review_response"), F.lit(0)) > 0
    responder = (F.when(doc % 3 == 0, F.concat(F.lit("Response from Owner "), _s(doc),
                                               F.lit(", General Manager at Hotel "), _s(doc)))
                 .when(doc % 3 == 1, F.lit("Response from Front desk"))
                 .otherwise(F.lit("Response from A, B, C")))
    trip = (F.when(pos % 3 == 0, F.lit("Trip type: Traveled as a couple"))
            .when(pos % 3 == 1, F.lit("Trip type: Traveled solo")))
    votes = F.when(pos % 4 == 1, F.concat(_s(pos % 7 + 1), F.lit(" Helpful votes")))
    user = encode_entities(F.col("id_user"))
    return F.concat(
        F.lit('<div class="_2wrUUKlw _1_tiDhna" data-reviewid="'), _s(pos), F.lit('">'),
        F.lit('<div class="_2fxQ4TOx"><span><a class="ui_header_link _1r_My98y" href="/Profile/'), user,
        F.lit('">'), user, F.lit("</a> wrote a review "), when_text, F.lit("</span></div>"),
        F.lit('<div class="_1EpRX7o3"><span class="_1TuWwpYf"><span>City '), _s(doc % 9),
        F.lit("</span></span></div>"),
        F.lit('<span class="ui_bubble_rating bubble_'), _s(pos % 5 + 1), F.lit('0"></span>'),
        F.lit('<div class="glasR4aX"><a href="/ShowUserReviews-'), _s(pos), F.lit('"><span>Stay &eacute;&#x2019;&#8230;&hellip;&amp;lt; '), _s(pos),
        F.lit("</span></a></div>"),
        F.lit('<q class="IRsGHoPm"><span>'), encode_entities(F.col("review_text")), F.lit("</span></q>"),
        F.coalesce(F.concat(F.lit('<span class="_2bVY3aT5">'), trip, F.lit("</span>")), F.lit("")),
        F.coalesce(F.concat(F.lit('<span class="_3kbymg8R _3kbymg8R">'), votes, F.lit("</span>")), F.lit("")),
        F.when(has_resp, F.concat(
            F.lit('<div class="_204cKjWJ">'), responder, F.lit("</div>"),
            F.lit('<span class="sT5TMxg3"><span>'), encode_entities(F.col("review_response")),
            F.lit("</span></span>"))).otherwise(F.lit("")),
        F.lit("</div>"))


def _subratings(doc: Column) -> Column:
    rot = doc % 4
    names = F.array(*[F.lit(n) for n in SUBRATING_NAMES])
    parts = []
    for j in range(4):
        name = F.get(names, ((F.lit(j) + rot) % 4).cast("int"))
        parts += [F.lit('<div class="_1krg1t5y"><span class="_3ZEZK00A"><span class="ui_bubble_rating bubble_'),
                  _s((doc + j) % 5 + 1), F.lit('0"></span></span><span class="_1cG5q8WJ">'), name,
                  F.lit("</span></div>")]
    extra = F.when(doc % 6 == 5, F.lit(
        '<div class="_1krg1t5y"><span class="_3ZEZK00A"><span class="ui_bubble_rating bubble_50"></span>'
        '</span><span class="_1cG5q8WJ">Value for money</span></div>')).otherwise(F.lit(""))
    return F.when(doc % 8 == 7, F.lit("")).otherwise(F.concat(*parts, extra))


def _hotel_header(doc: Column) -> Column:
    amen = (F.when(doc % 3 == 0, F.lit('<div class="_2rdvbNSg">Free WiFi</div><div class="_2rdvbNSg">Pool</div>'))
            .when(doc % 3 == 1, F.lit('<div class="_2rdvbNSg">Parking</div>')).otherwise(F.lit("")))
    gtk = F.when(doc % 2 == 0, F.lit('<div class="_2dtF3ueh">Languages Spoken</div>'
                                     '<div class="_2dtF3ueh">English</div>')).otherwise(F.lit(""))
    cls = F.when(doc % 7 == 6, F.lit("")).otherwise(F.concat(
        F.lit('<svg class="_2aZlo29m" title="'), _s(doc % 5 + 1), F.lit('.0 of 5 bubbles"></svg>')))
    mentions = F.concat(F.lit('<div class="_3oYukhTK"><span>Popular mentions</span>'),
                        F.when(doc % 2 == 0, F.lit("<span>breakfast</span><span>staff</span>"))
                        .otherwise(F.lit("")), F.lit("</div>"))
    desc = F.when(doc % 4 == 3, F.lit("")).otherwise(F.concat(
        F.lit('<div class="_2f_ruteS _1bona3Pu _2-hMril5"><div class="cPQsENeY"><p>Line one of '), _s(doc),
        F.lit("</p><p>Line two</p></div></div>")))
    grades = F.when(doc % 5 == 4, F.lit("")).otherwise(F.concat(
        F.lit('<span class="oPMurIUj">'), _s(doc % 100), F.lit('</span><span class="oPMurIUj">'),
        _s(doc % 30), F.lit('</span><span class="oPMurIUj">'), _s(doc % 20), F.lit("</span>")))
    return F.concat(
        F.lit('<div class="hotel_header"><h1 class="_1mTlpMC3">Hotel '), _s(doc), F.lit("</h1>"),
        F.lit('<span class="_3ErVArsu">'), _s(doc), F.lit(" Main Street</span>"),
        F.lit('<span class="_28eYYeHH">#'), _s(doc % 50 + 1), F.lit(" of 50 hotels</span>"),
        F.lit('<span class="_3jEYFo-z">'), _s(doc * 3 % 1000), F.lit(" reviews</span>"),
        F.lit('<span class="_3cjYfwwQ">'), _s(doc % 5), F.lit(".5</span>"),
        amen, _subratings(doc), gtk, cls, mentions, desc, grades, F.lit("</div>"))


def render_hotel_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, page_no, url, html)``: every page 1..n of every hotel.

    Blocks are gathered per page (a page holds a handful of reviews, a bounded
    group); the last page count per hotel comes from a partial aggregate."""
    r = FX.fx_reviews(spark, sf_dir)
    blocks = (r.select("doc_id", "page_no", F.struct("pos", _review_block(r).alias("b")).alias("e"))
              .groupBy("doc_id", "page_no")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["b"]), "")
                   .alias("blocks")))
    # last page per hotel straight from the user turns (the rows of fx_reviews),
    # so the windowed fixture is computed once
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    n_pages = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(
        F.max(F.floor(F.col("turn") / 2).cast("int") + 1).alias("n_pages"))
    pages = n_pages.select("doc_id", "n_pages", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page_no"))
    pages = pages.join(blocks, ["doc_id", "page_no"], "left")
    doc, p = F.col("doc_id"), F.col("page_no")
    nav = F.when(p < F.col("n_pages"), F.concat(
        F.lit("<div class='ui_pagination'><a-x class='ui_button nav next primary' href='/wrong'></a-x>"
              "<a data-class='x' class='ui_button nav next primary' data-href='/wrong' href='"),
        page_path(doc, p + 1), F.lit("' data-href=\"/wrong\">Next</a></div>"))).otherwise(F.lit(
            '<div class="ui_pagination"><span class="ui_button nav next primary disabled">Next</span></div>'))
    body = F.concat(F.lit("<!DOCTYPE html><html><body>"), _hotel_header(doc),
                    F.lit('<div class="reviews">'), F.coalesce(F.col("blocks"), F.lit("")), F.lit("</div>"),
                    nav, F.lit("</body></html>"))
    html = (F.when(failed(doc, p), F.lit("Emergency")).when(banned(doc, p), F.lit(BANNED_BODY))
            .otherwise(body))
    return pages.select("doc_id", "page_no", F.concat(F.lit(SITE), page_path(doc, p)).alias("url"),
                        html.alias("html"))


def fetch_log(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    """``(doc_id, page_no, fetched_at, elapsed_s)``: fetch time of each rendered
    page, taken from ``events`` (event ``doc_id * 8 + page_no``)."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(
        F.col("event_id"), F.col("ts").alias("fetched_at"), F.col("value").alias("elapsed_s"))
    keyed = pages.select("doc_id", "page_no", (F.col("doc_id") * 8 + F.col("page_no")).alias("event_id"))
    return keyed.join(ev, "event_id").drop("event_id")


# SQL of the same rendering rules, for the oracle (DuckDB).
PAGE_URL_SQL = """concat('https://www.tripadvisor.ca/Hotel_Review-g', CAST(100000 + {d} AS VARCHAR), '-d',
    CAST(1000000 + {d} AS VARCHAR), '-Reviews',
    CASE WHEN {p} > 1 THEN concat('-or', CAST(({p} - 1) * 5 AS VARCHAR)) ELSE '' END,
    '-Hotel_', CAST({d} AS VARCHAR), '-City.html')"""
PAGE_STATUS_SQL = """CASE WHEN ({d} % 17 = 3 AND {p} = 2) OR ({d} % 13 = 6 AND {p} = 3) THEN 'fetch_failed'
    WHEN {d} % 19 = 4 AND {p} = 1 THEN 'banned' ELSE 'ok' END"""
