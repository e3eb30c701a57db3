"""Value cases of the scalar expressions (FIXTURES.md §2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.functions import expr as E


def _one(spark, col, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_hotel_id(spark):
    got = _one(spark, E.hotel_id("x"), [("https://s/Hotel_Review-g807293-d15684719-Reviews-V.html",),
                                         ("https://s/Hotel_Review-g12-d1-Reviews.html",), (None,)])
    assert got == ["g807293-d15684719", None, None]


def test_bubble_rating(spark):
    got = _one(spark, E.bubble_rating("x"), [("ui_bubble_rating bubble_45",), ("",), (None,)])
    assert got == ["4.5", None, None]


def test_responder(spark):
    name, title = E.responder("x")
    df = spark.createDataFrame([("Response from Jane Doe, General Manager at Inn",),
                                ("Response from Front desk",), ("Response from A, B, C",),
                                ("Response from Bo, Flight attendant",), (None,)], "x string")
    got = [(r[0], r[1]) for r in df.select(name, title).collect()]
    assert got == [("Jane Doe", " General Manager"), ("Response from Front desk", None),
                   ("Response from A, B, C", None), ("Bo", " Flight"), (None, None)]


def test_review_month(spark):
    df = spark.createDataFrame([(["ann", " wrote a review Jan 2020"], None),
                                (["ann", " wrote a review Yesterday"], None),
                                (["ann", " wrote a review 3 weeks ago"], None),
                                (["ann", " wrote a review nonsense"], None),
                                (["ann"], ["Date of stay:", "March 2019"]),
                                (["ann", "x", "y"], None)],
                               "h array<string>, s array<string>")
    as_of = F.to_date(F.lit("2021-03-02"))
    got = [r[0] for r in df.select(E.review_month("h", "s", as_of)).collect()]
    assert got == ["01-2020", "03-2021", "02-2021", "00-0000", "00-0000", "00-0000"]
    got2 = [r[0] for r in df.select(E.review_month("h", "s", as_of, fallback_stay_date=True)).collect()]
    assert got2[4] == "03-2019"


def test_keys_and_names(spark):
    df = spark.createDataFrame([("r", "01-2020", "ann"), ("", None, None)],
                               "resp string, d string, u string")
    got = [r[0] for r in df.select(E.review_key("resp", "d", "u")).collect()]
    assert got == ["Y-01-2020-ann", "N-None-None"]
    row = spark.range(1).select(
        E.sitemap_file_id(F.lit("sitemap-en_CA-hotel_review-12.xml.gz")).alias("a"),
        E.marker_name(F.lit("sitemap-x-3.xml.gz"), F.lit(25)).alias("b"),
        E.marker_start(F.lit("sitemap-x-3_marker_25.txt")).alias("c"),
        E.url_list_name(F.lit("sitemap-x-3.xml.gz")).alias("d"),
        E.lang_or_null(F.lit("")).alias("e"),
        E.object_key(F.lit("g1-d2"), F.lit("Y-k")).alias("f"),
        E.top_dir(F.lit("ta-crawler/response/en/")).alias("g"),
        E.daily_file_name(F.to_date(F.lit("2021-03-02"))).alias("h"),
        E.next_page_url(F.lit("/Hotel_Review-or5.html")).alias("i"),
        E.class_rating(F.lit("4.0 of 5 bubbles")).alias("j"),
        E.user_id(F.lit("/Profile/ann")).alias("k"),
        E.all_but_first(F.array(F.lit("Popular"), F.lit("pool"))).alias("l"),
        E.join_fragments(F.array().cast("array<string>"), empty_as_null=True).alias("m"),
        E.process_date(F.lit("garbage")).alias("n"),
    ).collect()[0]
    assert row.a == "12" and row.b == "sitemap-x-3_marker_25.txt" and row.c == "25"
    assert row.d == "sitemap-x-3_url.txt" and row.e == "null" and row.f == "g1-d2-Y-k"
    assert row.g == "ta-crawler" and row.h == "en_reviews-02-03-2021.json"
    assert row.i == "https://www.tripadvisor.ca/Hotel_Review-or5.html" and row.j == "4.0"
    assert row.k == "ann" and row.l == ["pool"] and row.m is None and row.n == "garbage"


def test_language_tag_per_language(spark):
    from reviewlake.functions.language import language_tag
    cases = {
        "da": "Værelset var rent og det var meget hyggeligt, jeg kommer ikke til at glemme det",
        "de": "Das Zimmer war sauber und die Lage ist gut, mit dem Bus in den Ort",
        "en": "The room was clean and the staff was kind to us in the evening",
        "es": "La habitación estaba limpia y el personal era muy amable, cerca de las playas",
        "fr": "La chambre est propre et le personnel des plus aimables, pour une nuit",
        "it": "La camera era pulita e il personale gentile, non lontano dal centro della città, una bella vista",
        "nl": "De kamer was schoon en het ontbijt is goed, met een mooi uitzicht op zee, niet duur",
        "pl": "Pokój był czysty i bardzo ładny, ale śniadanie nie jest dobre, jak na tę cenę",
        "pt": "O quarto estava limpo e os funcionários são simpáticos, mas não gostei do café da manhã",
        "sv": "Rummet var rent och personalen är trevlig, det är inte långt till havet",
        "tr": "Oda çok temiz ve personel çok iyi, ama kahvaltı için daha fazla seçenek gerekli",
        "ru": "Номер был чистым, персонал очень вежливый", "ja": "部屋はとてもきれいで、スタッフも親切でした",
        "zh": "房间很干净，服务员非常友好", None: "xyzzy plugh qwerty zzz foo"}
    rows = spark.createDataFrame([(v, k) for k, v in cases.items()], "t string, want string")
    got = {r.t: r.got for r in rows.select("t", language_tag(F.col("t")).alias("got")).collect()}
    assert got == {v: k for k, v in cases.items()}


def test_date_forms(spark):
    cases = [("5 March 2020", "03-2020"), ("2020-03-05", "03-2020"), ("03/2020", "03-2020"), ("March 5, 2020", "03-2020"),
             ("5 Mar 2020", "03-2020"), ("Mar 2020", "03-2020"), ("03/05/2020", "03-2020"), ("2020-03", "03-2020"), ("x 2020", "00-0000")]
    header = F.array(F.lit("Ann"), F.concat(F.lit(E.REVIEW_PREFIX), F.col("x")))
    assert _one(spark, E.review_month(header), [(c,) for c, _ in cases]) == [w for _, w in cases]
    as_of = F.lit("2021-06-15").cast("date")
    assert _one(spark, E.review_month(header, as_of=as_of), [("Mar 5",), ("2 years ago",), ("1 month ago",)]) == ["03-2021", "06-2019", "05-2021"]


def test_date_grammar(spark):
    as_of = F.lit("2021-06-15").cast("date")
    header = F.array(F.lit("Ann"), F.concat(F.lit(E.REVIEW_PREFIX), F.col("x")))
    cases = [("Dec. 2020", "12-2020"), ("déc. 2020", "12-2020"), ("Dezember 2020", "12-2020"), ("décembre 2020", "12-2020"),
             ("Sept. 2019", "09-2019"), ("5 de marzo de 2020", "03-2020"), ("1er août 2020", "08-2020"), ("12. März 2020", "03-2020"),
             ("3rd of May 2020", "05-2020"), ("maggio 2018", "05-2018"), ("maart 2018", "03-2018"), ("MAY 2020", "05-2020"),
             ("a week ago", "06-2021"), ("an hour ago", "06-2021"), ("3 hours ago", "06-2021"), ("20 days ago", "05-2021"), ("today", "06-2021"),
             ("a month ago", "05-2021"), ("vor 2 Monaten", "04-2021"), ("il y a 3 semaines", "05-2021"), ("hace un año", "06-2020"),
             ("3 mesi fa", "03-2021"), ("há 2 meses", "04-2021"), ("2 jaar geleden", "06-2019"), ("Yesterday", "06-2021"), ("Mar 5", "03-2021"),
             ("juillet 2020", "07-2020"), ("jui 2020", "00-0000"), ("May May 2020", "00-0000"), ("2020", "00-0000"), ("13/2020", "00-0000"),
             ("a nice month", "00-0000"), ("maybe 2020", "00-0000"), ("32 May 2020", "00-0000"), ("", "00-0000"), ("99999999999 days ago", "00-0000"),
             ("x " * 5000, "00-0000"), ("May", "00-0000")]
    assert list(zip([c for c, _ in cases], _one(spark, E.review_month(header, as_of=as_of), [(c,) for c, _ in cases]))) == cases
    later = [c for c in cases if c[0] in ("a week ago", "Mar 5", "today")]
    assert _one(spark, E.review_month(header), [(c,) for c, _ in later]) == ["00-0000"] * len(later)
