"""Roll-up gate edges, invariants of the jobs, shards, pagination, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.functions.language import language_tag
from reviewlake.operators import rollup as R
from reviewlake.operators import shards as SH
from reviewlake.operators.joins import range_join
from reviewlake.operators.ordering import global_row_number
from reviewlake.operators.pagination import pagination_chain
from reviewlake.plans import fixtures as FX
from tests.conftest import SF_CHECK, SF_SMALL

EN = "The room was clean and the staff was friendly to us"
FR = "La chambre est propre et le personnel pour les clients"


def test_gate_edges(spark):
    rows = [(0, "g1-d1-Y-a", "x" * 759 + "…", EN),     # 760 chars: not truncated
            (1, "g1-d1-Y-b", "x" * 760 + "…", EN),     # 761 chars ending in …: truncated
            (2, "g1-d1-Y-c", "x" * 800, EN),           # long but no mark: kept
            (3, "g1-d1-Y-d", "ok", FR),                # response not english
            (4, "g1-d1-Y-e", "ok", None),              # no response: not english
            (5, "x1-d1-Y-f", "ok", EN),                # no hotel key: dropped
            (6, "g1-d1-Y-g", None, EN)]                # no text: dropped
    df = spark.createDataFrame(rows, "object_pos long, object_key string, review_text string, "
                                     "review_response string")
    got = [r.verdict for r in R.with_verdict(df).orderBy("object_pos").collect()]
    assert got == ["keep", "truncated", "keep", "response not english", "response not english",
                   "dropped", "dropped"]


def test_gate_totals_and_merge(spark):
    o = FX.fx_review_objects(spark, SF_CHECK)
    gated = R.with_verdict(o)
    counts = {r.verdict: r.n for r in R.verdict_counts(gated).collect()}
    assert sum(counts.values()) == o.count()
    winners, kept, rejects = R.rollup(o, 100)
    # one row per (chunk, keep/reject, key); kept rows are whole objects
    assert winners.groupBy("chunk_id", "is_bad", "object_key").count().where("count > 1").count() == 0
    assert kept.count() == winners.where("not is_bad").count()
    assert rejects.count() == winners.where("is_bad").count()
    assert "review_text" in kept.columns
    winners.unpersist()


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v"))
    n = global_row_number(df.repartition(7), ["k", "v"], "rn", num_partitions=5)
    got = sorted((r.k, r.rn) for r in n.collect())
    assert got == [(k, k) for k in range(5000)]


def test_shard_ranges_cover_and_disjoint(spark):
    urls = FX.fx_urls(spark, SF_CHECK).select("file", "idx", "url")
    ranges = SH.shard_ranges(FX.fx_markers(spark, SF_CHECK), urls)
    a = SH.shard_assignment(urls, ranges)
    # every URL in exactly one shard (markers start at 0 in every file)
    assert a.count() == urls.count()
    assert a.groupBy("file", "idx").count().where("count > 1").count() == 0


def test_marker_owner_is_file_equality(spark):
    """SURVEY D4: markers of file 11 never bound the shards of file 1."""
    urls = spark.createDataFrame([("1", i, f"u{i}") for i in range(10)] + [("11", i, f"v{i}") for i in range(4)],
                                 "file string, idx long, url string")
    markers = spark.createDataFrame([("1", 0, 0), ("11", 2, 2), ("1", 6, 7)],
                                    "file string, start int, marker int")
    got = sorted((r.file, r.start, r.stop) for r in SH.shard_ranges(markers, urls).collect())
    assert got == [("1", 0, 5), ("1", 6, 9), ("11", 2, 3)]


def test_range_join_widths_agree(spark):
    points = spark.range(0, 3000).select(F.lit("a").alias("k"), F.col("id").alias("p"))
    ranges = spark.createDataFrame([("a", i * 100, i * 100 + 99) for i in range(30)],
                                   "k string, lo long, hi long")
    key = ["k", "p", "lo", "hi"]
    found = [sorted(tuple(r) for r in range_join(points, ranges, "k", "p", "lo", "hi", w).select(key).collect())
             for w in (7, 100, 5000)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 3000


def test_no_job_runs_while_plain_queries_are_built(spark):
    """Joins and documents are plain plans: nothing runs until they are used."""
    from reviewlake.operators import documents as D
    from reviewlake.operators import shards as SH
    from reviewlake.plans.registry import _fx_documents, _fx_hotels_typed
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("build-only", "plans only")
    try:
        _fx_documents(spark, SF_SMALL)
        D.repack(D.dedup_reviews(FX.fx_reviews(spark, SF_SMALL)), D.meta_documents(_fx_hotels_typed(spark, SF_SMALL)))
        SH.shard_assignment(FX.fx_urls(spark, SF_SMALL), FX.fx_markers(spark, SF_SMALL).withColumn("stop", F.col("start") + 24), 25)
        run_log_pages = spark.createDataFrame([(1, 1, "u", "ok", 2)], "doc_id long, page_no int, url string, status string, n_reviews long")
        from reviewlake.operators.runlog import run_log
        run_log(run_log_pages)
        from reviewlake.session import table
        table(spark, SF_SMALL, "pages")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # reading a Parquet footer is the only job that building may run
    stages = [st for j in tracker.getJobIdsForGroup("build-only") for st in (tracker.getJobInfo(j) or ()).stageIds]
    names = {tracker.getStageInfo(st).name for st in stages if tracker.getStageInfo(st)}
    assert all(n.startswith("parquet") for n in names), names


def _chain(spark, links, starts=None):
    df = spark.createDataFrame(links, "url string, next_url string")
    given = None if starts is None else spark.createDataFrame([(x,) for x in starts], "url string")
    return sorted((r.root_url, r.page_no, r.url) for r in pagination_chain(df, given).collect())


def test_pagination_long_chain_and_cycle(spark):
    n = 300   # longer than the default recursive CTE level limit (100)
    links = [(f"p{i}", f"p{i + 1}" if i < n - 1 else None) for i in range(n)]
    links += [("c0", "c1"), ("c1", "c2"), ("c2", "c0")]      # a cycle: no start page
    got = {u: (root, k) for root, k, u in _chain(spark, links)}
    assert len(got) == n
    assert got["p0"] == ("p0", 1) and got[f"p{n - 1}"] == ("p0", n)


def test_pagination_shared_tail_and_cycle_behind_a_start(spark):
    assert _chain(spark, [("a", "c"), ("b", "c"), ("c", "d"), ("d", None)]) == [
        ("a", 1, "a"), ("a", 2, "c"), ("a", 3, "d"), ("b", 1, "b"), ("b", 2, "c"), ("b", 3, "d")]
    assert _chain(spark, [("z", "s"), ("s", "t"), ("t", "s")]) == [("z", 1, "z"), ("z", 2, "s"), ("z", 3, "t")]
    # starts from a URL list: the middle of a chain, a page nobody landed, a NULL link
    assert _chain(spark, [("a", "b"), ("b", "c"), ("c", None), (None, "a")], ["b", "lost"]) == [("b", 1, "b"), ("b", 2, "c")]
    assert _chain(spark, [("a", "gone")], ["a"]) == [("a", 1, "a")]


def test_four_pages_with_a_failed_second_page(spark):
    """Page 3 follows a failed page: only page 1 counts, the hotel appears once."""
    from reviewlake import schemas as S
    from reviewlake.operators import documents as D
    from reviewlake.plans import jobs as J
    from tests.test_extract import BLOCK_RESP, HEADER
    url = "https://www.tripadvisor.ca/Hotel_Review-g1234-d12345-Reviews{}-V.html"
    nxt = '<a class="ui_button nav next primary" href="/Hotel_Review-g1234-d12345-Reviews-or{}-V.html">Next</a>'
    html = [f"<html>{HEADER}{BLOCK_RESP.replace('/Profile/ann', f'/Profile/user{k}')}{nxt.format(5 * k) if k < 4 else ''}</html>"
            for k in (1, 2, 3, 4)]
    html[1] = "Emergency"
    pages = spark.createDataFrame([(url.format(f"-or{5 * k}" if k else ""), h) for k, h in enumerate(html)], "url string, html string")
    docs, log = J.pages_to_documents(pages, starts=pages.select("url").where(F.col("url") == url.format("")))
    rows = D.split_documents(D.parse_documents(docs, "document"), S.REVIEW, S.HOTEL).collect()
    assert [r.review.id_user for r in rows] == ["user1"] and rows[0].hotel_key == "g1234-d12345"
    got = log.collect()
    assert [(r.status, r.n_reviews, r.url) for r in got] == [("Empty", 1, url.format(""))]


def test_json_keys_are_escaped(spark):
    """A user id with a tab, a line feed and a quote survives document and split."""
    from reviewlake import schemas as S
    from reviewlake.operators import documents as D
    user = 'a\tb\n"c"\\é'
    hotels = spark.createDataFrame([(1, "g1234-d12345", "g1234-d12345")], "doc_id long, hotel_key string, id_hotel string")
    reviews = spark.createDataFrame([(1, 1, 0, user, "01-2020", "en", "text", None)],
                                    "doc_id long, page_no int, pos long, id_user string, review_date string, "
                                    "review_language string, review_text string, review_response string")
    docs = D.hotel_documents(hotels, reviews, ["id_hotel"], ["id_user", "review_text"])
    row = D.split_documents(D.parse_documents(docs, "document"), S.REVIEW, S.HOTEL).first()
    assert row.review.id_user == user and row.review_key == f"N-01-2020-{user}" and row.review.review_text == "text"


def test_last_landed_document_wins(spark, scratch):
    import os
    import time

    from reviewlake.plans import jobs as J
    doc = '[{{"g1234-d12345": {{"id_hotel": "h"}}, "Y-01-2020-u": {{"id_user": "u", "review_response": "{}"}}}}]'
    os.makedirs(f"{scratch}/docs")
    for k, text in enumerate(("first", "second")):
        with open(f"{scratch}/docs/{1 - k}.txt", "w") as f:
            f.write(doc.format(text) + "\n" + ("[]\n" if k else ""))
        os.utime(f"{scratch}/docs/{1 - k}.txt", (time.time() + 10 * k,) * 2)
    out = J.split_to_sink(spark, f"{scratch}/docs", f"{scratch}/out")
    from reviewlake.sources.readers import read_review_objects
    assert [r.review.review_response for r in read_review_objects(spark, out).collect()] == ["second"]
    assert [r.reason for r in spark.read.json(f"{out}-rejected").collect()] == ["unparsable"]


def test_language_agreement(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    t = d.select("lang", language_tag(F.col("text")).alias("got")).where(F.col("got").isNotNull())
    scored = t.count()
    agree = t.where(F.col("lang") == F.col("got")).count()
    assert scored > 0.9 * d.count()
    assert agree / scored >= 0.95


def test_stream_restart_adds_nothing(spark, scratch):
    from reviewlake.plans.registry import _fx_documents
    from reviewlake import sinks as K
    from reviewlake.streaming.split_stream import read_stream_output, start_split_stream
    docs = K.write_hotel_documents(_fx_documents(spark, SF_SMALL), f"{scratch}/docs")
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    start_split_stream(spark, f"{docs}/*", out, ckpt).awaitTermination()
    first = read_stream_output(spark, out).count()
    assert first > 0
    start_split_stream(spark, f"{docs}/*", out, ckpt).awaitTermination()   # nothing new
    assert read_stream_output(spark, out).count() == first
    # a new landed file is picked up, and only it
    extra = '[{"g9999-d99999": {"id_hotel": "g9999-d99999"}, "Y-01-2020-zed": {"id_user": "zed", "review_response": "ok"}}]'
    import os
    os.makedirs(f"{docs}/file_id=9", exist_ok=True)
    with open(f"{docs}/file_id=9/new.txt", "w") as f:
        f.write(extra + "\n")
    start_split_stream(spark, f"{docs}/*", out, ckpt).awaitTermination()
    assert read_stream_output(spark, out).count() == first + 1


def test_split_then_rebuild_gives_same_documents(spark):
    from reviewlake import schemas as S
    from reviewlake.operators import documents as D
    from reviewlake.plans.registry import FX_HOTEL_FIELDS, FX_REVIEW_FIELDS, _fx_documents
    docs = D.parse_documents(_fx_documents(spark, SF_CHECK), "document")
    kept = docs.where(F.size(F.map_filter("entries", lambda k, v: F.left(k, F.lit(1)) == "g")) == 1) \
        .where(F.size("entries") > 1)
    split = D.split_documents(kept, S.REVIEW, S.HOTEL)
    hotels = split.select("doc_id", "hotel_key", F.col("meta_data.*")).dropDuplicates(["doc_id"])
    reviews = split.select("doc_id", "page_no", F.lit(0).alias("pos"), F.col("review.*"))
    rebuilt = D.parse_documents(D.hotel_documents(hotels, reviews, FX_HOTEL_FIELDS, FX_REVIEW_FIELDS),
                                "document")

    def keyed(df):
        return {(r.doc_id, r.page_no): (sorted(r.entries.keys()), sorted(r.entries.values()))
                for r in df.select("doc_id", "page_no", "entries").collect()}
    assert keyed(rebuilt) == keyed(kept)


def test_split_then_rollup_of_the_english_prefix(spark, scratch):
    """The reference's flow: split documents into response/<lang>/ objects,
    then roll up one prefix (S5 -> X5 -> F7 -> W2 -> A4 -> K3)."""
    from reviewlake import sinks as K
    from reviewlake.plans import jobs as J
    from reviewlake.plans.registry import _fx_documents, _split_docs
    split = _split_docs(_fx_documents(spark, SF_CHECK)).select(*J.OBJECT_COLUMNS)
    prefix = K.write_split_reviews(split, f"{scratch}/split")
    objects = J.review_objects_for_rollup(spark, prefix, "response", "en")
    n_in = objects.count()
    good, bad = J.rollup_job(objects, f"{scratch}/rollup", chunk_size=10)
    whole = spark.read.json(good)
    assert {"meta_data", "review"} <= set(whole.columns)      # the whole object is rolled up
    assert whole.where("review.review_text IS NULL OR meta_data.name_hotel IS NULL").count() == 0
    kept = whole.count()
    rejected = spark.read.json(bad).count() if n_in else 0
    gated = {r.verdict: r.n for r in R.verdict_counts(R.with_verdict(objects)).collect()}
    assert n_in > 0 and sum(gated.values()) == n_in
    # object keys are unique in a split prefix, so nothing merges away
    assert kept == gated.get("keep", 0)
    assert rejected == gated.get("truncated", 0) + gated.get("response not english", 0)


def test_pages_to_documents(spark):
    """Landed pages -> documents, page order from the next links alone."""
    from reviewlake import schemas as S
    from reviewlake.operators import documents as D
    from reviewlake.plans import jobs as J
    from reviewlake.plans import render as RD
    pages = RD.render_hotel_pages(spark, SF_SMALL)
    docs, log = J.pages_to_documents(pages.select("url", "html"), starts=pages.where("page_no = 1").select("url"))
    split = D.split_documents(D.parse_documents(docs, "document"), S.REVIEW, S.HOTEL)
    got = sorted((r.hotel_key, r.review_key) for r in split.collect())
    # expected from the fixture: reviews of ok pages before the first bad page, deduplicated
    r = FX.fx_reviews(spark, SF_SMALL)
    bad = RD.failed(F.col("doc_id"), F.col("page_no")) | RD.banned(F.col("doc_id"), F.col("page_no"))
    stop = r.select("doc_id", "page_no").withColumn("bad", bad)
    first_bad = {row.doc_id: row.p for row in stop.where("bad").groupBy("doc_id").agg(F.min("page_no").alias("p")).collect()}
    banned_first = {d for d, p in first_bad.items() if p == 1}
    read = spark.createDataFrame([e for e in r.collect() if e.doc_id not in banned_first
                                  and e.page_no < first_bad.get(e.doc_id, 10**9)], r.schema)
    want = sorted((f"g{100000 + e.doc_id}-d{1000000 + e.doc_id}", e.review_key) for e in D.dedup_reviews(read).collect())
    assert got == want and len(got) > 0
    assert log.count() == pages.select("doc_id").distinct().count()
    # run log: reviews gathered before the first failed page, counted before dedup
    raw = r.select("doc_id", "page_no").collect()
    want_n = {}
    for x in raw:
        want_n.setdefault(x.doc_id, 0)
        if x.page_no < first_bad.get(x.doc_id, 10**9):
            want_n[x.doc_id] += 1
    got_n = {int(row.hotel_id.split("-")[0][1:]) - 100000: row.n_reviews for row in log.collect()}
    assert got_n == want_n
