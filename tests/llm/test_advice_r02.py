
from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.llm import langid, secrets, toxicity
from reviewlake.llm.common import crc_of
from tests.conftest import SF_CHECK
from tests.llm import odd

SF_LARGE = "/root/testdata/sf0.1"


def test_toxicity_of_long_clean_texts(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet").select("doc_id", "text").where("text IS NOT NULL")
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    learned = crc_of(F.col("doc_id")) % 5 != 0
    model = toxicity.train(docs.where(learned), labels.where(learned))
    held = docs.join(labels.where(~learned).select("doc_id", "toxic"), "doc_id").toPandas().sort_values("doc_id")
    clean = "\n".join(held.text[held.toxic == 0])
    clean = (clean + "\n") * (1_000_000 // len(clean) + 1)
    toxic = spark.createDataFrame([(t,) for t in held.text[held.toxic == 1]], "text string")
    found = toxic.select("text", toxicity.scored(F.col("text"), model, 0.5).alias("s")).where("size(s.offending) > 0").collect()
    worst = max(((x.p, r.text[x.start:x.end]) for r in found for x in r.s.offending))[1]
    half = len(clean) // 2
    texts = [clean, f"{clean[:half]}\n{worst}.\n{clean[half:]}"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(toxicity.scored(F.col("text"), model, 0.5).alias("s")).collect()
    assert len(clean) >= 1_000_000
    assert got[0].s.score < 0.5 and not got[0].s.offending
    assert got[1].s.score >= 0.5 and len(got[1].s.offending) == 1


def test_toxicity_learns_from_long_texts(spark):
    filler = "we walk to the river and back again today. " * 800
    rows = [(k, f"{filler}you are a {'grumblewort' if k % 4 == 0 else 'friend'}.", "en", "a", 1) for k in range(100)]
    rows = [(k, f"number {k}. {t}", *rest) for k, t, *rest in rows]
    docs = odd.documents(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(100)], "doc_id long, toxic int"))
    got = docs.select("doc_id", toxicity.scored(docs.text, model).alias("s")).collect()
    assert all((r.s.score >= 0.5) == (r.doc_id % 4 == 0) for r in got)


def test_unlearned_languages_go(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    docs = docs.select("doc_id", "text", "lang")
    foreign = ["我们今天去河边散步，然后回家吃晚饭。", "Мы сегодня гуляли у реки и потом вернулись домой ужинать", "河",
               "xqzvk jwqpf zzkjx qvbnm wxkcq jhgfq pzxvq kkqzj bvcxq mnbvq", "आज हम नदी के किनारे घूमने गए",
               "Dzisiaj poszliśmy na spacer nad rzekę, a potem wróciliśmy do domu na kolację z przyjaciółmi i rodziną"]
    words = docs.where("length(text) > 40").orderBy("doc_id").limit(300).collect()
    short = [" ".join(r.text.split()[:k % 3 + 1]) for k, r in enumerate(words)]
    short = sorted({t for t in short if t.isascii() and t.replace(" ", "").isalpha()})
    more = spark.createDataFrame([(10_000_000 + k, t, None) for k, t in enumerate(foreign + short)], docs.schema)
    for rows in (docs, docs.where("lang IN ('en', 'de')")):
        kept = {r.text for r in langid.known_language(rows.unionByName(more)).collect()}
        assert not kept & set(foreign)
        assert set(short) <= kept if rows is docs else len(kept & set(short)) > len(short) // 2
        assert {r.text for r in rows.collect() if any(c.isalpha() for c in r.text or "")} <= kept


def test_secrets_without_digits(spark):
    key, token = "AKIA" + "QWERTZUI" * 2, "eyJhbGciOiJ.eyJzdWIiOiJhYmMi.c2lnbmF0dXJlLXg"
    want = {1: [key], 2: ["password=hunterhunter"], 3: ["sesame"], 4: [token], 5: ["correcthorse"], 6: ["S!x$"], 7: ["abcdefabcdefabcd"],
            8: ["DB_PASSWORD=geheim"], 9: [], 10: ["abc123abc123"]}
    texts = {1: f"my key is {key} ok", 2: "use password=hunterhunter, please", 3: "pwd: sesame.", 4: f"sent {token} back",
             5: '{"password": "correcthorse"}', 6: "Token = 'S!x$'", 7: "Bearer abcdefabcdefabcd", 8: "DB_PASSWORD=geheim\n",
             9: "internationalisation of the token economy: a password-less story", 10: "abc123abc123.Then"}
    docs = odd.documents(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])
    rows = secrets.candidates(docs).orderBy("doc_id", "nth").collect()
    assert {i: [r.found for r in rows if r.doc_id == i] for i in texts} == want
    many = [(100 * k + i, t, "en", "a", 1) for k in range(20) for i, t in enumerate(
        ["key AKIA" + "Q7" * 8, "card 4111111111111111 paid", "at 2024-01-02T03:04:05-06", "token = '" + "ab12" * 10 + "'"])]
    docs = odd.documents(spark, [*many, (9_999, texts[1], "en", "a", 1)])
    found = secrets.features(secrets.candidates(docs), secrets.corpus_words(docs))
    judged = secrets.scored(found, secrets.train(secrets.weak_labels(found).where("doc_id <> 9999"))).where("doc_id = 9999").collect()
    assert [(r.found, r.kept) for r in judged] == [(key, True)]


def test_langid_counts_copies_once(spark, monkeypatch):
    texts = [f"number {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]} of the {'uvwxyz'[k % 6]} lines" for k in range(60)]
    rows = [(k, t, "en" if k % 2 else "de", "a", 1) for k, t in enumerate(texts)]
    rows += [(1000 + k, texts[1], "en", "a", 1) for k in range(500)]
    sizes = []
    monkeypatch.setattr(langid, "fitted", lambda sample, fit: sizes.append(sample.count()) or b"")
    langid.train(odd.documents(spark, rows))
    langid.train(odd.documents(spark, rows[:60]))
    assert sizes[0] == sizes[1] == 60
