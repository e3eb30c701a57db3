"""Language tag: short texts, many languages, nothing certain, and agreement with its DuckDB form."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from reviewlake.functions import language as L

SHORT = {
    "en": ["Thanks, come back soon.", "Thank you!", "Lovely stay", "We hope to welcome you back next summer."],
    "de": ["Danke, kommen Sie bald wieder.", "Wir würden uns über einen weiteren Besuch freuen."],
    "es": ["Gracias, vuelva pronto.", "Muy buen hotel"], "fr": ["Merci, revenez bientôt.", "Très bon hôtel"],
    "it": ["Grazie, torni presto."], "pt": ["Obrigado, volte sempre."], "nl": ["Bedankt en tot ziens."],
    "da": ["Tak for besøget, kom snart igen."], "sv": ["Tack, välkommen åter."], "no": ["Takk for besøket, velkommen tilbake."],
    "fi": ["Kiitos, tervetuloa uudelleen."], "pl": ["Dziękujemy i zapraszamy ponownie."],
    "cs": ["Děkujeme a těšíme se na vaši další návštěvu.", "Hotel leží v klidné části města a pokoje byly čisté."],
    "hu": ["Köszönjük, várjuk vissza.", "A szálloda csendes helyen van és a szobák tiszták voltak."],
    "ro": ["Mulțumim și vă mai așteptăm."], "hr": ["Hvala, dođite nam opet."], "tr": ["Teşekkürler, yine bekleriz."],
    "ru": ["Спасибо, приезжайте ещё."], "uk": ["Дякуємо, приїжджайте ще."], "vi": ["Cảm ơn bạn, hẹn gặp lại."],
    "id": ["Terima kasih, sampai jumpa lagi."], "el": ["Ευχαριστούμε, ελάτε ξανά."], "th": ["ขอบคุณค่ะ แล้วพบกันใหม่"],
    "ko": ["감사합니다. 또 오세요."], "he": ["תודה ולהתראות"], "ar": ["شكرا لكم ونراكم قريبا"], "hi": ["धन्यवाद, फिर आइए"],
    "ja": ["ありがとうございます。またお越しください。"], "zh": ["谢谢，欢迎再来。"],
    None: ["xyzzy plugh qwerty zzz foo", "", "   ", "12345 !!! ...", "asdf jkl qwe", "ok", None, "@#%&*()", "\n\t"],
}


def _tagged(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: r.got for r in rows.select("i", L.language_tag(F.col("t")).alias("got")).collect()}


def test_short_texts(spark):
    cases = [(t, lang) for lang, texts in SHORT.items() for t in texts]
    got = _tagged(spark, [t for t, _ in cases])
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases
    assert len(L.LANGUAGES) + len(L.SCRIPTS) >= 45


def test_long_and_repeated_texts(spark):
    texts = ["Thanks, come back soon. " * 3000, "Děkujeme a těšíme se na vaši další návštěvu. " * 3000, "qzx " * 100_000, "é" * 200_000,
             " ".join(f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzaeio") * 20]
    got = _tagged(spark, texts)
    assert [got[i] for i in range(3)] == ["en", "cs", None]


def test_weights_fit_their_fields():
    for rows in (L.gram_rows(), L.word_rows()):
        assert max(sum(w for lang, _, w in rows if lang == x) for x in L.LANGUAGES) < 1 << L.FIELD
    assert L.PACKED * L.FIELD < 64
    assert {lang for lang, *_ in L.gram_rows()} == set(L.LANGUAGES) == set(L.SAMPLES)


def test_duckdb_form_agrees(spark):
    texts = [t for ts in SHORT.values() for t in ts] + [
        "Das Zimmer war sauber und die Lage ist gut", "the a of and", "de la que", "Hotel 5* – très bon, très propre!", "a", "l'hôtel d'à côté",
        "Tack och 'hej'", "и на за", "ok thanks", "part\npart\tpart", "“quoted” «text» it’s fine"]
    con = duckdb.connect()
    con.execute("CREATE TABLE s (i INTEGER, t VARCHAR)")
    con.executemany("INSERT INTO s VALUES (?, ?)", list(enumerate(texts)))
    want = dict(con.execute(L.language_tag_sql("s", "i", "t", "i")).fetchall())
    assert _tagged(spark, texts) == want


def test_script_test_spares_latin_text(spark):
    """Texts below U+0370 are told apart by one comparison; every character is classed as by the scripts alone."""
    assert L._ANY_SCRIPT.startswith(r"[\x{370}-\x{10FFFF}&&[")
    plain = "[" + "".join(L._class(names, "Is") for _, names, _ in L.SCRIPTS) + "]"
    chars = spark.range(1, 0x30000).where("id < 55296 OR id > 57343").select(F.decode(F.encode(F.expr(
        "CASE WHEN id < 256 THEN char(id) ELSE decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') END"), "UTF-8"), "UTF-8").alias("c"))
    assert chars.where(F.col("c").rlike(L._ANY_SCRIPT) != F.col("c").rlike(plain)).count() == 0
    assert chars.where(F.col("c").rlike(plain)).count() > 50_000
