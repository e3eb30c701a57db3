"""Language tag of a text (X5) as a column expression, in three steps.

1. Scripts: a text written in a script that stands for one language is tagged
   by it (Greek, Thai, Hangul, kana, Han and others).
2. Words: each language's frequent function words, looked up among the text's
   distinct words. The tag stands if one of them in ``MIN_SHARE`` is such a word
   (of ``MOST_WORDS`` at most) and the best language is well ahead of the second.
3. Character n-grams, for what is left (short texts, languages that share
   words): naive Bayes over the text's distinct 1- to 3-grams. A gram weighs
   ``SCALE`` times the logarithm of its rate in a language against the rate of a
   gram that was never seen there. The best language must lead the second by
   ``LEAD``, that is a posterior of 1 / (1 + exp(-LEAD / SCALE)) between the two,
   and must know enough of the text's grams. Else the tag is NULL
   ("undetectable").

Weights are whole numbers, so sums are exact; ties go to the smaller code. The
gram profile is made by one rule from the sample of each language (``SAMPLES``
and its function words): its ``GRAMS`` most frequent grams.

Everything is one JVM expression: no Python per row, no explode, no join and no
shuffle, so it runs inside the scan stage at any scale and the tag stays on its
row. The profiles are literals, shipped with the plan: an item's weights for all
languages are ``FIELD``-bit fields of a few longs, found by its bucket and summed
in one pass over the text's distinct items.
"""

from __future__ import annotations

import functools
import json
import math
import re
import zlib
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.common import let

# Frequent function words per language.
PROFILE_WORDS = {
    "bg": "и на за се от да не е в с че са ще като това",
    "ca": "els les amb per una és del que al molt i de la a en",
    "cs": "a je se na v že to jsme byl velmi pro ale jsou jako byla",
    "cy": "yn y i a yr o ar am wedi ei oedd bod ac gan mae",
    "da": "og det som på af med den ikke til har jeg vi var meget er",
    "de": "der die und in den von zu das mit sich auf des war ist wir",
    "en": "the of and to a in is that it for was on we you your",
    "es": "de la que el en y los se del las por un muy con una",
    "et": "ja on ei see oli et kui väga ka oma mis või meie me",
    "fi": "ja on ei se oli että mutta myös kun hyvin kuin olivat tai ovat",
    "fr": "de la le et les des en un du une que pour est nous très",
    "hr": "i je u na se da su za od bio vrlo kao što nije ali",
    "hu": "a az és hogy nem is egy volt nagyon ez de van meg csak",
    "id": "yang dan di itu dengan untuk tidak dari ini kami sangat ada pada kamar",
    "it": "di che il per non una con della è sono anche gli molto la era",
    "lt": "ir yra buvo labai su kad į iš ne tai bet per mes už",
    "lv": "un ir bija ļoti ar ka no uz par bet mēs tas kas gan",
    "mk": "и на за се од да не е во со дека беше многу што сме",
    "nl": "het een van dat niet op te zijn met voor ook wij de en was",
    "no": "og det som på av med den ikke til har jeg vi var veldig er",
    "pl": "w na nie się że jest to jak po ale był bardzo i z do",
    "pt": "de que não do da em para com uma os mas muito o e foi",
    "ro": "și de la în a cu pe este o nu să un foarte din au",
    "ru": "и в не на что с как это был очень мы по для но номер",
    "sk": "a je sa na v že to sme bol veľmi pre ale sú ako bola",
    "sl": "in je v na se da so za bil zelo kot pa ni smo ali",
    "sq": "dhe të në e i me për një është nga që shumë ishte nuk",
    "sv": "och att det som är på av med den inte till har var vi mycket",
    "sw": "na ya kwa ni wa katika za la kuwa sana hii yetu cha",
    "tl": "ang ng sa at na mga ay ito hindi para kami po namin",
    "tr": "ve bir bu için çok ile ama gibi daha var değil olan da de",
    "uk": "і в не на що з як це був дуже ми по для але та",
    "vi": "và là của có không được rất cho một với chúng tôi trong này",
}
# A few everyday sentences per language, the sample of its grams.
SAMPLES = {
    "bg": "благодарим ви за отзива радваме се че престоят ви е харесал и се надяваме скоро да ви посрещнем отново стаята беше чиста персоналът любезен а закуската вкусна всички хора се раждат свободни и равни по достойнство и права",
    "ca": "gràcies per la vostra opinió ens alegra que hàgiu gaudit de l'estada i esperem tornar-vos a veure aviat l'habitació era neta i el personal molt amable tots els éssers humans neixen lliures i iguals en dignitat i drets",
    "cs": "děkujeme za vaši recenzi jsme rádi že se vám pobyt líbil a doufáme že vás brzy znovu uvidíme pokoj byl čistý personál příjemný a snídaně výborná všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv",
    "cy": "diolch am eich adolygiad rydym yn falch eich bod wedi mwynhau eich arhosiad ac yn gobeithio eich gweld eto yn fuan roedd yr ystafell yn lân a'r staff yn gyfeillgar genir pawb yn rhydd ac yn gydradd â'i gilydd mewn urddas a hawliau",
    "da": "tak for din anmeldelse vi er glade for at du nød dit ophold og håber at se dig igen snart værelset var rent og personalet venligt morgenmaden var dejlig alle mennesker er født frie og lige i værdighed og rettigheder",
    "de": "vielen dank für ihre bewertung wir freuen uns dass ihnen ihr aufenthalt gefallen hat und hoffen sie bald wieder bei uns begrüßen zu dürfen das zimmer war sauber das personal freundlich und das frühstück sehr gut ein sehr schönes hotel mit toller lage gerne wieder alle menschen sind frei und gleich an würde und rechten geboren",
    "en": "thank you for your review we are glad that you enjoyed your stay and hope to see you again soon the room was clean the staff was friendly and helpful and the breakfast was great thanks for coming back please let us know great location lovely stay very nice place excellent service would recommend all human beings are born free and equal in dignity and rights",
    "es": "gracias por su comentario nos alegra que haya disfrutado de su estancia y esperamos verle de nuevo pronto la habitación estaba limpia el personal era muy amable y el desayuno excelente muy buen hotel con buena ubicación vuelva pronto todos los seres humanos nacen libres e iguales en dignidad y derechos",
    "et": "täname teid arvustuse eest meil on hea meel et teie peatumine meeldis ja loodame teid peagi taas näha tuba oli puhas ja töötajad sõbralikud hommikusöök oli väga hea kõik inimesed sünnivad vabadena ja võrdsetena oma väärikuselt ja õigustelt",
    "fi": "kiitos arvostelustasi olemme iloisia että viihdyitte ja toivomme näkevämme teidät pian uudelleen huone oli siisti ja henkilökunta ystävällistä aamiainen oli erinomainen kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
    "fr": "merci pour votre avis nous sommes heureux que vous ayez apprécié votre séjour et espérons vous revoir bientôt la chambre était propre le personnel très agréable et le petit déjeuner excellent un très bon hôtel bien situé à bientôt tous les êtres humains naissent libres et égaux en dignité et en droits",
    "hr": "hvala vam na recenziji drago nam je što ste uživali u boravku i nadamo se da ćemo vas uskoro ponovno vidjeti soba je bila čista osoblje ljubazno a doručak odličan sva ljudska bića rađaju se slobodna i jednaka u dostojanstvu i pravima",
    "hu": "köszönjük az értékelést örülünk hogy jól érezte magát nálunk és reméljük hogy hamarosan viszontlátjuk a szoba tiszta volt a személyzet kedves és a reggeli nagyon finom minden emberi lény szabadon születik és egyenlő méltósága és joga van",
    "id": "terima kasih atas ulasan anda kami senang anda menikmati masa menginap dan berharap dapat bertemu anda kembali kamarnya bersih stafnya ramah dan sarapannya enak semua orang dilahirkan merdeka dan mempunyai martabat dan hak yang sama",
    "it": "grazie per la sua recensione siamo lieti che abbia apprezzato il soggiorno e speriamo di rivederla presto la camera era pulita il personale molto gentile e la colazione ottima tutti gli esseri umani nascono liberi ed eguali in dignità e diritti",
    "lt": "dėkojame už jūsų atsiliepimą džiaugiamės kad jums patiko viešnagė ir tikimės greitai vėl jus pamatyti kambarys buvo švarus o darbuotojai malonūs pusryčiai skanūs visi žmonės gimsta laisvi ir lygūs savo orumu ir teisėmis",
    "lv": "paldies par jūsu atsauksmi priecājamies ka jums patika uzturēšanās un ceram jūs drīz atkal redzēt istaba bija tīra un personāls laipns brokastis bija garšīgas visi cilvēki piedzimst brīvi un vienlīdzīgi savā pašcieņā un tiesībās",
    "mk": "ви благодариме за вашето мислење мило ни е што уживавте во престојот и се надеваме дека наскоро пак ќе ве видиме собата беше чиста персоналот љубезен а појадокот вкусен сите човечки суштества се раѓаат слободни и еднакви по достоинство и права",
    "nl": "bedankt voor uw beoordeling we zijn blij dat u van uw verblijf heeft genoten en hopen u snel weer te zien de kamer was schoon het personeel vriendelijk en het ontbijt heerlijk alle mensen worden vrij en gelijk in waardigheid en rechten geboren",
    "no": "takk for din anmeldelse vi er glade for at du likte oppholdet og håper å se deg igjen snart rommet var rent og betjeningen hyggelig frokosten var veldig god alle mennesker er født frie og med samme menneskeverd og menneskerettigheter",
    "pl": "dziękujemy za opinię cieszymy się że pobyt się państwu podobał i mamy nadzieję że wkrótce znów państwa zobaczymy pokój był czysty obsługa miła a śniadanie bardzo dobre wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
    "pt": "obrigado pela sua avaliação ficamos felizes que tenha gostado da sua estadia e esperamos vê-lo novamente em breve o quarto estava limpo os funcionários eram muito simpáticos e o café da manhã ótimo todos os seres humanos nascem livres e iguais em dignidade e em direitos",
    "ro": "vă mulțumim pentru recenzie ne bucurăm că v-ați simțit bine și sperăm să vă revedem în curând camera a fost curată personalul foarte amabil iar micul dejun excelent toate ființele umane se nasc libere și egale în demnitate și în drepturi",
    "ru": "спасибо за ваш отзыв мы рады что вам понравилось у нас и надеемся скоро увидеть вас снова номер был чистым персонал очень вежливым а завтрак вкусным отличное место приезжайте ещё будем рады все люди рождаются свободными и равными в своем достоинстве и правах",
    "sk": "ďakujeme za vašu recenziu sme radi že sa vám pobyt páčil a dúfame že vás čoskoro opäť uvidíme izba bola čistá personál príjemný a raňajky výborné všetci ľudia sa rodia slobodní a sebe rovní čo sa týka ich dôstojnosti a práv",
    "sl": "hvala za vaše mnenje veseli nas da ste uživali v bivanju in upamo da vas kmalu spet vidimo soba je bila čista osebje prijazno in zajtrk odličen vsi ljudje se rodijo svobodni in imajo enako dostojanstvo in enake pravice",
    "sq": "faleminderit për vlerësimin tuaj jemi të lumtur që ju pëlqeu qëndrimi dhe shpresojmë t'ju shohim përsëri së shpejti dhoma ishte e pastër stafi shumë i sjellshëm dhe mëngjesi i shkëlqyer të gjithë njerëzit lindin të lirë dhe të barabartë në dinjitet dhe në të drejta",
    "sv": "tack för din recension vi är glada att du trivdes hos oss och hoppas få se dig snart igen rummet var rent och personalen trevlig frukosten var mycket god alla människor är födda fria och lika i värde och rättigheter",
    "sw": "asante kwa maoni yako tunafurahi kwamba ulifurahia kukaa kwetu na tunatumaini kukuona tena hivi karibuni chumba kilikuwa safi na wafanyakazi wazuri sana watu wote wamezaliwa huru hadhi na haki zao ni sawa",
    "tl": "maraming salamat sa inyong pagsusuri natutuwa kami na nasiyahan kayo sa inyong pananatili at umaasa kaming makita kayong muli malinis ang silid at mababait ang mga tauhan ang lahat ng tao ay isinilang na malaya at pantay pantay sa karangalan at mga karapatan",
    "tr": "yorumunuz için teşekkür ederiz konaklamanızdan memnun kalmanıza sevindik ve sizi yakında tekrar görmeyi umuyoruz oda temizdi personel çok güler yüzlü ve kahvaltı harikaydı bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar",
    "uk": "дякуємо за ваш відгук ми раді що вам сподобалося у нас і сподіваємося незабаром побачити вас знову номер був чистим персонал дуже привітним а сніданок смачним всі люди народжуються вільними і рівними у своїй гідності та правах",
    "vi": "cảm ơn quý khách đã đánh giá chúng tôi rất vui vì quý khách hài lòng với kỳ nghỉ và hy vọng sớm được gặp lại phòng sạch sẽ nhân viên thân thiện và bữa sáng rất ngon tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi",
}
# Scripts that stand for one language here, tested in this order:
# (code, names of the script, one letter in so many must be of it).
SCRIPTS = [("ja", ["Hiragana", "Katakana"], 5), ("zh", ["Han"], 2), ("ko", ["Hangul"], 3), ("el", ["Greek"], 2), ("th", ["Thai"], 2),
           ("he", ["Hebrew"], 2), ("ar", ["Arabic"], 2), ("hi", ["Devanagari"], 2), ("bn", ["Bengali"], 2), ("gu", ["Gujarati"], 2),
           ("pa", ["Gurmukhi"], 2), ("ta", ["Tamil"], 2), ("te", ["Telugu"], 2), ("kn", ["Kannada"], 2), ("ml", ["Malayalam"], 2),
           ("ka", ["Georgian"], 2), ("hy", ["Armenian"], 2)]
# What stands between words.
BETWEEN = ".,;:!?()[]{}<>/|\\\"'`´’‘“”„«»…–—-_*+=&%#@~^0123456789\n\r\t\u00a0"

MIN_SHARE = 25        # words: one in so many must be a function word
MOST_WORDS = 150      # words: long texts count as so many distinct words, as function words repeat
WORD_UNIT = 840       # words: a word of n languages weighs WORD_UNIT / n
MIN_WORDS = 2         # words: the best language has at least so many units
AHEAD = 2             # words: and so many times the second's
SCALE = 10            # grams: whole numbers a natural logarithm
GRAMS = 260           # grams a language keeps
COMMON = 16           # grams: what more languages keep tells nothing and is left out
LEAD = 25             # grams: points between the best and the second
KNOWN = 5             # grams: points that the best has per distinct gram of the text
UNSEEN = 0.25         # grams: count of one that a sample doesn't hold
PACKED, FIELD = 3, 21     # sums packed in a long, bits each; the weights of all items together fit
BUCKETS = 1 << 12
LANGUAGES = sorted(PROFILE_WORDS)


@functools.cache
def word_rows() -> list[tuple[str, str, int]]:
    """(lang, word, weight), in language then word order."""
    users = Counter(w for words in PROFILE_WORDS.values() for w in set(words.split()))
    return [(lang, w, WORD_UNIT // users[w]) for lang in LANGUAGES for w in sorted(set(PROFILE_WORDS[lang].split()))]


def _grams_of(words: list[str]) -> list[str]:
    text = f" {' '.join(words)} "
    return [text[k:k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1) if text[k:k + n] != " "]


@functools.cache
def gram_rows() -> list[tuple[str, str, int]]:
    """(lang, gram, weight): the rule of the gram profile."""
    mean = {1: 250, 2: 300, 3: 300}     # so that languages with longer samples have no advantage
    kept = []
    for lang in LANGUAGES:
        words = re.findall(r"[^\W\d_]+", f"{SAMPLES[lang]} {PROFILE_WORDS[lang]}")
        counts = Counter(_grams_of(words))
        total = {n: sum(c for g, c in counts.items() if len(g) == n) for n in (1, 2, 3)}
        rows = [(lang, g, round(SCALE * math.log(1 + c * mean[len(g)] / total[len(g)] / UNSEEN))) for g, c in counts.items()]
        kept += sorted(sorted(rows, key=lambda r: (-counts[r[1]] * len(r[1]), r[1]))[:GRAMS])  # noqa: B023
    users = Counter(g for _, g, _ in kept)
    return [r for r in kept if users[r[1]] <= COMMON]


def _spaced(text: Column) -> Column:
    return F.translate(F.lower(text), BETWEEN, " " * len(BETWEEN))


def _packed(rows: list[tuple[str, str, int]]) -> str:
    """(lang, item, weight) rows as JSON: per bucket its items with their packed weights."""
    weights: dict[str, list[int]] = {}
    for lang, item, weight in rows:
        weights.setdefault(item, [0] * len(LANGUAGES))[LANGUAGES.index(lang)] = weight
    out: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for item, row in sorted(weights.items()):
        fields = [sum(w << FIELD * k for k, w in enumerate(row[at:at + PACKED])) for at in range(0, len(row), PACKED)]
        out[zlib.crc32(item.encode()) % BUCKETS].append({"x": item, "w": fields})
    return json.dumps(out, ensure_ascii=True)


def _ranked(items: Column, rows: list[tuple[str, str, int]], accept) -> Column:
    """The code that ``accept`` takes, from the distinct ``items`` of a text.
    ``accept`` gets the hits and struct<code, best, second> and gives a condition."""
    table = F.from_json(F.lit(_packed(rows)), "array<array<struct<x:string,w:array<bigint>>>>")
    known = F.split(F.lit("\n".join(sorted({x for _, x, _ in rows}))), "\n")
    n = -(-len(LANGUAGES) // PACKED)
    codes = F.split(F.lit(" ".join(LANGUAGES)), " ")

    def add(acc: Column, item: Column) -> Column:
        row = F.filter(F.get(table, (F.crc32(item) % BUCKETS).cast("int")), lambda e: e["x"] == item)[0]["w"]
        return F.zip_with(acc, row, lambda a, b: a + b)

    def score(sums: Column) -> Column:
        return F.transform(codes, lambda code, k: F.struct(
            (-F.call_function("shiftright", F.get(sums, F.floor(k / PACKED).cast("int")), (k % PACKED) * FIELD)
             .bitwiseAND((1 << FIELD) - 1)).alias("minus"), code.alias("lang")))

    def of_hits(hits: Column) -> Column:
        sums = F.aggregate(hits, F.array_repeat(F.lit(0).cast("bigint"), n), add)
        best = let(let(sums, score), lambda r: let(F.array_min(r), lambda top: F.struct(
            top["lang"].alias("code"), (-top["minus"]).alias("best"),
            (-F.array_min(F.filter(r, lambda x: x["lang"] != top["lang"]))["minus"]).alias("second"))))
        return F.when(F.size(hits) > 0, let(best, lambda b: F.when(accept(hits, b), b["code"])))

    return let(F.array_intersect(items, known), of_hits)


def _by_words(words: Column) -> Column:
    """Code by function words, or NULL."""
    return let(F.array_distinct(words), lambda items: _ranked(items, word_rows(), lambda hits, b: (
        F.size(hits) * MIN_SHARE >= F.least(F.size(items), F.lit(MOST_WORDS))) & (b["best"] >= MIN_WORDS * WORD_UNIT) & (b["best"] >= b["second"] * AHEAD)))


def _by_grams(spaced: Column) -> Column:
    """Code by naive Bayes over distinct 1- to 3-grams, or NULL."""
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(spaced, r"[^\p{L}\p{M}]+", " ")), F.lit(" "))
    grams = let(text, lambda t: F.array_distinct(F.array_remove(F.concat(*[
        F.regexp_extract_all(t, F.lit(f"(?=({'.' * k}))"), F.lit(1)) for k in (1, 2, 3)]), " ")))
    return let(grams, lambda items: _ranked(items, gram_rows(), lambda hits, b: (
        b["best"] - b["second"] >= LEAD) & (b["best"] >= F.size(items) * KNOWN)))


def _script_tag(text: Column) -> Column:
    """The language of the first script with its share of the letters, or NULL."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    tag = F.lit(None).cast("string")
    for lang, names, share in reversed(SCRIPTS):
        own = F.length(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}]", ""), f"[^{_class(names, 'Is')}]", ""))
        tag = F.when(own * share >= F.greatest(letters, F.lit(1)), F.lit(lang)).otherwise(tag)
    return tag


def _class(names: list[str], prefix: str = "") -> str:
    return "".join(rf"\p{{{prefix}{n}}}" for n in names)


# no letter of these scripts is below U+0370: one comparison spares Latin text the look-up of each script
_ANY_SCRIPT = r"[\x{370}-\x{10FFFF}&&[" + "".join(_class(names, "Is") for _, names, _ in SCRIPTS) + "]]"


def language_tag(text: Column) -> Column:
    """Language code of ``text``, NULL where none is certain enough.

    Each step runs only on texts that the one before it left open; spaced text
    and words are computed once and bound with :func:`let`."""
    def of_spaced(spaced: Column) -> Column:
        words = F.array_remove(F.split(spaced, " "), "")
        return F.coalesce(let(words, _by_words), _by_grams(spaced))

    return F.coalesce(F.when(text.rlike(_ANY_SCRIPT), _script_tag(text)), let(_spaced(text), of_spaced))


def _values(rows: list[tuple[str, str, int]], name: str) -> str:
    listed = ", ".join(f"('{lang}', '{item}', {weight})" for lang, item, weight in rows)
    return f"(VALUES {listed}) AS {name}(lang, item, weight)"


def language_tag_sql(source: str, id_col: str, text_col: str, id_alias: str = "id") -> str:
    """DuckDB query giving (id_alias, lang_detected) for every row of ``source``."""
    words = ", ".join(f"'{w}'" for w in sorted({w for _, w, _ in word_rows()}))
    between = BETWEEN.replace("'", "''")
    letters = rf"regexp_replace(s.{text_col}, '[^\p{{L}}]', '', 'g')"
    script = "".join(
        rf"""WHEN length(regexp_replace({letters}, '[^{_class(names)}]', '', 'g')) * {share} >= greatest(length({letters}), 1)
            THEN '{lang}' """ for lang, names, share in SCRIPTS)
    ranked = lambda hits, rows: f"""
        SELECT id, lang AS code, score AS best, coalesce(lead(score) OVER (PARTITION BY id ORDER BY score DESC, lang), 0) AS second,
               row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS rn
        FROM (SELECT h.id, p.lang, sum(p.weight) AS score FROM {hits} h JOIN {rows} ON p.item = h.item GROUP BY h.id, p.lang)"""  # noqa: E731
    return f"""
        SELECT s.{id_col} AS {id_alias}, CASE {script} ELSE coalesce(bw.code, bg.code) END AS lang_detected
        FROM {source} s
        LEFT JOIN (
            WITH t AS MATERIALIZED (SELECT {id_col} AS id, [x FOR x IN string_split(translate(lower({text_col}), '{between}', '{" " * len(BETWEEN)}'), ' ')
                                               IF x <> ''] AS w FROM {source}),
            h AS (SELECT id, unnest(list_distinct([x FOR x IN w IF x IN ({words})])) AS item FROM t
                  WHERE len(list_distinct([x FOR x IN w IF x IN ({words})])) * {MIN_SHARE} >= least(len(list_distinct(w)), {MOST_WORDS}))
            SELECT id, code FROM ({ranked("h", _values(word_rows(), "p"))})
            WHERE rn = 1 AND best >= {MIN_WORDS * WORD_UNIT} AND best >= second * {AHEAD}) bw ON bw.id = s.{id_col}
        LEFT JOIN (
            WITH t AS (SELECT {id_col} AS id, concat(' ', trim(regexp_replace(translate(lower({text_col}), '{between}', '{" " * len(BETWEEN)}'),
                              '[^\\p{{L}}\\p{{M}}]+', ' ', 'g')), ' ') AS s FROM {source} WHERE {text_col} IS NOT NULL),
            g AS MATERIALIZED (SELECT id, list_distinct([x FOR x IN list_concat([s[i:i] FOR i IN range(1, len(s) + 1)],
                         [s[i:i + 1] FOR i IN range(1, len(s))], [s[i:i + 2] FOR i IN range(1, len(s) - 1)]) IF x <> ' ']) AS g FROM t),
            h AS (SELECT id, unnest(g) AS item FROM g)
            SELECT r.id, code FROM ({ranked("h", _values(gram_rows(), "p"))}) r JOIN g USING (id)
            WHERE rn = 1 AND best - second >= {LEAD} AND best >= len(g.g) * {KNOWN} AND best > 0) bg ON bg.id = s.{id_col}"""
