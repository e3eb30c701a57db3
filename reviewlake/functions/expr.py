"""Scalar column expressions. All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.common import let

# Fixed values.
HOTEL_KEY_PATTERN = r"g\d{4,}-d\d{5,}"          # first match in a URL is the hotel key
SITE_ROOT = "https://www.tripadvisor.ca/"        # root the next-page href is appended to
REVIEW_PREFIX = " wrote a review "               # removed from the review header before parsing
RESPONSE_PREFIX = "Response from "               # removed from the responder name
CLASS_SUFFIX = " of 5 bubbles"                   # removed from the class rating title
PROFILE_PREFIX = "/Profile/"                     # removed from the user link
UNKNOWN_MONTH = "00-0000"                        # review date when none can be parsed
NULL_LANG = "null"                               # path part for a missing language
MONTH_FORMAT = "MM-yyyy"
# Month names; an unambiguous beginning of three letters or more counts too ("sept", "déc").
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
    "sv": "januari februari mars april maj juni juli augusti september oktober november december",
}
# Words of a date without meaning for its month.
DATE_FILLERS = ["de", "del", "of", "the", "le", "den", "der", "am", "on"]
# Relative phrases: what makes one, numbers in words, units.
AGO = ["ago", "vor", "hace", "fa", "há", "geleden", "sedan", "il y a"]
ONE = ["a", "an", "one", "ein", "eine", "einem", "einer", "un", "une", "una", "uno", "um", "uma", "een", "en", "ett"]
UNITS = {
    "hour": "second seconds minute minutes hour hours sekunde sekunden minuten stunde stunden heure heures hora horas ora ore minuto minuti "
            "minutos uur minut minuter timme timmar seconde secondes",
    "day": "day days tag tage tagen jour jours día días giorno giorni dia dias dag dagen dagar",
    "week": "week weeks woche wochen semaine semaines semana semanas settimana settimane weken vecka veckor",
    "month": "month months monat monate monaten mois mes meses mese mesi mês maand maanden månad månader",
    "year": "year years jahr jahre jahren an ans année années año años anno anni ano anos jaar jaren år",
}
NOW = ["today", "now", "just now", "heute", "aujourd'hui", "hoy", "oggi", "hoje", "vandaag", "idag"]
YESTERDAY = ["yesterday", "gestern", "hier", "ayer", "ieri", "ontem", "gisteren", "igår"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hotel_id(url: Column | str) -> Column:
    """Hotel key from a URL, NULL if none."""
    return F.nullif(F.regexp_extract(_c(url), HOTEL_KEY_PATTERN, 0), F.lit(""))


def bubble_rating(cls: Column | str) -> Column:
    """``'ui_bubble_rating bubble_45'`` -> ``'4.5'``; empty or NULL -> NULL."""
    c = _c(cls)
    val = F.concat(F.substring(F.right(c, F.lit(2)), 1, 1), F.lit("."), F.right(c, F.lit(1)))
    return F.when(F.coalesce(F.length(c), F.lit(0)) > 0, val)


def _month_words() -> dict[int, list[str]]:
    """Month number -> its names and their beginnings of three letters or more that no other month shares."""
    of: dict[str, set[int]] = {}
    for names in MONTHS.values():
        for number, name in enumerate(names.split(), 1):
            for k in range(3, len(name) + 1):
                of.setdefault(name[:k], set()).add(number)
    full = {(name, n) for names in MONTHS.values() for n, name in enumerate(names.split(), 1)}
    return {n: sorted(w for w, ns in of.items() if ns == {n} or (w, n) in full) for n in range(1, 13)}


def _month_number(token: Column) -> Column:
    out = F.lit(None).cast("int")
    for number, words in _month_words().items():
        out = F.when(token.isin(words), F.lit(number)).otherwise(out)
    return out


def _calendar_date(text: Column, as_of: Column | None) -> Column:
    """First of the month that a date with a month name stands for: one month,
    at most one day and one year in any order; without a year the year of ``as_of``."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), r"[,.\s]+", " "), " "), lambda w: (w != "") & ~w.isin(DATE_FILLERS))

    def read(w: Column) -> Column:
        months = F.filter(F.transform(w, _month_number), lambda m: m.isNotNull())
        years = F.filter(w, lambda x: x.rlike("^[12][0-9]{3}$"))
        days = F.filter(w, lambda x: x.rlike("^(0?[1-9]|[12][0-9]|3[01])(st|nd|rd|th|er|º|ª)?$"))
        whole = (F.size(months) == 1) & (F.size(years) <= 1) & (F.size(days) <= 1) & (
            F.size(months) + F.size(years) + F.size(days) == F.size(w))
        year = F.get(years, 0).try_cast("int")
        if as_of is not None:
            year = F.coalesce(year, F.when(F.size(days) == 1, F.year(as_of)))
        return F.when(whole & year.isNotNull(), F.make_date(year, F.get(months, 0), F.lit(1)))

    return let(words, read)


def _numeric_date(text: Column) -> Column:
    """First of the month of ``yyyy-MM``, ``yyyy-MM-dd``, ``MM/yyyy`` and ``MM/dd/yyyy``."""
    def part(pattern: str, k: int) -> Column:
        return F.regexp_extract(text, pattern, k).try_cast("int")

    iso, us = r"^(\d{4})-(\d{2})(?:-(\d{2}))?$", r"^(\d{2})/(?:(\d{2})/)?(\d{4})$"
    year, month = F.coalesce(part(iso, 1), part(us, 3)), F.coalesce(part(iso, 2), part(us, 1))
    day = F.coalesce(part(iso, 3), part(us, 2), F.lit(1))
    return F.when(month.between(1, 12) & day.between(1, 31) & year.isNotNull(), F.make_date(year, month, F.lit(1)))


def _relative_date(text: Column, as_of: Column) -> Column:
    """Day of a phrase like ``3 weeks ago`` seen from ``as_of``; hours count as the day itself."""
    low = F.lower(F.trim(text))
    number = F.coalesce(F.regexp_extract(low, r"(\d+)", 1).try_cast("int"),
                        F.when(low.rlike(rf"(?:^|\s)({'|'.join(ONE)})\s"), F.lit(1)))
    n = F.when(low.rlike(rf"(?:^|\s)({'|'.join(AGO)})(?:\s|$)"), number)
    word = F.when(low.rlike(r"\d"), F.regexp_extract(low, r"\d+\s+(\S+)", 1)).otherwise(
        F.regexp_extract(low, rf"(?:^|\s)(?:{'|'.join(ONE)})\s+(\S+)", 1))
    of = lambda unit: word.isin(UNITS[unit].split())                          # noqa: E731
    return (F.when(low.isin(NOW) | (n.isNotNull() & of("hour")), as_of).when(low.isin(YESTERDAY), F.date_sub(as_of, 1))
            .when(of("day"), F.date_sub(as_of, n)).when(of("week"), F.date_sub(as_of, n * 7))
            .when(of("month"), F.add_months(as_of, -n)).when(of("year"), F.add_months(as_of, n * -12)))


def _month_from_text(text: Column, as_of: Column | None) -> Column:
    """Date in the month that a header text names: a calendar date with a month
    name of ``MONTHS``, a numeric date, or with ``as_of`` a date without year
    and a relative phrase (SURVEY D11: an explicit date, never the clock)."""
    t = F.trim(F.regexp_replace(text, r"[\s\u00a0]+", " "))
    forms = [_calendar_date(t, as_of), _numeric_date(t)]
    if as_of is not None:
        forms.append(_relative_date(t, as_of))
    return F.coalesce(*forms)


def review_month(header_fragments: Column | str, stay_fragments: Column | str | None = None,
                 as_of: Column | None = None, fallback_stay_date: bool = False) -> Column:
    """``MM-yyyy`` of the review, ``'00-0000'`` when unknown.

    The header must have exactly two text fragments; the second, without
    ``' wrote a review '``, is parsed. With ``fallback_stay_date`` (SURVEY D2,
    off by default as observed) a two-fragment stay date is used instead.
    """
    h = _c(header_fragments)
    raw = F.when(F.size(h) == 2, F.replace(F.get(h, 1), F.lit(REVIEW_PREFIX), F.lit("")))
    parsed = _month_from_text(raw, as_of)
    if fallback_stay_date and stay_fragments is not None:
        s = _c(stay_fragments)
        stay = F.when(raw.isNull() & (F.size(s) == 2), _month_from_text(F.get(s, 1), as_of))
        parsed = F.coalesce(F.when(raw.isNotNull(), parsed), stay)
    return F.coalesce(F.date_format(parsed, MONTH_FORMAT), F.lit(UNKNOWN_MONTH))


def process_date(raw: Column | str, as_of: Column | None = None) -> Column:
    """Month text of a header, or the input itself when unparsable."""
    r = _c(raw)
    parsed = _month_from_text(F.replace(r, F.lit(REVIEW_PREFIX), F.lit("")), as_of)
    return F.coalesce(F.date_format(parsed, MONTH_FORMAT), r)


def responder(text: Column | str) -> tuple[Column, Column]:
    """(name, title). Exactly two comma parts: name without ``Response from ``,
    title = second part up to ``' at'`` (leading space kept, SURVEY D14);
    otherwise (whole text, NULL); empty or NULL -> (NULL, NULL)."""
    t = F.nullif(_c(text), F.lit(""))
    parts = F.split(t, ",")
    two = F.size(parts) == 2
    name = F.when(t.isNull(), F.lit(None)).when(
        two, F.replace(F.get(parts, 0), F.lit(RESPONSE_PREFIX), F.lit(""))).otherwise(t)
    title = F.when(two, F.get(F.split(F.get(parts, 1), " at"), 0))
    return name, title


def class_rating(title: Column | str) -> Column:
    """E5: ``'4.5 of 5 bubbles'`` -> ``'4.5'``."""
    return F.replace(_c(title), F.lit(CLASS_SUFFIX), F.lit(""))


def join_fragments(frags: Column | str, empty_as_null: bool) -> Column:
    """Text fragments joined by newline; no fragment -> NULL (description)
    or ``''`` (review text)."""
    f = _c(frags)
    joined = F.array_join(f, "\n")
    if empty_as_null:
        return F.when(F.coalesce(F.size(f), F.lit(0)) > 0, joined)
    return F.coalesce(joined, F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    """E7."""
    return F.nullif(_c(c), F.lit(""))


def user_id(href: Column | str) -> Column:
    """First link of the review block without ``/Profile/``."""
    return F.replace(_c(href), F.lit(PROFILE_PREFIX), F.lit(""))


def response_flag(review_response: Column | str) -> Column:
    """``'Y'`` when the review has a non-empty response, else ``'N'``."""
    r = _c(review_response)
    return F.when(F.coalesce(F.length(r), F.lit(0)) > 0, F.lit("Y")).otherwise(F.lit("N"))


def review_key(review_response: Column | str, review_date: Column | str,
               id_user_: Column | str) -> Column:
    """``Y|N-<date>-<user>``; a missing part prints as ``None``."""
    return F.concat_ws("-", response_flag(review_response),
                       F.coalesce(_c(review_date), F.lit("None")),
                       F.coalesce(_c(id_user_), F.lit("None")))


def nth(arr: Column | str, i: int) -> Column:
    """Element ``i`` (0-based) or NULL."""
    return F.get(_c(arr), i)


def all_but_first(arr: Column | str) -> Column:
    """Popular mentions = every fragment after the first (empty stays empty)."""
    a = _c(arr)
    return F.when(F.size(a) > 1, F.slice(a, 2, F.size(a) - 1)).otherwise(
        F.array().cast("array<string>"))


def next_page_url(href: Column | str, root: str = SITE_ROOT) -> Column:
    """Site root + href; a rooted href does not give ``//``."""
    h = _c(href)
    return F.when(h.isNotNull(), F.concat(F.lit(root.rstrip("/")), F.lit("/"),
                                          F.regexp_replace(h, "^/+", "")))


def sitemap_file_id(file_name: Column | str) -> Column:
    """Text after the last ``-`` of the XML name, without ``.xml.gz``."""
    return F.replace(F.element_at(F.split(_c(file_name), "-"), -1), F.lit(".xml.gz"), F.lit(""))


def marker_name(xml_name: Column | str, start: Column | str) -> Column:
    """Marker file name of a sitemap file and a start index."""
    return F.concat(F.replace(_c(xml_name), F.lit(".xml.gz"), F.lit("_marker_")),
                    _c(start).cast("string"), F.lit(".txt"))


def url_list_name(xml_name: Column | str) -> Column:
    """Name of the extracted URL list."""
    return F.replace(_c(xml_name), F.lit(".xml.gz"), F.lit("_url.txt"))


def marker_start(name: Column | str) -> Column:
    """Start index in a marker name (no look-around, so DuckDB runs it too)."""
    return F.regexp_extract(_c(name), r"_marker_(.*?)\.txt", 1)


def lang_or_null(lang: Column | str) -> Column:
    """Language, or ``'null'`` when missing or empty."""
    return F.coalesce(F.nullif(_c(lang), F.lit("")), F.lit(NULL_LANG))


def object_key(hotel_key: Column | str, review_key_: Column | str) -> Column:
    """E16."""
    return F.concat_ws("-", _c(hotel_key), _c(review_key_))


def top_dir(prefix: Column | str) -> Column:
    """First part of a prefix."""
    return F.get(F.split(_c(prefix), "/"), 0)


def daily_file_name(run_date: Column | str) -> Column:
    """``en_reviews-DD-MM-YYYY.json`` of a run date (passed in, never the clock)."""
    return F.concat(F.lit("en_reviews-"), F.date_format(_c(run_date), "dd-MM-yyyy"), F.lit(".json"))


def chunk_file_name(chunk_id: Column | str) -> Column:
    return F.concat(F.lit("en_reviews_"), _c(chunk_id).cast("string"), F.lit(".json"))


def reject_file_name(worker_id: Column | str) -> Column:
    return F.concat(F.lit("bad_reviews"), _c(worker_id).cast("string"), F.lit(".json"))
