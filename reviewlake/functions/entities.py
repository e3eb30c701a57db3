"""Character references of HTML: decoding, encoding."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named references: the standard library's HTML 4 table and ``&apos;``.
_NAMED = json.dumps({**{f"&{n};": chr(c) for n, c in name2codepoint.items()}, "&apos;": "'"}, ensure_ascii=True)
_REFERENCE = r"(?s)(&#[xX][0-9a-fA-F]{1,6};|&#[0-9]{1,7};|&[A-Za-z][A-Za-z0-9]{1,31};|[^&]+|&)"
_MAX_CODE_POINT = 0x10FFFF


def _code_point(n: Column) -> Column:
    """The character of a code point; U+FFFD for one that isn't a character."""
    ok = n.between(1, _MAX_CODE_POINT) & ~n.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def _reference(t: Column) -> Column:
    number = (F.when(F.lower(t).startswith("&#x"), F.conv(F.regexp_extract(t, "([0-9a-fA-F]+);$", 1), 16, 10))
              .otherwise(F.regexp_extract(t, "([0-9]+);$", 1))).cast("long")
    return (F.when(t.startswith("&#") & (F.length(t) > 3), _code_point(number))
            .when(t.startswith("&"), F.coalesce(F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), t), t))
            .otherwise(t))


def decode_entities(c: Column) -> Column:
    """Decode named, decimal and hexadecimal character references, each once
    (``&amp;lt;`` becomes ``&lt;``); an unknown name stays as it is."""
    return F.when(c.contains("&"), F.array_join(F.transform(
        F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(1)), _reference), "")).otherwise(c)


def encode_entities(c: Column) -> Column:
    """Inverse of :func:`decode_entities` for ``& < > "`` (used when rendering)."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for ch, ent in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out
