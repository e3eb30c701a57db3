"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double"
LONG = " ".join(f"wort{i % 977} und" for i in range(30_000))


def documents(spark, texts=None):
    """With extra columns named like those that operators use inside."""
    same = "the first line here\nand a second line\nand then a third\nthe end of it"
    rows = texts or [
        (1, same, "en", "b", 1), (2, same, "en", "b", 1), (2, same, "en", "b", 1), (2, "other words in the same document id", "en", "a", 1),
        (3, None, "en", "a", None), (4, "", "de", None, 0), (5, " \n\t \n ", "de", "a", 5), (6, "...!!! 123 456", None, "c", 3),
        (None, "a text without any id at all", "en", "c", 28), (None, None, None, None, None), (7, "wort", "de", "", 4),
        (8, LONG, "de", "b", len(LONG)), (9, "x\n" * 40, "en", "a", 80), (10, "une phrase en français très courte", "fr", "a", 3),
        (11, "eine kurze Zeile mit Wörtern und Ägypten", "de", "c", 3), (12, same + "\nmore", "en", "a", 9)]
    return spark.createDataFrame([(*r, "clash", 0.5) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
