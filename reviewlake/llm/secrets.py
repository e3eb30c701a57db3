"""Operator 8: secret scan with a random forest that removes false positives.

Candidates are, in every document,

- runs of at least ``MIN_LENGTH`` characters A-Z a-z 0-9 + / = _ - with a
  digit, and the like that follow after a "." (at least six characters, up to
  ``PARTS`` of them; what follows then is a run of its own);
- runs that begin as a known kind of key does, with or without a digit (the
  parts of a JSON web token are one run);
- what is assigned to a name with a word of ``SECRET_WORDS`` (=, : or =>):
  at least ``MIN_VALUE`` characters up to a space, quote or separator, with or
  without a digit; and runs of ``MIN_LENGTH`` after "bearer".

Each gets features of

- its length and character classes;
- its character transitions: changes of class, and the mean log probability
  of its letter pairs under the words of the corpus;
- dictionary coverage: the share of it made of letter runs that are words of
  the corpus (in at least ``MIN_DOCS`` places, counted over all documents);
- the path it was found under (hashed, and whether it stands in a URL or path);
- the neighbouring words (hashed), quotes and assignment signs beside it.

A random forest (``pyspark.ml``) is trained on labelled findings and keeps a
candidate if its probability of a secret is at least 0.5. Without a labelled
set, ``weak_labels`` labels findings by format rules of high precision; the
forest then carries the labels over to findings that the rules can't see.

The fit uses at most about ``TRAIN_ROWS`` labelled findings, chosen by hash;
the dictionary and the letter pairs come from all documents, every text is
scanned whole. Only DataFrame functions and ``pyspark.ml`` run: no Python on
the executors.

Defined results: null and empty texts have no finding; repeated rows have
their findings repeated; null doc_id and null paths are kept as they are; if
the labels are all of one kind, every candidate scores 0.5 and is kept; an
empty table gives an empty table. Secrets are returned masked: their first
four characters, length and SHA-256.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.common import let
from reviewlake.llm.common import crc_of, hash_fraction, written
from reviewlake.session import table

MIN_LENGTH = 12
MIN_DOCS = 5
TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 6
CONTEXT = 48             # characters looked at on either side
MIN_VALUE = 4            # characters of an assigned value
PARTS = 32               # parts between dots of one run; Java's matcher recurses once for each
SECRET_WORDS = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential"
_RUN = "[A-Za-z0-9+/=_-]"
_VALUE = rf"[^\s\"'`<>,;&(){{}}\[\]]{{{MIN_VALUE - 1},}}[^\s\"'`<>,;&(){{}}\[\].!?:]"
_NAME = rf"(?i:{SECRET_WORDS})[\w-]{{0,16}}"
KNOWN = (rf"(?:AKIA|ASIA)[A-Z0-9]{{16}}(?!{_RUN})|(?:gh[oprsu]_|github_pat_|glpat-|xox[abeoprs]-|[prsw]k_live_|AIza|npm_|hf_){_RUN}{{16,}}"
         rf"|(?:eyJ|SG\.){_RUN}{{8,}}(?:\.{_RUN}{{6,}}){{0,{PARTS}}}")
CANDIDATE = (rf"(?<!{_RUN})(?:"
             rf"(?<=[:=>]\s{{0,2}}[\"'`]?)(?<={_NAME}[\"']?\s{{0,2}}[:=]{{1,2}}>?\s{{0,2}}[\"'`]?){_VALUE}"
             rf"|[\w-]++={{1,2}}(?<={_NAME}={{1,2}}){_VALUE}"
             rf"|{KNOWN}"
             rf"|(?<=(?i:bearer)\s){_RUN}{{{MIN_LENGTH},}}"
             rf"|(?={_RUN}*[0-9]){_RUN}{{{MIN_LENGTH},}}(?:\.(?={_RUN}*[0-9]){_RUN}{{6,}}){{0,{PARTS}}})")
NAMED = rf"(?i)^[\w-]*(?:{SECRET_WORDS})[\w-]{{0,16}}={{1,2}}"
NUMBERS = ["length", "upper", "lower", "digit", "other", "distinct", "changes", "pairs", "coverage",
           "in_path", "in_url", "assigned", "quoted", "keyword"]
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source") -> DataFrame:
    """(doc_id, path, nth, found, left, right): every candidate with its surroundings."""
    whole = F.col(f"`{text}`")

    def near(hits: Column) -> Column:
        # texts without a candidate aren't cut
        return F.when(F.size(hits) > 0, let(F.split(whole, CANDIDATE, -1), lambda pieces: F.transform(hits, lambda c, i: F.struct(
            i.alias("nth"), c.alias("found"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("right")))))

    hits = F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0))
    return (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{path}`").alias("path"), F.explode(let(hits, near)).alias("c"))
            .select("doc_id", "path", "c.*"))


def corpus_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): lower-case words of 3 to 24 letters a-z and their places."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit("[a-z]{3,24}"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS)


def letter_pairs(words: DataFrame) -> Column:
    """Map from letter pair to its log probability after the first letter; at
    most 26 * 26 entries."""
    pairs = words.select(F.col("n"), F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    rows = pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()
    total: dict[str, int] = {}
    for r in rows:
        total[r.pair[0]] = total.get(r.pair[0], 0) + r.n
    from math import log
    known = [x for r in rows for x in (F.lit(r.pair), F.lit(log((r.n + 1) / (total[r.pair[0]] + 26))))]
    return F.create_map(*known) if known else F.create_map(F.lit(""), F.lit(0.0))


def _share(kept: str) -> Column:
    return F.length(F.regexp_replace("found", f"[^{kept}]", "")) / F.length("found")


def _word_beside(side: str, pattern: str) -> Column:
    word = F.lower(F.regexp_extract(side, pattern, 1))
    return F.when(word == "", None).otherwise(word)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns ``NUMBERS``, left_word, right_word and path_word."""
    found = found.withColumn("id", F.struct("doc_id", "nth", F.xxhash64("path", "found", "left", "right").alias("h")))
    runs = found.select("id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("found"), F.lit("[a-z]{3,24}"), F.lit(0)))).alias("word"))
    covered = (runs.distinct().join(words.select("word"), "word").groupBy("id")
               .agg(F.collect_list("word").alias("known")))
    pairs = letter_pairs(words)
    low = F.lower("found")
    seen = F.transform(F.sequence(F.lit(1), F.length("found") - 1), lambda i: F.coalesce(
        F.try_element_at(pairs, F.substring(low, i, F.lit(2))), F.lit(-8.0)))
    kinds = F.translate("found", _UPPER + _LOWER + _DIGIT, "A" * 26 + "a" * 26 + "0" * 10)
    both = found.join(covered, "id", "left")
    left_of_runs = F.regexp_extract_all(low, F.lit("[a-z]{3,24}"), F.lit(0))
    known = F.coalesce(F.col("known"), F.array().cast("array<string>"))
    return both.select(
        "id", "doc_id", "path", "nth", "found", "left", "right",
        F.length("found").cast("double").alias("length"), _share("A-Z").alias("upper"), _share("a-z").alias("lower"),
        _share("0-9").alias("digit"), _share("+/=_-").alias("other"),
        (F.size(F.array_distinct(F.split("found", ""))) / F.length("found")).alias("distinct"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.length("found")).alias("changes"),
        (F.aggregate(seen, F.lit(0.0), lambda a, x: a + x) / (F.length("found") - 1)).alias("pairs"),
        (F.aggregate(F.filter(left_of_runs, lambda w: F.array_contains(known, w)), F.lit(0), lambda a, w: a + F.length(w))
         / F.length("found")).alias("coverage"),
        F.col("found").rlike("^/|/.*/").cast("double").alias("in_path"),
        F.col("left").rlike(r"://\S*$").cast("double").alias("in_url"),
        (F.col("left").rlike(r"[=:]\s*[\"']?$") | F.col("found").rlike("^[A-Za-z_-]+=")).cast("double").alias("assigned"),
        F.col("left").rlike(r"[\"']$").cast("double").alias("quoted"),
        (F.col("left").rlike(rf"(?i)({SECRET_WORDS})\W{{0,6}}$") | F.col("found").rlike(NAMED)).cast("double").alias("keyword"),
        _word_beside("left", r"(\p{L}+)[^\p{L}]*$").alias("left_word"),
        _word_beside("right", r"^[^\p{L}]*(\p{L}+)").alias("right_word"),
        F.lower("path").alias("path_word"))


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 known secret formats, 0 known harmless ones
    (digits only, dates, runs of words), null where no rule speaks."""
    value = F.regexp_replace("found", NAMED, "")
    named = F.col("keyword") == 1
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    secret = value.rlike(rf"^(?:{KNOWN})$") | (named & mixed & (F.length(value) >= 16))
    harmless = value.rlike(r"^[0-9_/+=-]+$") | value.rlike(r"^\d{4}-\d{2}-\d{2}") | (F.col("coverage") >= 0.6)
    return found.withColumn("label", F.when(secret, 1.0).when(harmless | (F.col("in_url") == 1), 0.0))


def assembled(rows: DataFrame) -> DataFrame:
    hashed = FeatureHasher(inputCols=["left_word", "right_word", "path_word"], outputCol="words", numFeatures=256)
    return VectorAssembler(inputCols=[*NUMBERS, "words"], outputCol="features").transform(hashed.transform(rows))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """Forest of the labelled findings (column ``label``), None without both kinds."""
    known = labelled.where("label IS NOT NULL")
    n, secrets = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < secrets < n:
        return None
    some = known.where(hash_fraction(F.col("id")) * n < rows)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7)
    return forest.fit(written(some, "findings").transform(assembled).select("features", "label"))


def scored(rows: DataFrame, model) -> DataFrame:
    """``rows`` of findings with ``score`` and ``kept``."""
    if model is None:
        judged = rows.withColumn("score", F.lit(0.5))
    else:
        judged = model.transform(assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    return judged.withColumn("kept", F.col("score") >= 0.5)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all documents; labels by rule, learned where crc32(doc_id as
    text) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    words = written(corpus_words(docs), "words")
    found = written(features(written(candidates(docs), "candidates"), words), "features")
    model = train(weak_labels(found).where(crc_of(F.col("doc_id")) % 5 != 0))
    return scored(found, model).select(
        "doc_id", "nth", F.left("found", F.lit(4)).alias("begins"), F.length("found").alias("length"),
        F.sha2("found", 256).alias("sha256"), (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "kept")
