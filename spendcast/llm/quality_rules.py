"""Quality rules from distribution divergence, with DataFrame functions only.

Each document's histogram of character classes and of common words is compared
with its language's reference, taken over all documents, by Jensen-Shannon
distance (base 2, 0 to 1).  Guards leave short documents to the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACE_CLASS, SPACES, pin

#: Common words of a language's reference, and references up to which they are
#: broadcast (some 2 KB each).
COMMON_WORDS = 24
BROADCAST_REFERENCES = 2000
#: Distances above these fail a document.
MOST_CHAR_DISTANCE = 0.28
MOST_WORD_DISTANCE = 0.45
#: Documents below these are not judged by the distance of that kind.
LEAST_CHARS = 200
LEAST_WORDS = 100
LEAST_BASE_WORDS = 50

SYMBOLS = "#*$%&|<>"
_PUNCTUATION = ".,;:!?'\"()-"
CLASSES = ["c_letter", "c_upper", "c_space", "c_digit", "c_symbol", "c_punct", "c_other"]


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, not once per use."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _windows(words: Column) -> Column:
    """Hashes of the 3-word windows, in order."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                       lambda w, i: F.xxhash64(w, F.element_at(words, i + 2), F.element_at(words, i + 3)))


def _repeat_words(windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.  Only texts whose
    windows are not all distinct are sorted."""
    starts = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    twice = _let(F.sort_array(starts), lambda s: F.filter(s, lambda x, k:
                 (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = _let(places, lambda p: F.aggregate(
        p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"]))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def base_columns(docs: DataFrame) -> DataFrame:
    """doc_id, lang, t (the text), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, and the character classes behind them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text.alias("t"))
    # what is neither lower-case ASCII nor beyond ASCII is a small part of a text
    d = d.withColumn("rest", F.regexp_replace("t", r"[^\x00-\x60\x7B-\x7F]+", "")).withColumn("words", _words(F.col("t")))
    without = lambda chars: (F.length("rest") - F.length(F.translate("rest", chars, ""))).cast("long")
    lines = _let(F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                 lambda x: F.size(x) - F.size(F.array_distinct(x)))
    d = d.select(
        "doc_id", "lang", "t", _windows(F.col("words")).alias("windows"), F.size("words").cast("long").alias("n_words"), F.length("t").cast("long").alias("chars"),
        (F.length("t") - F.length("rest")).cast("long").alias("c_letter"), without(SPACES).alias("c_space"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("c_upper"), without("0123456789").alias("c_digit"),
        without(SYMBOLS).alias("c_symbol"), without(_PUNCTUATION).alias("c_punct"), lines.cast("long").alias("n_dup_lines"))
    named = [c for c in CLASSES if c != "c_other"]
    other = F.col("chars") - sum((F.col(c) for c in named[1:]), F.col(named[0]))
    d = d.withColumn("c_other", other).withColumn("word_chars", F.col("chars") - F.col("c_space"))
    d = d.withColumn("n_symbols", F.col("c_symbol")).withColumn("n_repeat_words", _repeat_words(F.col("windows")).cast("long")).drop("windows")
    failed = (F.col("n_words") < LEAST_BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def references(docs: DataFrame) -> DataFrame:
    """One row per language (null: all): character-class shares and the common
    words with their shares."""
    base = docs.select(F.col("lang").cast("string").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    rest = F.regexp_replace("t", r"[^\x00-\x60\x7B-\x7F]+", "")
    without = lambda chars: F.length("rest") - F.length(F.translate("rest", chars, ""))
    sums = [F.sum("chars").alias("chars"), F.sum(F.col("chars") - F.length("rest")).alias("c_letter"),
            F.sum(without(SPACES)).alias("c_space"), F.sum(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("c_upper"),
            F.sum(without("0123456789")).alias("c_digit"), F.sum(without(SYMBOLS)).alias("c_symbol"),
            F.sum(without(_PUNCTUATION)).alias("c_punct")]
    by_lang = pin(base.select("lang", F.length("t").alias("chars"), rest.alias("rest")).groupBy("lang").agg(*sums))
    names = ["chars", "c_letter", "c_space", "c_upper", "c_digit", "c_symbol", "c_punct"]
    whole = by_lang.agg(*[F.sum(c).alias(c) for c in names]).select(F.lit(None).cast("string").alias("lang"), *names)
    shares = by_lang.where("lang is not null").unionByName(whole)
    named = names[1:]
    other = F.col("chars") - sum((F.col(c) for c in named[1:]), F.col(named[0]))
    total = F.greatest(F.col("chars"), F.lit(1))
    shares = shares.withColumn("c_other", other).select("lang", F.array(*[F.col(c) / total for c in CLASSES]).alias("q_chars"))
    # the common words of each language and of all
    counts = pin(base.select("lang", F.explode(_words(F.col("t"))).alias("word")).groupBy("lang", "word").count())
    known = counts.where("lang is not null").unionByName(
        counts.groupBy("word").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("lang"), "word", "count"))
    totals = known.groupBy("lang").agg(F.sum("count").alias("total"))
    best = (known.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("count"), "word")))
            .where(F.col("r") <= COMMON_WORDS))
    q = (best.join(totals, best["lang"].eqNullSafe(totals["lang"])).select(best["lang"], "word", (F.col("count") / F.col("total")).alias("q"), "r")
         .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "word", "q"))).alias("q_words")))
    return pin(shares.join(q, shares["lang"].eqNullSafe(q["lang"]), "left").select(
        shares["lang"].alias("ref"), "q_chars", F.coalesce("q_words", F.array().cast("array<struct<r:int,word:string,q:double>>")).alias("q_words"))
        .withColumn("q_pattern", _pattern(F.col("q_words")["word"])))


def _pattern(words: Column) -> Column:
    """Regular expression of whole words that are one of ``words``; null for none."""
    literal = F.transform(words, lambda w: F.regexp_replace(w, r"[!-/:-@\[-`{-~]", r"\\$0"))
    return F.when(F.size(words) > 0, F.concat(F.lit(r"(?<!\S)(?:"), F.array_join(literal, "|"), F.lit(r")(?!\S)")))


def _js(p: Column, q: Column) -> Column:
    """One term of the Jensen-Shannon divergence, in bits."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def _distance(pq: Column) -> Column:
    """Jensen-Shannon distance of an array of (p, q)."""
    total = F.aggregate(pq, F.lit(0.0), lambda acc, x: acc + _js(x["p"], x["q"]))
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def distances(docs: DataFrame) -> DataFrame:
    """The base columns plus char_distance and word_distance (0 below the
    guards, and where the corpus gives no reference)."""
    refs = references(docs)
    if refs.count() <= BROADCAST_REFERENCES:
        refs = F.broadcast(refs)
    d = base_columns(docs).join(refs, F.col("lang").eqNullSafe(F.col("ref")), "left")
    p = F.array(*[F.struct((F.col(c) / F.greatest("chars", F.lit(1))).alias("p"), F.col("q_chars")[i].alias("q"))
                  for i, c in enumerate(CLASSES)])
    d = d.withColumn("hits", F.regexp_extract_all("t", F.col("q_pattern"), F.lit(0)))
    shares = _let(F.col("hits"), lambda hits: F.transform("q_words", lambda x: F.struct(
        ((F.size(hits) - F.size(F.array_remove(hits, x["word"]))) / F.greatest("n_words", F.lit(1))).alias("p"), x["q"].alias("q"))))
    rest = F.struct((1 - F.size("hits") / F.greatest("n_words", F.lit(1))).alias("p"),
                    (1 - F.aggregate("q_words", F.lit(0.0), lambda a, x: a + x["q"])).alias("q"))
    judged_words = (F.col("n_words") >= LEAST_WORDS) & (F.size("q_words") > 0)
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when((F.col("chars") >= LEAST_CHARS) & F.col("q_chars").isNotNull(), _distance(p)).otherwise(F.lit(0.0)).alias("char_distance"),
        F.when(judged_words, _distance(F.concat(shares, F.array(rest)))).otherwise(F.lit(0.0)).alias("word_distance"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: the base columns, base_failed, kept, and the two
    distances.

    Null and empty texts have no words and fail the base rules; a null
    language uses the reference of all documents; repeated rows are judged alike;
    an empty table gives an empty result."""
    far = (F.col("char_distance") > MOST_CHAR_DISTANCE) | (F.col("word_distance") > MOST_WORD_DISTANCE)
    return distances(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
