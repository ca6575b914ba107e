"""Quality rules, with distribution divergence as the method's rule.

Per text: counts of words, symbols, repeated lines and words in repeated five-word windows, and
two histograms: character classes, and common words. Each histogram is compared with the
reference of the text's language by Jensen-Shannon distance (base 2, 0 … 1). References are
taken over all documents of a language: its class counts, and its ``COMMON_WORDS`` most frequent
words with their counts, ties in word order; other words share one bin. A text too short to
judge, below ``min_chars`` word characters or ``min_words`` words, passes the rule in question.

Everything is SQL functions on one row at a time, apart from the counts for the references,
which are pre-aggregated, and the join with the references. These are a stored table of one
row per language, broadcast only while Spark measures it below its threshold.

Null texts have no words and fail the base rule; texts without a language share a reference of
their own; repeated rows each give a row; extra columns are ignored; an empty table gives an
empty result. Work is linear in a text, but for sorting its windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Classes of characters within words besides a-z, as the characters that belong to each.
CLASSES = ("A-Z", "0-9", ".,;:!?'\"()-", "#*$%&|<>")
SYMBOLS = 4  # place of the last class among the counts, which begin with a-z and end with the rest
COMMON_WORDS = 32
#: Letters that stand for the places of common words.
PLACES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    min_chars: int = 200
    max_class_distance: float = 0.34
    max_word_distance: float = 0.5
    base_min_words: int = 10
    base_max_repeat: int = 20


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words_: Column) -> Column:
    """Words covered by windows of five words that occur twice or more."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))))

    def covered(places: Column) -> Column:
        """Each window covers up to where the next one starts, the last one all of its words."""
        steps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeats(sorted_: Column) -> Column:
        kept = F.filter(sorted_, lambda x, i: x["h"].eqNullSafe(F.get(sorted_, i - 1)["h"]) | x["h"].eqNullSafe(F.get(sorted_, i + 1)["h"]))
        return let(F.sort_array(F.transform(kept, lambda x: x["i"])), covered)

    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, repeats))

    hashes = F.transform(words_, lambda w: F.xxhash64(w))
    return F.when(F.size(words_) <= WINDOW, F.lit(0)).otherwise(let(hashes, lambda x: let(windows(x), counted)))


def class_counts(dense: Column) -> Column:
    """Characters of each class in the words of a text, joined: a-z, CLASSES, others.

    Letters a-z go first, in runs; the other classes are looked for in the little that is left.
    """

    def rest(left: Column) -> Column:
        counts = F.array(*(F.length(F.regexp_replace(left, f"[^{c}]+", "")) for c in CLASSES))
        return let(counts, lambda n: F.concat(F.array(F.length(dense) - F.length(left)), n, F.array(F.length(left) - _total(n))))

    return let(F.regexp_replace(dense, "[a-z]+", ""), rest)


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda a, b: a + b)


def word_counts(words_: Column, common: Column) -> Column:
    """How often each common word occurs; the last count is of other words."""
    letters = F.array(*map(F.lit, PLACES))
    # Common words in slots of one width: a word's position in this text tells its place.
    width = F.aggregate(common, F.lit(0), lambda n, w: F.greatest(n, F.length(w))) + 2

    def places(known: Column) -> Column:
        slots, wide = known["slots"], known["width"]
        short = F.filter(words_, lambda w: F.length(w) <= wide - 2)
        at = F.transform(short, lambda w: F.instr(slots, F.concat(F.lit(" "), w, F.lit(" "))))
        return F.array_join(F.transform(F.filter(at, lambda p: p > 0), lambda p: F.get(letters, F.floor((p - 1) / wide).cast("int"))), "")

    def count(found: Column) -> Column:
        each = [F.length(found) - F.length(F.replace(found, F.lit(p), F.lit(""))) for p in PLACES]
        return F.concat(F.array(*each), F.array(F.size(words_) - F.length(found)))

    def slots(wide: Column) -> Column:
        padded = F.transform(common, lambda w: F.rpad(F.concat(F.lit(" "), w), wide, " "))
        return F.struct(F.concat(F.array_join(padded, ""), F.lit(" ")).alias("slots"), wide.alias("width"))

    return let(let(width, slots), lambda known: let(places(known), count))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts over the same bins."""

    def share(x: Column) -> Column:
        total = F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)
        return let(total, lambda t: F.transform(x, lambda v: F.when(t == 0, F.lit(0.0)).otherwise(v / t)))

    def half(p: Column, q: Column) -> Column:
        return F.when(p == 0, F.lit(0.0)).otherwise(p * F.log2(2 * p / (p + q)) / 2)

    terms = F.zip_with(share(counts.cast("array<bigint>")), share(reference), lambda p, q: half(p, q) + half(q, p))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.struct("*").alias("row"), F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"))
    # Words are cut once: the row generator keeps later expressions from cutting them again.
    return rows.select("row", "lang", "text", F.explode(F.array(words(F.col("text")))).alias("words"))


def language_references(documents: DataFrame) -> DataFrame:
    """lang, classes, common (words, most frequent first) and word_totals, over all documents."""
    rows = _texts(documents)
    each = rows.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    each = stored(each, "word_counts")
    # Classes are counted in each different word, for all its occurrences.
    by_class = each.select("lang", "n", F.explode(F.array(class_counts(F.col("word")))).alias("c"))
    sums = [F.sum(F.get("c", F.lit(i)) * F.col("n")) for i in range(len(CLASSES) + 2)]
    classes = by_class.groupBy("lang").agg(F.array(*sums).alias("classes"))
    ranked = each.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
    top = ranked.filter(F.col("place") <= COMMON_WORDS).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    totals = each.groupBy("lang").agg(F.sum("n").alias("total"))
    common = top.join(totals, "lang").select("lang", F.transform("top", lambda x: x["word"]).alias("common"), F.transform("top", lambda x: x["n"]).alias("ns"), "total")
    filled = F.concat("ns", F.array_repeat(F.lit(0).cast("bigint"), F.lit(COMMON_WORDS) - F.size("ns")))
    rest = F.col("total") - F.aggregate("ns", F.lit(0).cast("bigint"), lambda a, b: a + b)
    totals_ = F.concat(filled, F.array(rest)).alias("word_totals")
    return stored(classes.join(common.select("lang", "common", totals_), "lang", "left"), "references")


def quality(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, distances and verdicts of every row of ``documents`` (doc_id, text, lang); ``row`` is the row itself."""
    references = language_references(documents)
    rows = _texts(documents).join(references, "lang", "left")
    empty = F.array().cast("array<string>")
    counts = F.struct(
        F.size("words").alias("n_words"),
        class_counts(F.array_join("words", "")).alias("by_class"),
        word_counts(F.col("words"), F.coalesce("common", empty)).alias("by_word"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    rows = rows.select("row", "classes", "word_totals", F.explode(F.array(counts)).alias("c"))
    counts = rows.select(
        "row",
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        F.col("c.n_words").cast("bigint").alias("n_words"),
        _total(F.col("c.by_class")).cast("bigint").alias("word_chars"),
        F.get("c.by_class", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.col("c.n_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("c.n_repeat_words").cast("bigint").alias("n_repeat_words"),
        js_distance(F.col("c.by_class"), F.col("classes")).alias("class_distance"),
        js_distance(F.col("c.by_word"), F.coalesce("word_totals", F.array_repeat(F.lit(0).cast("bigint"), COMMON_WORDS + 1))).alias("word_distance"),
    )
    failed = (F.col("n_words") < limits.base_min_words) | (100 * F.col("n_repeat_words") > limits.base_max_repeat * F.col("n_words"))
    odd_classes = (F.col("word_chars") >= limits.min_chars) & (F.col("class_distance") > limits.max_class_distance)
    odd_words = (F.col("n_words") >= limits.min_words) & (F.col("word_distance") > limits.max_word_distance)
    return counts.select(
        "row",
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "class_distance",
        "word_distance",
        failed.alias("base_failed"),
        (~failed & ~odd_classes & ~odd_words).alias("kept"),
    )
