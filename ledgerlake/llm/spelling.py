"""Spelling variants by permuterm rotations: each word's near words and the frequent form it belongs to.

A word ``w`` is marked with a terminator that no word holds, and all rotations of ``w$`` are
sorted. An edit at one place of a word is a wildcard there, and rotating the wildcard to the end
turns it into a prefix: the words ``x?y`` are those with a rotation ``y$x?``, so the words that
replace one character, and the word ``xy`` that drops it, lie in the range of the prefix ``y$x``.
A word enters the list under that prefix for each of its characters (the skipped character beside
it) and under each whole rotation (nothing skipped). Rows of one prefix are then exactly the words
``xy`` and ``xcy``: as many as the alphabet has letters at most, whatever the input holds, so no
group can grow with the data. One scan of the sorted groups emits a row per word and group, with
the number of near words and the best of them; pairs are never written out.

A replaced character shares one prefix with its partner. A character dropped from a run of equal
ones gives the same word at each place of the run, so an insertion counts only at the run's first.

Rows: a null text has no words, a null id is written as nothing before the colon. Repeated rows
count each time. Ties take the smallest word in code-point order. An empty table gives an empty
table. Only the two named columns are read.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import staged

RUN = "[A-Za-zÀ-ÿ]+"
MARK = "$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, damage: int, least_chars: int, least_n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the distinct runs of letters, ASCII letters lower-cased, of enough code points and occurrences.

    A run whose ``crc32('<id>:<run>')`` is divisible by ``damage`` loses the code point at that
    value modulo its length.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(key.alias("id"), F.explode(F.regexp_extract_all(F.translate(text_col, _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_chars)
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.substr("run", F.lit(1), at.cast("int")), F.substr("run", (at + 2).cast("int")))
    spelled = hashed.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelled.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def rotations(vocabulary: DataFrame) -> DataFrame:
    """prefix, skipped, n: for each place of a word its whole rotation, and the one that skips the character there."""
    at = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    head, rest = F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 1)
    entry = lambda tail, skipped: F.struct(F.concat(tail, F.lit(MARK), head).alias("prefix"), skipped.alias("skipped"))
    whole = entry(rest, F.lit(""))
    without = entry(F.substr("word", F.col("at") + 2), F.substr(rest, F.lit(1), F.lit(1)))
    entries = F.when(rest != "", F.array(whole, without)).otherwise(F.array(whole))
    return at.select("n", F.explode(entries).alias("e")).select("e.prefix", "e.skipped", "n")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n_near, best (struct of n and word): a row for each word that has a near one."""
    x, y = F.substring_index("prefix", MARK, -1), F.substring_index("prefix", MARK, 1)
    # Equal prefixes share a range of the sorted list, which the windows below scan in place.
    listed = rotations(vocabulary).repartitionByRange("prefix").withColumn("word", F.concat(x, F.col("skipped"), y))
    group = Window.partitionBy("prefix").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    has: Column = F.col("skipped") != ""
    first_of_run = ~F.endswith(x, F.col("skipped"))
    row = F.struct("n", "word")
    scanned = listed.withColumns({
        "first": F.first(row).over(group), "second": F.nth_value(row, 2).over(group),
        "replacing": F.count_if(has).over(group), "inserting": F.count_if(has & first_of_run).over(group),
        "dropping": F.count_if(~has).over(group),
    }).where(F.col("second").isNotNull())
    n_near = F.when(has, F.col("replacing") - 1 + F.when(first_of_run, F.col("dropping")).otherwise(0)).otherwise(F.col("inserting"))
    best = F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first"))
    seen = scanned.select("word", n_near.alias("n_near"), F.struct((-best["n"]).alias("minus_n"), best["word"].alias("word")).alias("best"))
    return seen.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """word, root: each word of ``forms`` (word, form, n) followed to the last form.

    A form occurs ``ratio`` times as often as its word, so a chain is as long as a logarithm; each
    round doubles how far a word has come.
    """
    most = forms.agg(F.max("form_n") / F.min("n")).first()[0] or 1
    steps = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log(max(2, log(most, ratio) + 1), 2))):
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = staged(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return steps


def variants(
    docs: DataFrame, damage: int = 199, least_chars: int = 6, least_n: int = 5, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word, n, n_near, form, form_n, root: a row per word of ``docs``; see the module for the method."""
    vocabulary = staged(words(docs, damage, least_chars, least_n, id_col, text_col), "words")
    near = vocabulary.join(near_words(vocabulary), "word", "left")
    form_n = -F.col("best.minus_n")
    found = F.when(form_n >= ratio * F.col("n"), F.struct(F.col("best.word").alias("form"), form_n.alias("form_n"))).alias("found")
    rows = staged(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), found).select("word", "n", "n_near", "found.form", "found.form_n"), "variants")
    last = roots(rows.where(F.col("form").isNotNull()).select("word", "n", "form", "form_n"), ratio)
    return rows.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
