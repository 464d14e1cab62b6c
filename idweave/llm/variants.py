"""Spelling variants: words that are one edit apart, each under the common spelling it stands near.

Method: permuterm rotations. Of every word, marked with a terminator, all rotations are made. Put the
edited character last and it can be left open: words that differ by one replaced character share the rotation
that ends before it, and a word with one character more than another shares that prefix with the other's whole rotation. So each
word gives its whole rotations and their prefixes that skip the last character; all are sorted over ranges, equal ones lie together, and a
scan of the groups finds the neighbours. A group holds at most one whole rotation (a rotation tells its word) and one
word for each letter of the alphabet, so no group grows with the data.

A pair that differs by one letter of a run of equal letters meets at several rotations; only the last letter of the
run counts. Each pair of neighbours thus meets once, and what the groups report can be added up.

A word's form is its neighbour of largest count, if that is ``ratio`` times its own at least; the smaller word in code-point
order wins a tie. Counts grow along forms, so following them ends: at the word's root.

Null and empty texts have no words. Very long texts are scanned whole; a repeated row counts again. Further columns are left
alone, whatever their names. Words with a null or repeated entry in a table of counts are the caller's fault and raise no error: nulls
are dropped, repeated ones added up. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.runtime import Workspace

#: Runs of these characters are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: No letter, and so in no word.
TERMINATOR = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, text: str = "text", id: str = "doc_id", least: int = 1) -> DataFrame:
    """``id, word``: the runs of letters of each text with at least ``least`` characters, A to Z in lower case."""
    runs = docs.select(F.col(id).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0))).alias("word"))
    runs = runs.where(F.length("word") >= least)
    # Of a run, only these letters have a lower case beside that of A to Z.
    wide = F.col("word").rlike("[À-Þ]")
    return runs.withColumn("word", F.when(wide, F.translate("word", UPPER, LOWER)).otherwise(F.lower("word")))


def counted(words: DataFrame, least: int = 5) -> DataFrame:
    """``word, n`` of the words that occur ``least`` times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _rotations(counts: DataFrame) -> DataFrame:
    """``key, member``: each whole rotation, and each rotation without its last character where that is no terminator."""
    word, size = F.col("word"), F.length("word")
    cut = lambda at, skip: F.concat(F.substring(word, at + 1 + skip, size), F.lit(TERMINATOR), F.substring(word, F.lit(1), at))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(cut(i, 0).alias("key"), F.lit(True).alias("whole"), F.lit(True).alias("last")))
    last = lambda i: F.substring(word, i + 1, F.lit(1)) != F.substring(word, i + 2, F.lit(1))
    open_ = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(cut(i, 1).alias("key"), F.lit(False).alias("whole"), last(i).alias("last")))
    rows = counts.where("length(word) > 0").select("word", "n", F.explode(F.concat(whole, open_)).alias("r"))
    return rows.select("r.key", F.struct((-F.col("n")).alias("less"), "word", "r.whole", "r.last").alias("member"))


def neighbours(counts: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n``: how many words of ``counts`` (``word, n``) are one edit away, and the one of largest count.
    Words without neighbours are left out."""
    keys = _rotations(counts).repartitionByRange("key").sortWithinPartitions("key")
    # Bounded by the alphabet, see above. Sorted: largest count first, ties by word.
    groups = keys.groupBy("key").agg(F.sort_array(F.collect_list("member")).alias("members")).where(F.size("members") > 1)
    scanned = groups.select("members", F.explode("members").alias("own"))

    def meets(other: Column) -> Column:
        indel = F.col("own.whole") | other["whole"]
        return (other["word"] != F.col("own.word")) & (~indel | (F.col("own.last") & other["last"]))

    near = scanned.select("own.word", F.filter("members", meets).alias("near")).where(F.size("near") > 0)
    near = near.select("word", F.size("near").cast("long").alias("n_near"), F.struct(F.col("near")[0]["less"].alias("less"), F.col("near")[0]["word"].alias("word")).alias("first"))
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("first").alias("first"))
    return best.select("word", "n_near", F.col("first.word").alias("near"), (-F.col("first.less")).alias("near_n"))


def _roots(links: DataFrame, work: Workspace) -> DataFrame:
    """``word, root`` of links ``word, root`` that lead from word to word: each is followed to its end.

    Links are doubled: a round takes every word as far again as it had come. Counts grow by ``ratio`` with each step, so
    there are few."""
    step = 0
    while True:
        links = work.store(links, f"roots{step}")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(onward, "root", "left_semi").isEmpty():
            return links
        links = links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        step += 1


def spelling_groups(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of ``counts`` (``word, n``)."""
    if ratio < 2:
        raise ValueError("ratio is 2 or more, or forms could lead in circles")
    work = Workspace(counts.sparkSession)
    counts = counts.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    counts = work.store(counts, "counts")
    near = work.store(neighbours(counts), "near")
    common = F.col("near_n") >= ratio * F.col("n")
    met = counts.join(near, "word", "left").select(
        "word", F.when(common, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(common, F.col("near_n")).alias("form_n")
    )
    met = work.store(met, "forms")
    roots = _roots(met.where("form is not null").select("word", F.col("form").alias("root")), work)
    return met.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
