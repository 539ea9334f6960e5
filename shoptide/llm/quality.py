"""Quality rules by the frequency of lines across the documents of a host, in DataFrame functions alone.

1. Each document's measures, and its lines: two hashes of host and normalised line (lower case, a 0 for every digit, runs of white
   space as one space), and the line's words. Settled, with a number for each row.
2. The different documents of each line and host are counted. A line that more than ``max_docs`` documents of its host have is removed
   wherever it stands in the host, also within the one document more often than once.
3. A document is kept if it passes the base rules and is not depleted: at least LEAST_WORDS words must be left, and no more
   than MOST_LOST percent of them be lost.

Hot lines: no more than HEAVY lines can have more than a HEAVY-th of all occurrences of removed lines. These are broadcast, so a
line that a third of all rows hold is never gathered; all others have a small share each and are joined by shuffle. Both ways
always run. Counting different documents shuffles by line and document first, then adds up counts.

Words that repeat are found inside each row: the hashes of the three-word windows, with their places in the low bits, are
sorted as numbers, and those that share the upper bits are compared in full. So nothing of the size of the text is shuffled.

Nulls and empty texts have no words and fail the base rules. A null host is a host of its own. A null id is one document. Rows that repeat an
id are one document when lines are counted, and each is measured and judged by its own text. Texts are taken whole.
Columns of the input that are named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.shared import settle

MAX_DOCS = 20
LEAST_WORDS = 50
MOST_REPEATED = 50
MOST_LOST = 50
HEAVY = 10_000

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
KEY = ["h1", "h2"]
PLACE_BITS = 30  # a text has fewer words than that many bits can number
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    bare = trimmed(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: trimmed(line) != "")


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(trimmed(line)), SPACE, " "), "[0-9]", "0")


def repeated_places(frame: DataFrame, words: str, out: str) -> DataFrame:
    """``frame`` with ``out``: the places of the three-word windows that stand in the row's ``words`` twice or more."""
    at = lambda i: F.get(words, i)
    upper = lambda x: F.shiftright(x, PLACE_BITS)
    window = lambda w, i: F.shiftleft(F.xxhash64(w, at(i + 1), at(i + 2)), PLACE_BITS).bitwiseOR(i.cast("long"))
    # a step a column: what several lambdas read is to be computed once
    frame = frame.withColumn("_sorted", F.sort_array(F.slice(F.transform(words, window), F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))))
    twin = lambda x, i: F.coalesce(upper(x) == upper(F.get("_sorted", i - 1)), F.lit(False)) | F.coalesce(upper(x) == upper(F.get("_sorted", i + 1)), F.lit(False))
    frame = frame.withColumn("_like", F.filter("_sorted", twin))
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    whole = lambda x: F.struct(F.concat_ws(" ", at(place(x)), at(place(x) + 1), at(place(x) + 2)).alias("words"), place(x).alias("place"))
    frame = frame.withColumn("_whole", F.sort_array(F.transform("_like", whole)))
    same = lambda x, i: F.coalesce(x["words"] == F.get("_whole", i - 1)["words"], F.lit(False)) | F.coalesce(x["words"] == F.get("_whole", i + 1)["words"], F.lit(False))
    frame = frame.withColumn(out, F.transform(F.filter("_whole", same), lambda x: x["place"]))
    return frame.drop("_sorted", "_like", "_whole")


def measured(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(row, base measures, all_lines: array of (h1, h2, n)) of ``docs`` (row, ...)."""
    rows = docs.withColumn("_text", F.coalesce(F.col(f"row.{text}").cast("string"), F.lit("")))
    rows = rows.withColumn("_words", words_of(F.col("_text"))).withColumn("_lines", lines_of(F.col("_text")))
    rows = repeated_places(rows, "_words", "_places")
    covered = F.array_distinct(F.flatten(F.transform("_places", lambda p: F.array(p, p + 1, p + 2))))
    of = F.col(f"row.{host}").cast("string")

    def hashed(line: Column) -> Column:
        plain = normalised(line)
        parts = (of.isNull(), of, plain)
        return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"), F.size(F.split(plain, " ")).cast("long").alias("n"))

    return rows.select(
        "row",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.transform("_lines", hashed).alias("all_lines"),
    )


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(h1, h2, n_docs, n_rows) of the lines that more than ``max_docs`` documents have, of (doc, h1, h2)."""
    # a struct, as a null id counts too
    counted = lines.groupBy(*KEY).agg(F.count_distinct(F.struct("doc")).alias("n_docs"), F.count("*").alias("n_rows"))
    return counted.filter(F.col("n_docs") > max_docs)


def removed_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``lines`` (doc, h1, h2, ...) whose line more than ``max_docs`` documents have."""
    frequent = settle(frequent_lines(lines, max_docs), "frequent")
    total = frequent.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.broadcast(frequent.filter(F.col("n_rows") * HEAVY > total).select(*KEY))  # fewer than HEAVY rows
    cold = frequent.filter(F.col("n_rows") * HEAVY <= total).select(*KEY)
    rest = lines.join(hot, KEY, "left_anti").join(cold.hint("merge"), KEY, "left_semi")
    return lines.join(hot, KEY, "left_semi").unionByName(rest)


def judged(docs: DataFrame, doc_id: str, text: str, host: str, max_docs: int, carry_text: bool) -> DataFrame:
    """(row, measures, removed: the numbers of its removed lines, n_removed_words, base_failed, kept)."""
    carried = [c for c in docs.columns if carry_text or c != text]
    base = measured(docs.select(F.struct("*").alias("row")), text, host)
    base = base.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in carried])).withColumn("at", F.monotonically_increasing_id())
    base = settle(base, "measured")
    lines = base.select("at", F.col(f"row.{doc_id}").alias("doc"), F.posexplode("all_lines").alias("i", "line")).select("at", "doc", "i", "line.*")
    lost = removed_lines(lines, max_docs).groupBy("at").agg(F.sum("n").alias("n_removed_words"), F.collect_list("i").alias("removed"))
    found = base.drop("all_lines").join(lost.hint("merge"), "at", "left").na.fill(0, ["n_removed_words"])
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < LEAST_WORDS) | (F.col("n_removed_words") * 100 > F.col("n_words") * MOST_LOST)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """The columns of ``docs`` but its text, with the measures, n_removed_words, base_failed and kept."""
    found = judged(docs, doc_id, text, host, max_docs, carry_text=False)
    added = [*MEASURES, "n_removed_words", "base_failed", "kept"]
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != text and c not in added], *added)


def apply_quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``, their texts without the removed lines and without lines
    that have no word."""
    found = judged(docs, doc_id, text, host, max_docs, carry_text=True).filter("kept")
    found = found.withColumn("_lines", lines_of(F.col(f"row.{text}").cast("string")))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "removed")
    cut = F.array_join(F.transform(numbers, lambda i: F.get("_lines", i)), "\n")
    new = F.when(F.col("removed").isNull(), F.col("row")[text]).otherwise(cut)
    return found.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
