"""Quality rules: base statistics of each text and cross-document line frequency per host.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed; a
line's frequency is the number of documents of the same host that hold it.  Lines in more
than ``max_docs`` documents of their host are removed; a document that keeps less than
``least_kept`` of its words' characters is depleted and rejected.  Only DataFrame functions:
texts are taken apart within the row, and of the lines only hashes and sizes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import WORD_SPACE, Scratch, free_name

SYMBOLS = "#*$%&|<>"            # fixed value of the contract
WINDOW = 5                      # words
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NO_ID = "(null)"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: _without(x, WORD_SPACE) != "")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))))


def base_statistics(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) of every row; null counts as empty.

    n_repeat_words counts the words in five-word windows that occur twice or more: windows
    are hashed in order; where a hash repeats, windows sorted by hash show which ones do, and
    their places, sorted again, how many words they cover.
    """
    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("t"))
    names = rows.columns[:-1]
    rows = rows.select(*names, "t", F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"), _lines(F.col("t")).alias("lines"))
    words, lines = F.col("words"), F.col("lines")
    windows = F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))
    rows = rows.select(*names, F.size(words).cast("long").alias("n_words"), F.length(_without(F.col("t"), WORD_SPACE)).cast("long").alias("word_chars"),
                       (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
                       (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), windows.alias("windows"))
    known = [*names, *STATISTICS[:-1]]
    hashes = F.col("windows")
    rows = rows.select(*known, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("placed"))
    placed = F.col("placed")
    same = lambda x, i: F.coalesce(F.get(placed, i)["h"] == x["h"], F.lit(False))
    rows = rows.select(*known, F.sort_array(F.transform(
        F.filter(placed, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])).alias("again"))
    again = F.col("again")
    covered = F.aggregate(F.transform(again, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(again, i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, n: a + n)
    return rows.select(*known, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def frequent_lines(docs: DataFrame, text: Column, host: Column, max_docs: int) -> DataFrame:
    """host, line (hash): lines in more than ``max_docs`` documents of the host; a line counts once in a document."""
    own = docs.select(host.alias("host"), F.explode(F.array_distinct(F.transform(_lines(F.coalesce(text, F.lit(""))), _line_hash))).alias("line"))
    return own.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs).select("host", "line")


def judge(docs: DataFrame, *, id: str = "doc_id", text: str = "text", host: str = "source", max_docs: int = 50, least_kept: float = 0.3) -> DataFrame:
    """``id``, the five statistics, base_failed, removed_chars, kept for every row.

    base_failed: fewer than ten words, or over a fifth of them in repeated windows.  Every
    row is a document and counts for its lines; a null host is a host of its own.  Rows that
    repeat an id (or have none) are judged for depletion by all their lines together.  Null
    texts are empty and fail.  Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "line-rules")
    key = F.coalesce(F.col(id).cast("string"), F.lit(NO_ID))
    site = F.coalesce(F.col(host).cast("string"), F.lit(NO_ID))
    base = scratch.keep(base_statistics(docs, F.col(text), [F.col(id).alias("id"), key.alias("key")]), "statistics")
    common = scratch.keep(frequent_lines(docs, F.col(text), site, max_docs), "frequent")
    lines = docs.select(key.alias("key"), site.alias("host"), F.explode(F.transform(
        _lines(F.coalesce(F.col(text), F.lit(""))), lambda x: F.struct(_line_hash(x).alias("line"), F.length(_without(x, WORD_SPACE)).alias("size")))).alias("x"))
    removed = (lines.select("key", "host", "x.line", "x.size").join(common, ["host", "line"])
               .groupBy("key").agg(F.sum("size").cast("long").alias("removed")))
    whole = base.groupBy("key").agg(F.sum("word_chars").alias("whole"))
    left = whole.join(removed, "key", "left").select("key", F.coalesce("removed", F.lit(0).cast("long")).alias("removed_chars"),
                                                     (F.col("whole") - F.coalesce("removed", F.lit(0)) >= least_kept * F.col("whole")).alias("enough"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return base.join(left, "key").select(F.col("id").alias(id), *STATISTICS, failed.alias("base_failed"), "removed_chars", (~failed & F.col("enough")).alias("kept"))


def without_frequent_lines(docs: DataFrame, *, text: str = "text", host: str = "source", max_docs: int = 50) -> DataFrame:
    """All rows with the frequent lines of their host taken out of ``text``; null stays null."""
    site = F.coalesce(F.col(host).cast("string"), F.lit(NO_ID))
    scratch = Scratch(docs.sparkSession, "line-removal")
    row, at = free_name(docs, "row"), free_name(docs, "at")
    numbered = scratch.keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    common = frequent_lines(numbered, F.col(text), site, max_docs)
    lines = numbered.select(row, site.alias("host"), F.posexplode(F.split(F.col(text), "\n")).alias(at, "body")).withColumn("line", _line_hash(F.col("body")))
    kept = (lines.join(common, ["host", "line"], "left_anti").groupBy(row)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "body"))), lambda x: x["body"]), "\n").alias("kept")))
    new = F.when(F.col(text).isNotNull(), F.coalesce("kept", F.lit("")))
    return numbered.join(kept, row, "left").select(*[new.alias(c) if c == text else numbered[c] for c in docs.columns])
