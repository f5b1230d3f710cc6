"""Spelling variants: a frontier of (word, rest, node, edits) states walked over a relational trie.

The trie is a table of edges (node, label, child): its nodes are the prefixes at which words
part or end, so the levels grow with the branchings of a word and not with its length.  A
node is known by a hash of its prefix; equal hashes of different prefixes add states, but
lose none, and every pair found is compared exactly at the end.

A word's own prefixes are its states without an edit.  At each of its nodes the word may lose
its next character, or part from its path along another edge, with one character replaced
or inserted.  These one-edit states are joined to the edge table level by level; they live as
long as an edge's whole label continues the rest of the word.  A state without rest at the
end of a word makes the two words neighbours.

Two words that differ by one edit share their first or their second half, so the states start
in a word's second half only, once over the trie of the words and once over that of the
reversed words; near the root, where all words pass, nothing is searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import Scratch

RUN = "A-Za-z\\u00C0-\\u00FF"                  # fixed value of the contract: letters of a word
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def typed_words(docs: DataFrame, id: str, text: str, shortest: int, drop_one_in: int) -> DataFrame:
    """word: the runs of letters of every text; one run in ``drop_one_in`` (by the crc32 of id and run) loses a character.

    Runs below ``shortest`` letters cannot become longer and are not read.
    """
    runs = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{RUN}]{{{shortest},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % drop_one_in == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= shortest)


def word_counts(words: DataFrame, least: int) -> DataFrame:
    """word, n of the words that occur ``least`` times or more."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _paths(words: DataFrame, shortest: int) -> DataFrame:
    """side, word, text (reversed on side 1), path: the nodes of a word from the middle of the shortest one on, as (at, node)."""
    both = words.select("word", F.posexplode(F.array(F.col("word"), F.reverse("word"))).alias("side", "text"))
    steps = both.select("side", "word", "text", F.explode(F.sequence(F.lit(shortest // 2), F.length("text"))).alias("at"))
    steps = steps.select("side", "word", "text", "at", F.xxhash64("side", F.substring(F.col("text"), F.lit(1), F.col("at"))).alias("node"),
                         F.substring(F.col("text"), F.col("at") + 1, F.lit(1)).alias("next"))
    # words part at a node, or one ends there ('' is the smallest)
    nodes = steps.groupBy("node").agg(F.min("next").alias("low"), F.max("next").alias("high")).where("low = '' OR low <> high").select("node")
    return (steps.select("side", "word", "at", "node").join(nodes, "node", "left_semi")
            .groupBy("side", "word").agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("path"))
            .select("side", "word", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("text"), "path"))


def _part(text: str | Column, start: Column, length: Column | None = None) -> Column:
    """From code point ``start`` (from 0) on."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring(text, start + 1, F.length(text) if length is None else length)


def _edges(paths: DataFrame) -> DataFrame:
    """node, label, child: each edge of both tries once."""
    pairs = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.element_at("path", i).alias("a"), F.element_at("path", i + 1).alias("b")))
    steps = paths.where(F.size("path") > 1).select("text", F.explode(pairs).alias("s"))
    return steps.select(F.col("s.a.node").alias("node"), _part("text", F.col("s.a.at"), F.col("s.b.at") - F.col("s.a.at")).alias("label"),
                        F.col("s.b.node").alias("child")).distinct()


def _seeds(paths: DataFrame) -> DataFrame:
    """word, rest, node at the nodes of a word's second half (the longer half where it is reversed)."""
    half = F.floor(F.length("text") / 2).cast("int")
    first = F.when(F.col("side") == 0, half).otherwise(F.length("text") - half)
    steps = paths.select("word", "text", first.alias("first"), F.explode("path").alias("s")).where("s.at >= first")
    return steps.select("word", _part("text", F.col("s.at")).alias("rest"), F.col("s.node").alias("node"))


def _branch(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """One-edit states behind the edges that leave a word's own path: a character is replaced, or stands more on the edge."""
    size, tail = F.length("label"), _part("label", F.lit(1))
    off = seeds.join(edges, "node").where(F.substring("rest", 1, 1) != F.substring("label", 1, 1))
    replaced = F.when((F.length("rest") >= size) & (_part("rest", F.lit(1), size - 1) == tail), _part("rest", size))
    inserted = F.when(F.substring(F.col("rest"), F.lit(1), size - 1) == tail, _part("rest", size - 1))
    return off.select("word", F.col("child").alias("node"), F.explode(F.array(replaced, inserted)).alias("rest")).where("rest IS NOT NULL").select("word", "rest", "node")


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One-edit states one edge further: the rest must continue with the whole label."""
    return states.where("rest <> ''").join(edges, "node").where(F.startswith("rest", "label")).select(
        "word", _part("rest", F.length("label")).alias("rest"), F.col("child").alias("node"))


def neighbours(words: DataFrame, scratch: Scratch, shortest: int) -> DataFrame:
    """word, other: all pairs, both ways, of words that differ by one inserted, deleted or replaced code point."""
    paths = scratch.keep(_paths(words, shortest), "paths")
    edges = scratch.keep(_edges(paths), "edges")
    ends = paths.select(F.element_at("path", -1)["node"].alias("node"), F.col("word").alias("other"))
    seeds = scratch.keep(_seeds(paths), "seeds")
    lost = seeds.where("rest <> ''").select("word", _part("rest", F.lit(1)).alias("rest"), "node")
    states = scratch.keep(_branch(seeds, edges).unionByName(lost), "states")
    done = states.where("rest = ''")
    while not states.where("rest <> ''").isEmpty():
        states = scratch.keep(_advance(states, edges), "states")
        done = done.union(states.where("rest = ''"))
    pairs = done.select("word", "node").join(ends, "node").select("word", "other").distinct()
    return pairs.where(F.levenshtein("word", "other", 1) == 1)


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of every word that has a form: forms are followed two, four, eight ... at a time.

    A form occurs several times as often as its word, so there are no rings and few rounds.
    """
    roots = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = scratch.keep(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, times: int = 5, drop_one_in: int = 199) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``shortest`` code points and ``least`` occurrences or more.

    A word's form is its most frequent neighbour (ties: the first in code-point order), if that
    occurs ``times`` times as often as the word; its root is the last of the chain of forms.
    Words of any length count; a word without neighbours has n_near 0, no form, and is its own
    root.  Null and empty texts have no words; a null id counts as the empty text in the hash
    of its runs; rows that repeat an id all count.  Other columns are not read.
    """
    if shortest < 2 or times < 2:
        raise ValueError("words have at least two code points, and a form occurs at least twice as often")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(word_counts(typed_words(docs, id, text, shortest, drop_one_in), least), "words")
    pairs = neighbours(words, scratch, shortest)
    near = scratch.keep(pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other"), "near")
    most = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("other_n").alias("form_n"))
    counted = words.join(most, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("form_n") >= times * F.col("n"), F.col("form_n")).alias("form_n"))
    counted = scratch.keep(counted, "counted")
    # equally frequent neighbours: the smallest in UTF-8 order, which is the order of code points
    top = near.join(counted.where("form_n IS NOT NULL").select("word", "form_n"), "word").where("other_n = form_n")
    forms = scratch.keep(top.groupBy("word").agg(F.min("other").alias("form")), "forms")
    out = counted.join(forms, "word", "left").join(_roots(forms, scratch), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
