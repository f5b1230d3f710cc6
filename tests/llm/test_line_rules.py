"""Line rules: statistics, frequency per host and verdicts against a plain version."""

import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st

from stratum.llm import line_rules as L

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    t = text or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def plain_judge(rows, max_docs, least):
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    lines = [[x for x in (t or "").split("\n") if re.search(WORD, x)] for _, t, _ in rows]
    docs = Counter((h, x) for (_, _, h), own in zip(rows, lines) for x in {norm(y) for y in own})
    gone, whole = defaultdict(int), defaultdict(int)
    for (i, t, h), own in zip(rows, lines):
        whole[i] += plain(t)[1]
        gone[i] += sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in own if docs[h, norm(x)] > max_docs)
    out = []
    for i, t, _ in rows:
        s = plain(t)
        failed = s[0] < 10 or 100 * s[4] > 20 * s[0]
        out.append((i, *s, failed, gone[i], not failed and whole[i] - gone[i] >= least * whole[i]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def texts():
    random.seed(2)
    lines = [" ".join(f"w{random.randrange(90)}" for _ in range(random.randint(1, 9))) for _ in range(60)]
    out = [None, "", " \n\t", "a\x0bb\x0cc\rd", "x " * 5000, "é|# $%&*<> " * 4 + "\n", "one two three four five six seven eight nine ten"]
    for _ in range(150):
        out.append("\n".join(random.choice(lines[:8] if random.random() < 0.6 else lines) + random.choice(["", " ", "\t"]) for _ in range(random.randint(1, 12))))
    return out


def test_verdicts_equal_a_plain_version(spark):
    rows = [(i, t, [None, "a", "b"][i % 3]) for i, t in enumerate(texts())] + [(3, "again the same id\nand more", "a"), (None, "no id at all\nw1 w2", "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, n_words int")
    assert got(L.judge(df, max_docs=5)) == plain_judge(rows, 5, 0.3)
    assert L.judge(df.limit(0)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té|", max_size=60), min_size=1, max_size=30))
def test_statistics_equal_a_plain_version(spark, own):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(list(enumerate(own)), "i int, t string")
    assert got(L.base_statistics(df, F.col("t"), [F.col("i")])) == sorted(((i, *plain(t)) for i, t in enumerate(own)), key=str)


def test_removal_of_frequent_lines(spark):
    rows = [(i, f"common line\nown {i}\nCommon  Line ", "h") for i in range(4)] + [(9, "common line", "other"), (10, None, "h"), (11, "common line", "h")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r["doc_id"]: r["text"] for r in L.without_frequent_lines(df, max_docs=3).collect()}
    assert out == {**{i: f"own {i}" for i in range(4)}, 9: "common line", 10: None, 11: ""}


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id bigint, text string, source string")
    plan = L.judge(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
