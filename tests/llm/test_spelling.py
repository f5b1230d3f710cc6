import random
import re
import zlib
from collections import Counter, defaultdict

from stratum.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def counts(docs):
    n = Counter()
    for i, t in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 199 == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            n[r] += len(r) >= 6
    return {w: c for w, c in n.items() if c >= 5}


def brute(docs):
    n, near, form = counts(docs), defaultdict(set), {}
    letters = {c for w in n for c in w}
    for w in n:
        for i in range(len(w) + 1):
            for v in {w[:i] + w[i + 1:], *(w[:i] + c + w[i:] for c in letters), *(w[:i] + c + w[i + 1:] for c in letters)} & n.keys() - {w}:
                near[w].add(v)
    for w, c in n.items():
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 5 * c:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items())


def run(spark, docs):
    df = spark.createDataFrame([(t, 1, "x", i) for i, t in docs], "text string, n int, word string, doc_id long")
    return sorted(tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


def edited(rng, w):
    i = rng.randrange(len(w))
    return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcéß") + w[i:], w[:i] + rng.choice("abcñ") + w[i + 1:]])


def corpus():
    rng = random.Random(8)
    words = {"".join(rng.choices(["ab", "ba", "cé", "a", "ñb"], k=rng.randint(3, 7))) for _ in range(60)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abaaaaaa", "abcdefgh" * 40, "abcdefgh" * 39 + "abcdefg", "x" + "abcdefgh" * 40, "bcdefgh" + "abcdefgh" * 39}
    words |= {edited(rng, w) for w in list(words) for _ in range(3)}
    many = [w for w in sorted(words) for _ in range(rng.choice([1, 5, 6, 30, 160]))]
    rng.shuffle(many)
    return [(k, " ".join(many[k * 40:k * 40 + 40])) for k in range(-(-len(many) // 40))]


def test_equals_all_edits(spark):
    docs = corpus()
    docs += [(None, None), (8000, ""), (8001, "12 .. x"), (None, "Éabaab " * 9), (8002, "ÉABAAB éabaab,éabaaba;" * 7), (8003, "abcabc " * 400), (8003, "abcabb " * 9)]
    expected = brute(docs)
    assert sum(w[1] is not None for w in expected) > 20 and any(w[2] != w[1] and w[1] for w in expected)
    assert run(spark, docs) == expected


def test_chain_of_forms(spark):
    docs = [(k, " ".join(["stones"] * 1000 + ["stonez"] * 200 + ["stonezz"] * 30 + ["stonyzz"] * 6)) for k in range(1)]
    found = {r[0]: r[1:3] for r in run(spark, docs)}
    assert found == {r[0]: r[1:3] for r in brute(docs)}
    assert found["stonyzz"] == ("stonezz", "stones")


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, "abcdef")]) == []
