"""Packing: ids against the tokenizer, plans against bounds, places without gaps."""

import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratum.llm import packing as P


def test_ids_equal_the_tokenizer(tokenizer):
    plain, words = Tokenizer.from_file(tokenizer), P.WordIds(tokenizer)
    assert words.plain
    for t in ["", " \n", "The cat's naïve don't I'LL", "İstanbul ﬁ Ⅷ １２ 中文 ǅ x́", "a<|endoftext|>b <|x", "x\x1cy", "### $$$ A!!B, (foo) 'tis 3.14", "ÉÀ ß ſ ŉ"]:
        assert words.text(t) == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15))
def test_plan_uses_every_piece_once(counts):
    out = P.plan(dict(counts), 40)
    used = {}
    for use, times in out:
        assert sum(n * k for n, k in use.items()) <= 40
        for n, k in use.items():
            used[n] = used.get(n, 0) + times * k
    assert used == counts
    if counts:
        total = sum(n * c for n, c in counts.items())
        assert sum(t for _, t in out) <= 2 * -(-total // 40)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_fullest_is_the_best_subset(left, room):
    best = {0}
    for n, c in left.items():
        best = {s + k * n for s in best for k in range(c + 1) if s + k * n <= room}
    got = P.fullest(dict(left), room)
    assert sum(n * k for n, k in got) == max(best) and all(k <= left[n] for n, k in got)


def test_pieces_are_whole_and_gapless(spark, tokenizer):
    texts = [None, "", "word", "many words " * 3000, "x " * 40_000] + [f"text {i} " * (i % 90) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(2, "word", 1), (None, "word", 1)], "doc_id bigint, text string, length int")
    out = P.pack(df, tokenizer, capacity=256, with_ids=True).cache()
    rows = out.toPandas()
    plain = Tokenizer.from_file(tokenizer)
    for i, t in list(enumerate(texts))[:12]:
        own = rows[rows.doc_id == i].sort_values(["piece"])
        if i != 2:
            ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
            assert [int(x) for p in own["ids"] for x in p] == ids
            assert own.start.tolist() == list(range(0, len(ids), 256))
            assert own.ids_crc32.tolist() == [zlib.crc32(np.array(ids[s:s + 256], "<u4").tobytes()) for s in range(0, len(ids), 256)]
    own = rows.sort_values(["sequence_id", "offset"])
    assert ((own.groupby("sequence_id").length.cumsum() - own.length) == own.offset).all()
    assert own.groupby("sequence_id").length.sum().max() <= 256
    assert len(rows[rows.doc_id == 2]) == 2 and rows.doc_id.isna().sum() == 1
    assert rows.sequence_id.nunique() <= 1.02 * rows.length.sum() / 256 + 1
    whole = P.sequences(out).toPandas()
    assert sum(len(x) for x in whole["ids"]) == rows.length.sum()
    assert P.pack(df.limit(0), tokenizer).count() == 0
