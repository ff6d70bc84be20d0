import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import tokenizer as tk

if not os.path.exists(tk.VOCABULARY):
    pytest.skip("no vocabulary files", allow_module_level=True)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tk.PATTERN, mergeable_ranks=tk.load_ranks(), special_tokens={})


def test_agrees_on_texts(reference):
    rng = random.Random(0)
    texts = ["", " ", "\n\n  x", "it's we'll", "a" * 3_000, "ab" * 2_000, "é" * 999, "しおさい морена", "<|endoftext|>", "\t\r\n", "1234567 12", "́‍😀👍🏽", "x" + " " * 5_000]
    texts += ["".join(rng.choice("ab cé1\n.'") for _ in range(300)) for _ in range(50)]
    enc = tk.encoder(tk.read_vocabulary())
    assert [enc.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_agrees_on_any_text(text):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=tk.PATTERN, mergeable_ranks=tk.load_ranks(), special_tokens={})
    assert tk.encoder(tk.read_vocabulary()).encode(text) == own.encode_ordinary(text)


def test_round_trip():
    back = {v: k for k, v in tk.load_ranks().items()}
    text = "größe «x» 12\n漢字 zzzzqqqqxxxx"
    assert b"".join(back[i] for i in tk.encoder(tk.read_vocabulary()).encode(text)).decode() == text


def test_long_pretoken_is_quick(reference):
    text = "qzxj" * 25_000
    assert tk.merge(text.encode(), tk.load_ranks()) == reference.encode_ordinary(text)


def test_tree_points_at_leftmost_lowest():
    tree = tk.PairTree([3 << 32 | 0, 1 << 32 | 1, 1 << 32 | 2, tk._NONE])
    assert tree.root() == 1 << 32 | 1
    tree.set(1, tk._NONE)
    assert tree.root() == 1 << 32 | 2


def test_table(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "a b", 9), (None, " ", 9), (3, "a b", 9)], "doc_id long, text string, ids int").repartition(2)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in tk.encode_table(df).collect()), key=str)
    want = tk.encoder(tk.read_vocabulary()).encode("a b")
    assert got == sorted([(1, []), (2, []), (3, want), (None, tk.encoder(tk.read_vocabulary()).encode(" ")), (3, want)], key=str)
    assert tk.encode_table(df.limit(0)).count() == 0
