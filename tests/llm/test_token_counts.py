"""Counts of every prefix and truncation against the tokenizer library."""

import random

import pytest

from rollcall.llm import token_counts

TEXTS = [
    "天地玄黃宇宙洪荒日月盈昃辰宿列張",
    "short words then zxqjvkqwzxxjqpfvkzhhqqw end",
    "internationalisationally unbelievableness, isn't it? We're sure they'll say we've won!'s",
    "ab <|endoftext|> cd<|endoftext|><|startoftext|> e!!<|endoftext|>!",
    "Café Ångström ΟΔΟΣ İstanbul 각각 한 ẹ́",
    "  leading\t\nand   trailing 　 blanks  ",
    "🙂 emoji 👩‍👩‍👧 family 12345 x2y3",
    "",
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    tok.no_truncation()
    tok.no_padding()
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids)


def random_texts(n=60, seed=2):
    r = random.Random(seed)
    letters = "abcdefgh éüß'’.,!?-_ \n<|>0123456789ABCĀĂσΣ中文ひら"
    return ["".join(r.choices(letters, k=r.randint(1, 60))) for _ in range(n)]


def test_every_prefix_is_that_of_the_library(library):
    own = token_counts.counter("word_bpe_49k.json")
    for text in TEXTS + random_texts():
        counts = own.running(text)
        assert len(counts) == len(text)
        want = [library(text[:i]) for i in range(1, len(text) + 1)]
        assert [(i, w) for i, (c, w) in enumerate(zip(counts, want, strict=True)) if c is not None and c != w] == [], text
        assert own.count(text) == library(text)
        assert not text or counts[-1] == library(text)


@pytest.mark.parametrize("budget", [1, 2, 5, 9, 40])
def test_truncation_is_the_longest_prefix_within_the_budget(spark, library, budget):
    counted = token_counts.count_tokens(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), keep_prefixes=True)
    own = token_counts.counter("word_bpe_49k.json")
    got = {r["doc_id"]: (r["kept_chars"], r["kept_tokens"]) for r in token_counts.truncate_at(counted, budget).collect()}
    for k, text in enumerate(TEXTS):
        whole = [i + 1 for i, c in enumerate(own.running(text)) if c is not None]  # places that cut nothing in two
        best = max((i for i in whole if library(text[:i]) <= budget), default=0)
        assert got[k] == (best, library(text[:best])), text


def test_a_very_long_text(library):
    text = " ".join(f"word{i % 977} <|endoftext|>" for i in range(20_000))
    assert token_counts.counter("word_bpe_49k.json").count(text) == library(text)
