"""Token counts against the libraries, with calls and parts of many sizes."""

import random

import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from tessera.llm import token_counts as tc

VOCABULARY = path("byte_bpe_50k.json")
EDGE = ["", None, " \n\t", "one", "a<|endoftext|>b <|endoftext|>", "<|endoftext", "été 漢字。漢字 🙂 ²½ \x85\xa0 x", "x" * 5000,
        "the " * 3000, "don't  stop\r\n\r\n  now", "\x1c \x1c\n", "漢字、" * 900]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


def test_parts_add_up_at_every_size(library):
    counter, rng = tc.Counter.of("json", open(VOCABULARY, "rb").read()), random.Random(5)
    bits = ["a", "it's", " ", "\n", "  ", "é", "漢", "。", "²", "12", "\x1c", "\x85", "　", "🙂", "<|endoftext|>", "<|end", "|>", ".", ",", "'", "ʰ"]
    assert counter.splits and counter.specials == ("<|endoftext|>",)
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(120)))
        for size in (1, 5, 30):
            pieces = list(tc.parts(text, size, counter.specials))
            assert "".join(pieces) == text
            assert counter.counts([text, text], [len(text.encode())] * 2, 40, size) == [expected(library, text)] * 2


def test_boundaries_do_not_cut_special_strings():
    assert list(tc.parts("aaaa<|a.b|> c", 5, ("<|a.b|>",))) == ["aaaa<|a.b|>", " c"]
    assert list(tc.parts("x" * 50, 5)) == ["x" * 50]


def test_calls_are_bounded_by_bytes_and_words_are_encoded_once():
    calls = []
    counter = tc.Counter(lambda texts: calls.append(texts) or [len(t) for t in texts], splits=True)
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 500, 3, 40, 7, 900)] + ["x" * 90 + " y"]
    assert counter.counts(texts, [len(t) for t in texts], batch_bytes=200, part_chars=100) == [len(t) for t in texts]
    assert max(sum(map(len, c)) for c in calls) <= 200
    seen = [t for c in calls for t in c]
    assert len(seen) == len(set(seen)) == len(counter.known) + 1  # the long one is not remembered
    assert "x" * 90 not in counter.known and counter.known[" w899"] == 5


def test_words_join_to_the_text_and_begin_at_safe_boundaries():
    assert tc.words("a b\n\n c ") == ["a", " b", "\n\n c", " "]
    assert tc.words("a\xa0 b c") == ["a\xa0 b c"] and tc.words("") == []


def test_count_tokens_on_a_table(spark, library):
    rows = [(i, t, 7, "x", True) for i, t in enumerate(EDGE)] + [(None, "a b", 7, "x", None), (3, "one", 7, "x", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, parts string, over_limit boolean")
    out = tc.count_tokens(df, VOCABULARY, limit=2, batch_bytes=64, part_chars=16)
    assert sorted(out.columns) == ["doc_id", "n_bytes", "n_tokens", "over_limit", "parts", "text"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        n = expected(library, r.text)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 2)
    assert tc.count_tokens(df.limit(0), VOCABULARY).count() == 0


def test_other_vocabularies_count_whole_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "doc_id long, text string")
    words, model = Tokenizer.from_file(path("word_bpe_49k.json")), path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    for r in tc.count_tokens(df, path("word_bpe_49k.json"), part_chars=4).collect():
        assert r.n_tokens == expected(words, r.text)
    for r in tc.count_tokens(df, model, part_chars=4).collect():
        assert r.n_tokens == len(pieces.encode(r.text or ""))
    with pytest.raises(ValueError):
        tc.Counter.of("txt", b"")
