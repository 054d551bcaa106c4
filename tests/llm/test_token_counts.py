"""Token counts against the library itself, on planted texts and the whole given table."""

import random
import sys

import pytest
from tokenizers import Tokenizer

from churnlens.llm import token_counts as T
from tests.llm.conftest import doc, rows_of

ODD = ["", " ", "  a  b ", "it's we'll I'D 'S", "tab\tnew\n\nline \r\n x", "a\x1cb\x1dc", "x y z　", "​zero",
       "naïve Ünïcode straße", "数字１２３ Ⅷ ½ ٣", "👩‍👩‍👧 emoji 🙂🙂", "a" * 500, "ab" * 300, "!?" * 200, "1234567890" * 30,
       "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", " <|endoftext|>\n", "<|endoftext", "\x00\x01", "é"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.default_vocabulary())


@pytest.fixture(scope="module")
def vocabulary():
    return T.read_vocabulary(T.default_vocabulary())


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_pre_tokens_class_every_code_point_as_the_library(library, vocabulary):
    pre = library.pre_tokenizer
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # all code points where versions of Unicode can differ, and every 7th of the rest
    odd = vocabulary.pre_tokens.odd
    some = [c for i, c in enumerate(points) if i < 0x3000 or i % 7 == 0 or odd and odd.match(c)]
    for frame in ("a{}a", "1{} {}1"):
        for k in range(0, len(some), 4000):
            text = "\n\n".join(frame.replace("{}", c) for c in some[k:k + 4000])
            mine = [m.span() for m in vocabulary.pre_tokens.of(text).finditer(text)]
            assert mine == [span for _, span in pre.pre_tokenize_str(text)], (frame, k)


def test_whole_tokens_are_proven_not_assumed(library, vocabulary):
    sample = random.Random(1).sample(sorted(vocabulary.whole), 3000)
    assert all(want(library, s) == 1 for s in sample if len(vocabulary.pre_tokens.plain.findall(s)) == 1)
    # a string in the vocabulary that no order of merges reaches is not whole
    made = T.Vocabulary(["a", "b", "c", "ab", "bc", "abc"], [("b", "c"), ("a", "b"), ("ab", "c")], [])
    assert set(made.whole) == {"a", "b", "c", "ab", "bc"}


def test_counts_equal_the_library(library, vocabulary):
    r, counter = random.Random(5), T.Counter(vocabulary)
    letters = "abcdefghijklmnopqrstuvwxyz ABC  \n\t'.,!0123äéß数字🙂"
    texts = ODD + ["".join(r.choices(letters, k=r.randrange(1, 300))) for _ in range(3000)]
    assert [counter.of(t) for t in texts] == [want(library, t) for t in texts]


def test_forgetting_changes_nothing(library, vocabulary, monkeypatch):
    counter = T.Counter(vocabulary, known=3)
    texts = [f"zqx{i}kj vvw{i % 7}" for i in range(60)] * 2
    assert [counter.of(t) for t in texts] == [want(library, t) for t in texts]
    assert len(counter) <= len(vocabulary.whole) + 3
    monkeypatch.setattr(T, "LONG_TEXT", 10)
    assert counter.of("word by word, match by match") == want(library, "word by word, match by match")


def test_very_long_texts(library, vocabulary):
    counter = T.Counter(vocabulary)
    for text in ("lorem ipsum dolor " * 80_000, "qz" * 100_000):
        assert counter.of(text) == want(library, text)


def test_rows_and_other_columns(make, spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", None), (2, "", "y"), (3, "word " * 2000, "z")]
    df = make(rows, "doc_id long, text string, `a.b` string").selectExpr("*", "7 AS n_tokens", "8 AS tokens", "9 AS `N_Bytes`")
    got = T.count_tokens(df)
    assert got.columns == ["doc_id", "text", "a.b", "tokens", "n_bytes", "n_tokens", "over_limit"]
    assert rows_of(got, "doc_id", "`a.b`", "tokens", "n_bytes", "n_tokens", "over_limit") == sorted([
        (1, "x", 8, 0, 0, False), (1, "x", 8, 0, 0, False), (None, None, 8, 3, 2, False), (2, "y", 8, 0, 0, False),
        (3, "z", 8, 10000, 2001, True)], key=repr)
    assert T.count_tokens(df, limit=1).filter("over_limit").count() == 2
    assert T.count_tokens(df.limit(0)).count() == 0


def test_other_kinds_of_vocabulary_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        T.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_the_library(spark, library):
    path = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = T.op12_token_counts(spark, path).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        n = want(library, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


if __name__ == "__main__":
    sys.exit(pytest.main([__file__]))
