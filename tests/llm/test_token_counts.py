"""Token counts against the public library on whole texts."""

import random

import public_tokenizers
import pytest
import tokenizers

from churnlens.llm import token_counts as C
from churnlens.llm.queries import op13_token_counts
from churnlens.sources.tables import read_table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    model = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(model.encode(text or "", add_special_tokens=False).ids)


def counted(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.id: (r.n_bytes, r.n_tokens) for r in C.token_counts(df, PATH, 10, **kw).collect()}


ODD = [
    "", " ", None, "It's THE cat's, they'll 'sing' ''s 's", "don't DON'T d'accord l'été", "x1y22 ½ ² ٣", "Straße ŒUVRE İstanbul ſ ŉ",
    "ΟΔΟΣ σας ΣΑΣ", "été ́a ö", "a b c　d\u0085e\x1cf\x1fg", "\x00\x01 \x7f", "東京タワー 한국어 ไทย",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> <|endof text|> <|", "👩‍👩‍👧 🏳️‍🌈 ok", "ﬁne ﷺ Ǆ ǅ ß ẞ", "Ω K Å K",
    "a\r\nb\x0bc\x0cd", "'", "''", "'S", "!!'s!!", "﻿bom ​zero", "—dash–dash… «x» “y” ’s it’s",
]


def test_odd_texts(spark, library):
    got = counted(spark, ODD)
    assert got == {i: (len((t or "").encode()), library(t)) for i, t in enumerate(ODD)}


def test_random_texts(library):
    """Any mixture of characters, with an empty table and a worker's own cache."""
    rnd = random.Random(13)
    with open(PATH, "rb") as f:
        model = C.Tokenizer(f.read(), "json")
    lengths = C.Lengths({}, model.encode)
    pieces = [" ", "  ", "\n", "'", "'s", "'LL", "a", "Zebra", "ÉCOLE", "ñ", "7", "42", ".", "!?", "é", "é", "Σ", "ΑΣ", "İ", " ", "\x1c", "中", "<|endoftext|>", "<|", "½", "ª", "·", "̇", "ß", "×"]
    for _ in range(3000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(0, 30)))
        assert lengths.count(text, model.added) == library(text), repr(text)


def test_cache_and_windows(monkeypatch, library):
    """A small cache, that is emptied often, and small windows change nothing."""
    with open(PATH, "rb") as f:
        model = C.Tokenizer(f.read(), "json")
    monkeypatch.setattr(C, "CACHED", 3)
    monkeypatch.setattr(C, "WINDOW", 10)
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma's", "délta", "ε", "x" * 40, "12"]
    text = "".join(rnd.choice(words) + rnd.choice([" ", "\n\n", "\t"]) for _ in range(500))
    assert "".join("".join(w.split()) for w in C.windows(text)) == "".join(text.split())
    lengths = C.Lengths({"beta": library("beta")}, model.encode)
    assert lengths.count(text, model.added) == library(text)
    assert len(lengths) <= 4


def test_long_texts(spark, library):
    long = "word and Wörter, " * 60_000
    solid = "ab1" * 20_000
    assert counted(spark, [long, solid]) == {0: (len(long.encode()), library(long)), 1: (len(solid), library(solid))}


def test_rows_names_and_empty_table(spark):
    rows = [(None, "a b", 1, "x"), (5, "a b", 2, "y"), (5, "a b", 2, "y"), (6, "one two three", 3, "z")]
    df = spark.createDataFrame(rows, "`my.id` long, `te``xt` string, n_tokens int, id string")
    got = sorted(map(tuple, C.token_counts(df, PATH, 2, "my.id", "te`xt").collect()), key=str)
    assert got == [(5, 3, 2, False), (5, 3, 2, False), (6, 13, 3, True), (None, 3, 2, False)]
    assert C.token_counts(df.limit(0), PATH, 2, "my.id", "te`xt").count() == 0


def test_other_files(spark):
    """Another form of tokenizer is applied to whole texts."""
    import sentencepiece

    texts = ["Hello  world", "", "été 東京"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.n_tokens for r in C.token_counts(df, public_tokenizers.path("piece_bpe_32k.model"), 9).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert got == {i: len(model.encode(t)) for i, t in enumerate(texts)}
    got = {r.id: r.n_tokens for r in C.token_counts(df, public_tokenizers.path("byte_bpe_50k.json"), 9).collect()}
    model = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got == {i: len(model.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_query(spark, library):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    want = {r.doc_id: (r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 2048) for r in docs.collect()}
    got = op13_token_counts(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: tuple(r) for r in got.collect()} == want
