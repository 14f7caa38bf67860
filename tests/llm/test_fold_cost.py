"""op10: what the fold and the dictionary leave out changes cost, never a result."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from chargepulse.llm import bpe_fold

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fold.read_ranks(PATH),
                             special_tokens={})


def test_a_slot_holds_its_most_frequent_words(spark, own, monkeypatch):
    monkeypatch.setattr(bpe_fold, "SLOTS", 1)
    monkeypatch.setattr(bpe_fold, "WAYS", 4)
    text = "".join(f" thonre{x}" * n for x, n in zip("abcdef", (9, 8, 7, 6, 5, 1)))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ranks = bpe_fold.Ranks(spark, bpe_fold.read_ranks(PATH))
    pattern = bpe_fold.java_pattern(public_tokenizers.PATTERN, spark)
    words = bpe_fold.dictionary(df, ranks, pattern)
    with monkeypatch.context() as without_fold:
        without_fold.setattr(bpe_fold, "fold_word", lambda w, _: F.array().cast("array<int>"))
        known = df.select(bpe_fold.encode(F.col("text"), ranks, words, pattern)).first()[0]
    assert known == own.encode_ordinary(text[:8 * (9 + 8 + 7 + 6)])
    assert df.select(bpe_fold.encode(F.col("text"), ranks, words, pattern)).first()[0] == own.encode_ordinary(text)


def test_short_words_are_folded_without_a_search(spark, own):
    ranks = bpe_fold.Ranks(spark, bpe_fold.read_ranks(PATH))
    assert "array_position" not in str(bpe_fold._fold_short(F.col("w"), ranks))
    rng = random.Random(5)
    words = ["\0", "\0\0", "a\0", "\x7f\x80", "ÿ", "字", "\U0001F600", " " * 40, "ab" * 128]
    words += ["".join(rng.choice("athe onri\0\xe9字") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(2)
    for r in df.select("w", bpe_fold.fold_word(F.col("w"), ranks).alias("ids")).collect():
        assert r.ids == own._encode_single_piece(r.w.encode()), r.w


def test_decoding_keeps_parts_of_characters(spark, own):
    ranks = bpe_fold.Ranks(spark, bpe_fold.read_ranks(PATH))
    every = [*range(ranks.size), *own.encode_ordinary("\0\U0001F600 字")]
    df = spark.createDataFrame([(1, every), (2, [])], "i int, ids array<int>")
    got = {r.i: bytes(r.b) for r in df.select("i", bpe_fold.decode(F.col("ids"), ranks.pieces).alias("b")).collect()}
    assert got == {1: own.decode_bytes(every), 2: b""}
