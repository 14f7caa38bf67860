"""op10: words of any length, folded by blocks, have the library's ids."""

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


def test_blocks_give_the_same_ids_as_whole_words(spark, own):
    rng = random.Random(3)
    words = ["a", "ab", "a" * 7, "ab" * 50]
    for letters in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", "的一是不了在人有我他这", "етоанис"):
        words += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 150))) for _ in range(30)]
    ranks = bpe_fold.Ranks(spark, bpe_fold.read_ranks(PATH))
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(4)
    got = df.select("w", *[bpe_fold.fold_word(F.col("w"), ranks, long_word=n).alias(f"ids_{n}") for n in (0, 1 << 30)])
    for r in got.collect():
        assert r["ids_0"] == r[f"ids_{1 << 30}"] == own.encode_ordinary(r.w), r.w


def test_a_word_of_20_000_letters(spark, own):
    rng = random.Random(4)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    df = spark.createDataFrame([(1, word), (2, "x" + word[:300] + " 字" + "的一是不了在人" * 100), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe_fold.bpe(df, PATH, public_tokenizers.PATTERN).collect()}
    for r in df.collect():
        assert got[r.doc_id].ids == own.encode_ordinary(r.text or "")
        assert bytes(got[r.doc_id].decoded) == (r.text or "").encode()
