"""Cases that once crashed, were wrong or took a square of the text's length."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from chargepulse.llm import bpe_fold, secrets_scan, token_count


# ------------------------------------------------------------- 10 byte-level BPE
def test_java_classes_are_the_librarys(spark):
    for name in ("L", "N"):
        inside = bpe_fold.unicode_class(spark, name)
        kept = spark.range(1).select(F.regexp_replace(F.lit(bpe_fold._EVERY), f"[^{inside}]", "")).first()[0]
        assert set(kept) == bpe_fold._library_has(name)
        gone = spark.range(1).select(F.regexp_replace(F.lit(bpe_fold._EVERY), f"[{inside}]", "")).first()[0]
        assert set(gone) == set(bpe_fold._EVERY) - bpe_fold._library_has(name)


def test_letters_and_numbers_java_does_not_know(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fold.read_ranks(path),
                            special_tokens={})
    rng = random.Random(1)
    odd = ["\U00031350", "\U0001E4D0", "ࡰ", "\U0001D2C0", *rng.sample(sorted(bpe_fold._library_has("L")), 80),
           *rng.sample(sorted(bpe_fold._library_has("N")), 40), *rng.sample(bpe_fold._EVERY, 80)]
    texts = [t for c in odd for t in (f"{c}'s a", f"9{c}", f" {c}a", f"a{c}")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in bpe_fold.bpe(df, path, public_tokenizers.PATTERN).collect()}
    assert got == {i: (own.encode_ordinary(t), t.encode()) for i, t in enumerate(texts)}


def test_variables_go_after_an_error(spark, tmp_path):
    bad = tmp_path / "ranks"
    bad.write_bytes(b"YQ== 0\n")  # one piece, not every byte
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(KeyError):
        bpe_fold.bpe(df, str(bad), public_tokenizers.PATTERN)


# ------------------------------------------------------------------- 9 secrets
def test_long_begin_lines(spark):
    texts = ["-----BEGIN " + "AB " * 5_000 + "PRIVATE KEY-----", "-----BEGIN " + "AB " * 350_000 + "PRIVATE KEY-----",
             "-----BEGIN " + "AB " * 350_000, "-----BEGIN PRIVATE KEY-----x-----BEGIN RSA PRIVATE KEY-----"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets_scan.find_secrets(df).collect()}
    assert got == {0: [(0, len(texts[0]))], 1: [(0, len(texts[1]))], 2: [], 3: [(0, 27), (28, 59)]}
    assert {r.text for r in secrets_scan.redact(df).collect()} == {"[SECRET]", texts[2], "[SECRET]x[SECRET]"}


def test_many_matches_in_one_text(spark):
    rng = random.Random(2)
    parts, spans, clean, at = [], [], [], 0
    for i in range(100_000):
        gap = rng.choice([" é ", " - ", "\n", " x 日本 "])
        key = "AKIA" + "".join(rng.choice("ABC123") for _ in range(12 + i % 5))
        parts += [gap, key]
        clean += [gap, "[SECRET]"]
        spans.append((at + len(gap), at + len(gap) + len(key)))
        at = spans[-1][1]
    df = spark.createDataFrame([(1, "".join(parts), at)], "doc_id long, text string, n_chars long")
    assert [(s.start, s.end) for s in secrets_scan.find_secrets(df).first().spans] == spans
    row = secrets_scan.redact(df).first()
    assert row.text == "".join(clean) and row.n_chars == len(row.text)


def test_overlapping_spans_over_runs(spark):
    rules = (secrets_scan.Rule("a", "ab{3,9}c"), secrets_scan.Rule("b", "b{3}cd?"), secrets_scan.Rule("c", "c{1,2}d{2,}"))
    text = "".join(random.Random(3).choice(["abbbc", "bbbcd", "ccdd", "x", "é", "abbbcd"]) for _ in range(3000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    import re
    covered = [False] * len(text)
    for r in rules:
        for m in re.finditer(r.regex, text):
            covered[m.start():m.end()] = [True] * (m.end() - m.start())
    spans = sorted((m.start(), n, m.end()) for n, r in enumerate(rules) for m in re.finditer(r.regex, text))
    assert [tuple(s) for s in secrets_scan.find_secrets(df, rules).first().spans] == spans
    # spans that touch are marked each, spans that overlap once
    want, at = [], 0
    for start, _, end in spans:
        if start >= at:
            want += [text[at:start], "[SECRET]"]
        at = max(at, end)
    assert secrets_scan.redact(df, rules).first().text == "".join(want) + text[at:]


def test_rules_and_columns_that_are_refused(spark):
    for regex in ("(?:[A-Z]+ )*KEY", "(ab)+x", "(?:a|b(?:cd)*)x", "(?:abc){2,1000}"):
        with pytest.raises(ValueError, match="repeat"):
            secrets_scan.trigram_query(regex)
    secrets_scan.trigram_query("(?:abc){2,5}[x-z]+y?")
    df = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, Spans int")
    with pytest.raises(ValueError, match="already"):
        secrets_scan.find_secrets(df)
    assert secrets_scan.redact(df).columns == ["doc_id", "text", "Spans"]


# --------------------------------------------------------------- 6 token counts
def test_models_that_are_refused():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    token_count.check_model(model)
    # a message of the same field that follows is merged into the first one
    for change, said in ((b"\x12\x02\x18\x01", "byte-pair"), (b"\x1a\x02\x18\x00", "dummy"), (b"\x12\x03\xc0\x01\x01", "dummy"),
                         (b"\x0a\x06\x0a\x02zz\x18\x04", "user-defined"), (b"\x1a\x02\x20\x01", "identity"),
                         (b"\x1a\x02\x28\x00", "dummy")):
        with pytest.raises(ValueError, match=said):
            token_count.Merger(model + change)
