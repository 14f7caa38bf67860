"""Prefix BPE, filter audit and collocations against the library or brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and further columns of clashing names."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chargepulse.llm import collocations, filter_audit, prefix_bpe, queries

WORDS = "the of and to in that it was for on are with as his they at be this have from".split()
ODD = [None, "", " ", "\n\n", "x", "Straße  été\t日本語 🎉\r\n", "aaaaaaaaaaaaaaa" * 9, "!!??", "\x00\x01\x1c\x85  x",
       "it's we'LL don't 'tis 1234 a1b2", "Σίσυφος ΣΟΦΟΣ İstanbul ǰ J̌ é", "̸ ≠",
       "<|endoftext|>a<|startoftext|> b <|endoftext|", "</w> a</w>b <w>/</w>", "ﬁ ½ Ⅷ ² ٠١ ᾳ ΐ"]


# ------------------------------------------------------------- 11 prefix BPE
@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    own = Tokenizer.from_file(path)
    own.no_padding()
    own.no_truncation()
    return own


def by_library(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_prefix_bpe_matches_library(spark, path, library):
    rng = random.Random(3)
    letters = "abcdeeinorst" + "ÄéßñИб日語한🎉'.,-#0123"
    texts = [*ODD, *("".join(rng.choice(letters + "   ") for _ in range(rng.randint(1, 200))) for _ in range(400)),
             " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(20, 90))) for _ in range(300))]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "no id", 0, "x"), (3, "x", 0, "x"), (3, "x", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, ids string").repartition(5)
    got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in prefix_bpe.encode_decode(df, path).collect())
    want = Counter()
    for i, t, *_ in rows:
        ids, decoded = by_library(library, t)
        want[i, np.array(ids, "<u4").tobytes(), decoded] += 1
    assert got == want
    assert prefix_bpe.encode_decode(df.limit(0), path).columns == ["doc_id", "ids", "decoded"]
    assert prefix_bpe.encode_decode(df.limit(0), path).count() == 0


def test_prefix_bpe_of_every_letter_and_a_long_word(path, library):
    own = prefix_bpe.PrefixEncoder(open(path, encoding="utf-8").read())
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(chars), 4096):
        text = " ".join(f"a{c}'s{c}9" for c in chars[lo:lo + 4096])
        assert np.frombuffer(own.encode(text), "<u4").tolist() == by_library(library, text)[0], hex(ord(chars[lo]))
    rng = random.Random(8)
    for text in ("a" * 100_000, "".join(rng.choice("abcdefghij") for _ in range(100_000))):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == by_library(library, text)[0]


def test_every_prefix_has_one_last_token(path, library):
    """The stored token is the last one of the prefix's own encoding."""
    merges = prefix_bpe.Merges(open(path, encoding="utf-8").read())
    plain = {merges.symbols[i]: i for i in merges.reached}
    rng = random.Random(4)
    for _ in range(200):
        word = "".join(rng.choice("aaabinnotther") for _ in range(12))
        ids = [plain[c] for c in word]
        while True:  # merges in the order of their ranks
            ranked = [(merges.rank.get(a * merges.size + b, prefix_bpe.NEVER), k) for k, (a, b) in enumerate(zip(ids, ids[1:]))]
            if not ranked or min(ranked)[0] == prefix_bpe.NEVER:
                break
            k = min(ranked)[1]
            ids[k:k + 2] = [plain[merges.symbols[ids[k]] + merges.symbols[ids[k + 1]]]]
        assert all(merges.fit(a, b) for a, b in zip(ids, ids[1:]))


def test_other_tokenizers_are_refused(path):
    import json

    spec = json.loads(open(path, encoding="utf-8").read())
    for change in ({"decoder": {"type": "ByteLevel"}}, {"model": spec["model"] | {"dropout": 0.1}},
                   {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}},
                   {"normalizer": None}):
        with pytest.raises(ValueError):
            prefix_bpe.Merges(json.dumps(spec | change))


# ------------------------------------------------------------ 12 filter audit
def plain_audit(rows, labels):
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        steps, total = [], Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                steps.append((f, "".join(order), step, len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                              sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(part, *s[1:], total[s[0]]) for s in steps]
    return sorted(out)


def audit_rows():
    rng = random.Random(2)

    def text():
        n = rng.choice([3, 99, 100, 101, 150])
        words = [rng.choice(WORDS) + (str(rng.randint(0, 200)) if rng.random() < 0.9 else "") for _ in range(n)]
        mark = rng.choice(["", "", "#", "$ %", "|"])
        return (" ".join(words) + mark).upper() if rng.random() < 0.3 else rng.choice([" ", "\n", "\t "]).join(words) + mark
    rows = [(i, text(), rng.choice(["en", "de", None, ""])) for i in range(120)]
    rows += [(200 + i, rows[i % 7][1], rng.choice(["en", "fr"])) for i in range(60)]
    rows += [(300, None, "en"), (301, "", "en"), (302, "", None), (None, rows[0][1], "en"), (None, "alone", "de"),
             rows[3], rows[3], (3, rows[3][1], "zz"), (400, "A " * 30_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 260, 2)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    return rows, labels


def test_filter_audit_matches_brute_force(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n long, part string")
    marks = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = sorted(tuple(r) for r in filter_audit.audit(docs.repartition(4), marks).collect())
    assert got == plain_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    none = filter_audit.audit(docs, marks.limit(0))
    assert {(r.good_lost, r.toxic_lost) for r in none.collect()} == {(0, 0)}


def test_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "x")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, marks, checks={"Z": lambda text, words: text == "a"}, duplicate="Y").collect()
    assert sorted((r.filter_order, r.step, r.removed, r.shapley) for r in got) == [
        ("YZ", 1, 1, 1), ("YZ", 2, 1, 3), ("ZY", 1, 2, 3), ("ZY", 2, 0, 1)]
    with pytest.raises(ValueError):
        filter_audit.audit(docs, marks, duplicate="A")


def test_shapley_is_the_mean_over_orders():
    rng = random.Random(6)
    for k in (1, 2, 3, 4, 5):
        value = filter_audit.removals({s: rng.randint(0, 10 ** 15) for s in range(1 << k)}, k)
        mean = [Fraction(0)] * k
        orders = list(permutations(range(k)))
        for order in orders:
            before = 0
            for i in order:
                mean[i] += Fraction(value[before | 1 << i] - value[before], len(orders))
                before |= 1 << i
        assert filter_audit.shapley(value, k) == mean


# ------------------------------------------------------------ 13 collocations
def plain_collocations(rows, low, most=5, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(most, len(words) - i) + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {g: a for g, a in f.items() if a >= low}
    out = []
    for lang in n:
        mine = {g: a for (x, g), a in found.items() if x == lang and len(g) > 1}
        inner = {b[i:i + m] for b, a in mine.items() for m in range(2, len(b)) for i in range(len(b) - m + 1)
                 if a >= mine[b[i:i + m]]}
        best = []
        for g, a in mine.items():
            if g not in inner:
                score, _, left, right = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]],
                                             f[lang, g[k:]]) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s)
                for r, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(9)
    stock = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(2, 9))) for _ in range(30)]
    rows = [(rng.choice(["en", "de", None, "und", ""]),
             "".join(rng.choice([*stock, "The Of", "x\ty", rng.choice(WORDS), "日本 語\x00 É"]) + rng.choice([" ", ", ", ". ", "\n", "?!", "  "])
                     for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return rows + [("en", None), (None, ""), ("de", " \t. ,"), ("fr", "a b " * 20_000), rows[0], rows[0]]


@pytest.mark.parametrize("low", [2, 7, 40])
def test_collocations_match_brute_force(spark, low):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string")
    got = sorted(tuple(r) for r in collocations.collocations(docs.repartition(6), min_count=low).collect())
    assert got == plain_collocations(rows, low)
    few = collocations.collocations(docs, min_count=low, top=3).collect()
    assert sorted(tuple(r) for r in few) == plain_collocations(rows, low, top=3)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(docs).count() == 0


def test_small_chunks_and_summaries_give_the_same(spark, monkeypatch):
    """Counts do not depend on how words are cut into chunks."""
    rows = phrase_rows()[:40]
    batch = __import__("pyarrow").RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    own = np.full(collocations.MIN_BITS // 8, 255, np.uint8)  # everything marked
    shared = type("B", (), {"value": own.tobytes()})
    totals = []
    for size in (10, 1 << 20):
        monkeypatch.setattr(collocations, "CHUNK", size)
        total = Counter()
        for b in collocations._count(shared, collocations.MIN_PARTS, collocations.MIN_BITS, 5)([batch]):
            for r in b.to_pylist():
                total[r["lang"], r["phrase"], r["words"]] += r["f"]
        totals.append(total)
    assert totals[0] == totals[1]


def test_every_frequent_key_survives_a_full_summary():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 1 << 63, 200_000).astype(np.uint64),
                           np.repeat(np.arange(40, dtype=np.uint64), 500)])
    rng.shuffle(keys)
    threshold = 500
    s = collocations.Summary(len(keys) // threshold + 1)
    for lo in range(0, len(keys), 3000):
        s.add(*np.unique(keys[lo:lo + 3000], return_counts=True))
        if lo % 9000 == 0:
            s.merge()
    s.merge()
    assert s.subtracted < threshold and s.held <= s.capacity
    assert set(range(40)) <= set(s.possible(threshold).tolist())


def test_summaries_are_packed_without_loss():
    keys, counts = np.array([1 << 8, 5 << 8, 1 << 63], np.uint64), np.array([3, 1 << 40, 7])
    k, c = collocations.unpack(collocations.pack(keys, counts))
    assert k.tolist() == keys.tolist() and c.tolist() == counts.tolist()


# ---------------------------------------------------------------------- queries
def test_queries_have_the_contract_columns(spark, library):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_prefix_bpe(spark, small).collect()}
    for d in docs:
        ids, decoded = by_library(library, d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
