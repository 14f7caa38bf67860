"""Phrase collocations, mined with mergeable Misra-Gries summaries.

Texts are cut into pieces, pieces into words; phrases are runs of 2 to
``max_words`` words inside a piece.  Every part of a frequent phrase is
frequent, so all counts that are needed are those of frequent n-grams.

First pass: n-grams are dealt to hash partitions.  Tasks send, for each hash
partition, summaries (hash and count, without loss so far) and their masses; a
reducer knows the partition's whole mass before the first summary and merges
them with more counters than mass / threshold.  A merge that finds more
counters than that subtracts the first count that has no place from all, so
altogether less than the threshold is subtracted and every frequent n-gram
survives.  Survivors whose count plus what was subtracted stays below the
threshold cannot be frequent and go.  A reducer holds at most a few times its
counters, however many different n-grams there are.

The survivors are marked in a bit map of fixed size (``MAP_BITS`` at most)
that every task of the second pass gets.  A false mark costs a counter, never
a result: the second pass counts each marked n-gram exactly, by its words.

Scores are exact: decimals, and whole division.  Null text counts as empty, a
null language as ``und``; empty texts give nothing.  Repeated rows count each.
An empty table gives an empty result.  Ties go by count, then by phrase in
byte order.  Only the language and text columns are read, so further columns
of any name do not matter.  Texts of any length are counted whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Where a text is cut into pieces (line ends among them); fixed values.
PIECE_ENDS = rb"[.,;:!?\x0A-\x0D]+"
_ENDS = re.compile(PIECE_ENDS)
#: Stands for the end of a piece among the words; no word contains a full stop.
_END = b"."
MIN_PARTS, MAX_PARTS = 1 << 10, 1 << 14
MIN_BITS, MAP_BITS = 1 << 22, 1 << 28
#: Words handled at once, counters kept before they are sent, words known to a worker.
CHUNK, LOCAL, VOCABULARY = 1 << 17, 3 << 20, 1 << 18
ROWS = 1 << 16
#: Low bits of hashes that stay zero; n-grams of equal hashes can only add survivors.
UNUSED = np.uint64(8)
SUMMARY = "part int, kind int, mass long, data binary"
COUNTED = "lang string, phrase string, words int, f long"


# ------------------------------------------------------------------- words
class Vocabulary(dict):
    """Number of each word, given as it is met, with the words and their hashes by number.
    Number 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})
        self.words, self._hashes = [_END], array("Q", [0])

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self._hashes.append(xxhash.xxh64_intdigest(word))
        return n

    def hashes(self) -> np.ndarray:
        return np.array(self._hashes, np.uint64)


def tokens(text: str) -> list[bytes]:
    """Words of a text, in lower case (A-Z), with ends of pieces between them."""
    return _ENDS.sub(b" . ", text.encode().lower()).split()


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, Vocabulary]]:
    """(languages, language number and word number of every word, vocabulary), some texts at a time."""
    names: dict[str, int] = {}
    vocabulary = Vocabulary()
    ids: list[np.ndarray] = []
    langs: list[tuple[int, int]] = []
    held = 0

    def out():
        lang = np.repeat(np.array([x for x, _ in langs], np.int64), [n for _, n in langs])
        return list(names), lang, np.concatenate(ids), vocabulary
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            found = tokens(text.as_py() or "")
            found.append(_END)
            ids.append(np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found)))
            langs.append((names.setdefault("und" if lang is None else lang, len(names)), len(found)))
            held += len(found)
            if held >= CHUNK:
                yield out()
                ids, langs, held = [], [], 0
                if len(vocabulary) + len(names) > VOCABULARY:
                    names, vocabulary = {}, Vocabulary()
    if held:
        yield out()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def hashed(names: list[str], lang: np.ndarray, ids: np.ndarray, vocabulary: Vocabulary, most: int):
    """(hashes, whether the n-gram stands inside a piece) at every place, for 1, 2, ... words."""
    word = vocabulary.hashes()[ids]
    seed = np.array([xxhash.xxh64_intdigest(n, 1) for n in names], np.uint64)[lang]
    inside = one = ids != 0
    h = _mix(seed ^ word)
    for k in range(1, most + 1):
        yield h >> UNUSED << UNUSED, inside
        if k == most or len(h) < 2:
            return
        h = _mix(h[:-1] * np.uint64(3) + word[k:])
        inside = inside[:-1] & one[k:]


# -------------------------------------------------------------- first pass
def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts summed."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Summary as bytes: steps between sorted keys, and counts, each byte of them in a plane of its own."""
    steps = np.diff(keys >> UNUSED, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), 8).T).tobytes() for a in (steps, counts)]
    return zstandard.compress(b"".join(planes), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(p.T).reshape(-1).view(t) for p, t in zip(planes, (np.uint64, np.int64), strict=True))
    return np.cumsum(steps, dtype=np.uint64) << UNUSED, counts


class Summary:
    """Misra-Gries summary of weighted keys with room for ``capacity`` counters."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.subtracted = 0
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * self.capacity + ROWS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = counted(*(np.concatenate(a) for a in zip(*self.waiting, strict=True)))
        if len(keys) > self.capacity:
            less = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            keep = counts > less
            keys, counts = keys[keep], counts[keep] - less
            self.subtracted += int(less)
        self.waiting, self.held = [(keys, counts)], len(keys)
        return keys, counts

    def possible(self, threshold: int) -> np.ndarray:
        """Keys that may have reached the threshold."""
        if not self.waiting:
            return np.empty(0, np.uint64)
        keys, counts = self.merge()
        return keys[counts + self.subtracted >= threshold]


def _send(parts: int, most: int):
    def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bits = np.uint64(parts.bit_length() - 1)
        edges = np.searchsorted(keys >> (np.uint64(64) - bits), np.arange(parts + 1, dtype=np.uint64))
        part, kind, mass, data = [], [], [], []
        for p in np.flatnonzero(np.diff(edges)).tolist():
            lo, hi = edges[p], edges[p + 1]
            part += [p, p]
            kind += [0, 1]
            mass += [int(counts[lo:hi].sum()), None]
            data += [None, pack(keys[lo:hi], counts[lo:hi])]
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(mass, pa.int64()),
                                           pa.array(data, pa.binary())], names=["part", "kind", "mass", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for chunk in chunks(batches):
            here = np.concatenate([h[inside] for h, inside in hashed(*chunk, most)])
            if not len(here):
                continue
            rows.append(np.unique(here, return_counts=True))
            del here
            held += len(rows[-1][0])
            if held > LOCAL:
                rows = [counted(*(np.concatenate(a) for a in zip(*rows, strict=True)))]
                held = len(rows[0][0])
                if held > LOCAL // 4 * 3:
                    yield out(*rows.pop())
                    held = 0
        if rows:
            yield out(*counted(*(np.concatenate(a) for a in zip(*rows, strict=True))))
    return run


def _mark(keys: np.ndarray, parts: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of keys in the bit map; both lie in the part's own stretch."""
    per = np.uint64(bits.bit_length() - parts.bit_length())
    start = (keys >> (np.uint64(64) - np.uint64(parts.bit_length() - 1))) << per
    within = np.uint64((1 << int(per)) - 1)
    return (start | (keys >> np.uint64(8)) & within, start | (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & within)


def _survivors(parts: int, bits: int, threshold: int):
    stretch = bits // parts

    def out(part: int, summary: Summary | None) -> pa.RecordBatch:
        keys = summary.possible(threshold) if summary else np.empty(0, np.uint64)
        own = np.zeros(stretch, bool)
        for at in _mark(keys, parts, bits):
            own[at - np.uint64(part * stretch)] = True
        data = zstandard.compress(np.packbits(own, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())],
                                          names=["part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None
        for b in batches:
            for p, kind, m, data in zip(*(b.column(k) for k in range(4)), strict=True):
                if part != p.as_py():
                    if part is not None:
                        yield out(part, summary)
                    part, mass, summary = p.as_py(), 0, None
                if kind.as_py() == 0:
                    mass += m.as_py()
                    continue
                if summary is None:  # all masses came first
                    summary = Summary(mass // threshold + 1)
                summary.add(*unpack(data.as_py()))
        if part is not None:
            yield out(part, summary)
    return run


def _power(n: int, least: int, most: int) -> int:
    return min(most, max(least, 1 << max(0, n - 1).bit_length()))


def survivors(rows: DataFrame, threshold: int, most: int) -> tuple[np.ndarray, int, int]:
    """(bit map, parts, bits) that marks every n-gram found ``threshold`` times or more."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # words of two bytes at least: 5 n-grams for each two bytes, one in ``threshold`` of them frequent
    parts = _power(size * most // (2 * threshold) >> 14, MIN_PARTS, MAX_PARTS)
    bits = _power(size // 4, MIN_BITS, MAP_BITS)
    sent = rows.mapInArrow(_send(parts, most), SUMMARY)
    marked = (sent.repartition("part").sortWithinPartitions("part", "kind")
              .mapInArrow(_survivors(parts, bits, threshold), "part int, bits binary"))
    whole = np.zeros(bits // 8, np.uint8)
    stretch = bits // parts // 8
    for part, data in marked.collect():  # as many rows as parts, MAP_BITS bits in all
        whole[part * stretch:(part + 1) * stretch] = np.frombuffer(zstandard.decompress(bytes(data)), np.uint8)
    return whole, parts, bits


# ------------------------------------------------------------- second pass
def _count(shared, parts: int, bits: int, most: int):
    def marked(h: np.ndarray, own: np.ndarray) -> np.ndarray:
        found = None
        for at in _mark(h, parts, bits):
            hit = own[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
            found = hit if found is None else found & hit
        return found

    def rows(names, langs, starts, ids, vocabulary, k, counts) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(starts), ROWS):
            s = starts[lo:lo + ROWS]
            words = [vocabulary.words[i] for i in ids[s[:, None] + np.arange(k)].reshape(-1).tolist()]
            phrases = [b" ".join(words[i:i + k]).decode() for i in range(0, len(words), k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in langs[s].tolist()], pa.string()), pa.array(phrases, pa.string()),
                 pa.array(np.full(len(s), k, np.int32)), pa.array(counts[lo:lo + ROWS], pa.int64())],
                names=["lang", "phrase", "words", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(shared.value, np.uint8)
        for names, lang, ids, vocabulary in chunks(batches):
            n = np.bincount(lang[ids != 0], minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([""] * len(names), pa.string()),
                 pa.array([0] * len(names), pa.int32()), pa.array(n, pa.int64())], names=["lang", "phrase", "words", "f"])
            at = prior = number = None
            for k, (h, inside) in enumerate(hashed(names, lang, ids, vocabulary, most), 1):
                if at is None:
                    at = np.flatnonzero(inside)
                else:  # both parts of one word less must be marked
                    keep = np.zeros(len(ids) + 1, bool)
                    keep[at] = True
                    here = keep[at + 1]
                    prior, at = number[here], at[here]
                here = marked(h[at], own)
                at = at[here]
                if not len(at):
                    break
                # numbers of n-grams by their words: the number of the part before, and the last word
                key = (lang[at] if prior is None else prior[here]) * len(vocabulary.words) + ids[at + k - 1]
                _, first, number, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                yield from rows(names, lang, at[first], ids, vocabulary, k, counts)
    return run


def frequent(docs: DataFrame, threshold: int, most: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, phrase, words, f: n-grams of up to ``most`` words with f >= ``threshold``, exactly
    counted, and for each language a row of 0 words whose f is the number of its words."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    own, parts, bits = survivors(rows, threshold, most)
    shared = docs.sparkSession.sparkContext.broadcast(own.tobytes())
    found = rows.mapInArrow(_count(shared, parts, bits, most), COUNTED)
    return (found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
            .where((F.col("words") == 0) | (F.col("f") >= threshold)))


# ------------------------------------------------------------------ scores
def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, inside_percent: int = 100,
                 top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    counts = stored(frequent(docs, min_count, max_words, text_col, lang_col), "phrase-counts")
    sizes = counts.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    grams = counts.where(F.col("words") > 0)
    found = grams.where(F.col("words") > 1).select("lang", "phrase", "words", F.col("f").alias("a"))
    w = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), w.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    heads = grams.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = grams.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(sizes, "lang")
    big = {c: F.col(c).cast("decimal(18,0)").alias(c) for c in ("a", "n", "l", "r")}
    exact = exact.select("lang", "phrase", "k", *[F.col(c) for c in ("a", "l", "r", "n")],
                         (F.lit(1000).cast("decimal(4,0)") * big["a"] * big["n"]).alias("over"),
                         (big["l"] * big["r"]).alias("under"))
    exact = exact.select("*", F.expr("over div under").alias("score"))
    best = (exact.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
            .select("lang", "phrase", "x.*"))
    # every shorter phrase inside a found one, with the largest count of the longer ones
    inner = found.where(F.col("words") > 2).select("lang", "a", "words", w.alias("w"))
    inner = inner.select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at"))
    inner = inner.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(
        F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of several shares of a language first, so that no task sorts a whole language
    shares = docs.sparkSession.sparkContext.defaultParallelism * 4
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    kept = (kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("place") <= top))
    return (kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
