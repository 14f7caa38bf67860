"""Benchmark decontamination by a prefix-filtered set join of word windows.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.
A window is ``window`` consecutive words of a benchmark item; an item of
fewer words is one window.  A document word inside any occurrence of a window
is hit.

Each window is the set of its shingles (``SHINGLE`` words, or all of a
shorter window).  Shingles are ordered by rarity, counted over all documents,
ties to the smaller shingle.  A window is contained only if all of its
shingles are, so one prefix token is necessary: its rarest shingle.  Document
shingles are joined with these prefix tokens; the shingle's place in the
window gives where the window must begin (positional bound) and end (length
bound), and the words of that stretch are compared one by one.

The benchmark is the stated query set.  It is dealt by hash into blocks of
about ``BLOCK`` windows, so that what is broadcast has a bound whatever the
benchmark's size; each block is matched against all documents and a document
carries its hits from block to block.

Nulls: a null text has no words, an item without id takes no part, a null
document id stays null.  Repeated documents are repeated in the result;
repeated items count once.  Empty tables: without items nothing is hit.
Texts of any length are read whole.  Further columns of the documents pass
through; those of the benchmark are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

WINDOW = 10
SHINGLE = 3
BLOCK = 1 << 16
#: Non-word ASCII to space, A-Z to a-z.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words): the distinct windows of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words_of(text)
                out = [b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))] if w else []
                for at in range(0, len(out), 10_000):
                    part = out[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), b.schema.field(0).type), pa.array(part, pa.binary())],
                        names=["item", "words"])
    schema = T.StructType([T.StructField("item", items.schema[id_col].dataType), T.StructField("words", T.BinaryType())])
    return items.where(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(run, schema).distinct()


class Index:
    """One block of windows as arrays: words as numbers from 1, shingles as numbers
    packed in an integer, windows grouped by their prefix token."""

    def __init__(self, rows: list[tuple[object, bytes]], max_window: int):
        self.items = [r[0] for r in rows]
        split = [r[1].split() for r in rows]
        self.vocab: dict[bytes, int] = {}
        for w in sorted({x for s in split for x in s}):
            self.vocab[w] = len(self.vocab) + 1
        self.bits = max(1, int(len(self.vocab) + 1).bit_length())
        if self.bits * SHINGLE > 63:
            raise ValueError("a block holds too many words")
        self.length = np.array([len(s) for s in split], np.int64)
        self.words = np.zeros((len(rows), max(max_window, 1)), np.int64)
        for k, s in enumerate(split):
            self.words[k, :len(s)] = [self.vocab[x] for x in s]
        self.sizes = np.minimum(self.length, SHINGLE)
        self.shingles = {}
        for n in range(1, SHINGLE + 1):
            own = [self._pack(self.words[k, :self.length[k]], n) for k in np.flatnonzero(self.sizes == n)]
            if own:
                self.shingles[n] = np.unique(np.concatenate(own))
        self.prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def _pack(self, ids: np.ndarray, n: int) -> np.ndarray:
        """The shingle that begins at each place, negative where a word is unknown."""
        if len(ids) < n:
            return np.empty(0, np.int64)
        out = np.zeros(len(ids) - n + 1, np.int64)
        known = np.ones(len(out), bool)
        for k in range(n):
            part = ids[k:k + len(out)]
            out = (out << self.bits) | part
            known &= part > 0
        return np.where(known, out, -1)

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Order each window's shingles by rarity and keep the first as its prefix token."""
        chosen: dict[int, list[tuple[int, int, int]]] = {}
        for k in range(len(self.items)):
            n = int(self.sizes[k])
            own = self._pack(self.words[k, :self.length[k]], n).tolist()
            least, at = min((counts.get((n, s), 0), s, i) for i, s in enumerate(own))[1:]
            chosen.setdefault(n, []).append((least, at, k))
        for n, rows in chosen.items():
            a = np.array(sorted(rows), np.int64)
            keys, first = np.unique(a[:, 0], return_index=True)
            self.prefix[n] = (keys, np.append(first, len(a)), a[:, 1], a[:, 2])

    def number(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All documents' words as numbers, a 0 after each document; where documents begin; how many words."""
        get, flat, sizes = self.vocab.get, [], []
        for t in texts:
            w = words_of(t)
            flat += [get(x, 0) for x in w]
            flat.append(0)
            sizes.append(len(w))
        n = np.array(sizes, np.int64)
        return np.array(flat, np.int64), np.concatenate(([0], np.cumsum(n + 1)))[:-1], n

    def count(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for n, known in self.shingles.items():
            packed = self._pack(ids, n)
            packed = packed[packed >= 0]
            at = np.minimum(np.searchsorted(known, packed), len(known) - 1)
            hit = np.bincount(at[known[at] == packed], minlength=len(known))
            some = np.flatnonzero(hit)
            yield n, known[some], hit[some]

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every occurrence of a window."""
        places, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        padded = np.concatenate([ids, np.zeros(self.words.shape[1], np.int64)])
        for n, (keys, first, offset, window) in self.prefix.items():
            packed = self._pack(ids, n)
            pos = np.flatnonzero(packed >= 0)
            at = np.minimum(np.searchsorted(keys, packed[pos]), len(keys) - 1)
            ok = keys[at] == packed[pos]
            pos, at = pos[ok], at[ok]
            many = first[at + 1] - first[at]
            # every window of the token, in slices that bound memory
            ends = np.cumsum(many)
            for lo in range(0, int(ends[-1]) if len(ends) else 0, 1 << 18):
                flat = np.arange(lo, min(lo + (1 << 18), int(ends[-1])))
                row = np.searchsorted(ends, flat, side="right")
                k = first[at[row]] + flat - (ends[row] - many[row])
                start, w = pos[row] - offset[k], window[k]
                fits = (start >= 0) & (start + self.length[w] <= len(ids))
                start, w = start[fits], w[fits]
                for j in range(self.words.shape[1]):
                    want = self.words[w, j]
                    same = (want == 0) | (padded[start + j] == want)
                    start, w = start[same], w[same]
                places.append(start)
                found.append(w)
        return np.concatenate(places), np.concatenate(found)


def _count(index, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for b in batches:
            ids, _, _ = index.value.number(b.column(0).to_pylist())
            for n, keys, hits in index.value.count(ids):
                for k, h in zip(keys.tolist(), hits.tolist(), strict=True):
                    total[n, k] = total.get((n, k), 0) + h
        if total:
            yield pa.RecordBatch.from_arrays([
                pa.array([n for n, _ in total], pa.int32()), pa.array([k for _, k in total], pa.int64()),
                pa.array(list(total.values()), pa.int64())], names=["n", "shingle", "hits"])
    return run


def _merge(a: list[int], start: np.ndarray, length: np.ndarray) -> list[int]:
    """Union of the stretches in ``a`` (start, end, start, end ...) and the given ones."""
    s = np.concatenate([np.array(a[0::2], np.int64), start])
    e = np.concatenate([np.array(a[1::2], np.int64), start + length])
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return np.column_stack([s[new], np.append(e[:-1][new[1:]], e[-1])]).ravel().tolist()


def _match(index, text_col: str, n_words: str, hits: str, items: str, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches:
            names = b.schema.names
            ids, first, n = ix.number(b.column(names.index(text_col)).to_pylist())
            place, window = ix.occurrences(ids)
            doc = np.searchsorted(first, place, side="right") - 1
            old_hits = b.column(names.index(hits)).to_pylist()
            old_items = b.column(names.index(items)).to_pylist()
            order = np.argsort(doc, kind="stable")
            at = np.searchsorted(doc[order], np.arange(len(n) + 1))
            for d in np.unique(doc).tolist():
                own = order[at[d]:at[d + 1]]
                old_hits[d] = _merge(old_hits[d], place[own] - first[d], ix.length[window[own]])
                old_items[d] = sorted({*old_items[d], *(ix.items[w] for w in np.unique(window[own]))})
            new = {n_words: pa.array(n), hits: pa.array(old_hits, pa.list_(pa.int64())),
                   items: pa.array(old_items, pa.list_(item_type))}
            yield pa.RecordBatch.from_arrays(
                [new.get(c, b.column(k)) for k, c in enumerate(names)], names=names)
    return run


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       block: int = BLOCK) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with three more columns: words, hit stretches (start, end, start, end ...
    as word numbers) and ids of the items with occurring windows.  Also returns the
    names of these columns, which avoid those of ``docs``."""
    spark = docs.sparkSession
    names = {k: fresh(docs, k) for k in ("n_words", "hits", "items")}
    kind = benchmark.schema[item_id].dataType
    rows = stored(windows(benchmark, item_id, item_text, window)
                  .select("item", "words", F.xxhash64("item", "words").alias("h")), "windows")
    total = rows.count()
    blocks = max(1, -(-total // block))
    out = docs.select("*", F.lit(0).cast("long").alias(names["n_words"]),
                      F.array().cast("array<long>").alias(names["hits"]),
                      F.array().cast(T.ArrayType(kind)).alias(names["items"]))
    item_type = pa.string() if isinstance(kind, T.StringType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.int64()
    for k in range(blocks):
        own = [(r.item, bytes(r.words)) for r in
               rows.where(F.pmod("h", F.lit(blocks)) == k).orderBy("item", "words").collect()]
        index = Index(own, window)
        shared = spark.sparkContext.broadcast(index)
        counts = (docs.select(text_col).mapInArrow(_count(shared, text_col), "n int, shingle long, hits long")
                  .groupBy("n", "shingle").agg(F.sum("hits").alias("hits")).collect())
        index.choose({(r.n, r.shingle): r.hits for r in counts})
        shared = spark.sparkContext.broadcast(index)
        out = out.mapInArrow(_match(shared, text_col, names["n_words"], names["hits"], names["items"], item_type),
                             out.schema)
        if k + 1 < blocks:
            out = stored(out, "decontamination")
    return out, names


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", **kw) -> DataFrame:
    """``id_col``, n_words, n_hit, items (array) and hits (array of start, end) for every row of ``docs``."""
    marked, c = mark_contamination(docs.select(id_col, text_col), benchmark, window, text_col, **kw)
    n_hit = F.aggregate(F.transform(F.col(c["hits"]), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                        F.lit(0).cast("long"), lambda s, x: s + x)
    return marked.select(id_col, F.col(c["n_words"]).alias("n_words"), n_hit.alias("n_hit"),
                         F.col(c["items"]).alias("items"), F.col(c["hits"]).alias("hits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                      **kw) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    marked, c = mark_contamination(docs, benchmark, window, text_col, **kw)
    return marked.where(F.size(c["hits"]) == 0).select(*docs.columns)
