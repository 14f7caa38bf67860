"""Token counts by heap-and-linked-list byte-pair merging.

Counts the tokens a sentencepiece BPE model would give, without making ids: a
piece of text starts as a linked list of its characters; a heap gives the
adjacent pair of the lowest rank (highest score, ties to the leftmost), which
is merged until no pair is left.  The count is initial symbols minus merges,
where a character outside the vocabulary stands for its UTF-8 bytes.

No piece of such a model has a space mark after another character, and a
character that no piece holds (such as a line feed) never merges, so a text
falls into parts that merge on their own: each part is merged once and its
count kept in a table of at most ``CACHE`` parts a worker, which is emptied
when full.  Both properties are checked when the model is read.

Supported are models with identity normalisation that keep extra white space,
with byte fallback and a dummy prefix, and without user-defined symbols; other
models are refused.  Special strings in a text are plain text, as the library
treats them by default.

Null text counts as empty: 0 bytes, 0 tokens.  Repeated rows are repeated, an
empty table gives an empty result, texts are counted whole, and only the id
and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
CACHE = 400_000
CACHED_PART = 64
MAX_MODEL = 64 << 20


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out
    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at:at + size]
        at += size


#: Numbers of the public model format: fields, model types and piece types; fixed values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TYPE, USER_DEFINED = 3, 4
MODEL_TYPE, BPE, SUFFIX_MARK = 3, 2, 24
CHARS_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def check_model(model: bytes) -> None:
    """Refuse models whose counts would need more than merges within parts."""
    top = list(fields(model))
    trainer = dict(x for n, v in top if n == TRAINER for x in fields(v))
    normal = dict(x for n, v in top if n == NORMALIZER for x in fields(v))
    if trainer.get(MODEL_TYPE, 1) != BPE:
        raise ValueError("only byte-pair models are supported")
    if any(dict(fields(v)).get(PIECE_TYPE) == USER_DEFINED for n, v in top if n == PIECES):
        raise ValueError("user-defined symbols are not supported")
    if not normal.get(DUMMY_PREFIX, 1) or not normal.get(ESCAPE_SPACES, 1) or trainer.get(SUFFIX_MARK, 0):
        raise ValueError("only models with a dummy prefix and space marks before words are supported")
    if normal.get(REMOVE_SPACES, 1) or normal.get(CHARS_MAP):
        raise ValueError("only identity normalisation that keeps extra white space is supported")


class Merger:
    """The ranks of one model, and the counting of texts."""

    def __init__(self, model: bytes):
        import sentencepiece

        check_model(model)
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            self.rank[sp.id_to_piece(i)] = -sp.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("pieces with an inner space mark are not supported")
        probe = "a  b\tﬁ \n"  # a ligature that other normalisations would change
        if sp.encode(probe, out_type=str) and sp.decode(sp.encode(probe)) != probe or not sp.is_byte(sp.piece_to_id("<0x0A>")):
            raise ValueError("only identity normalisation with byte fallback is supported")
        self.line_feed_alone = not any("\n" in p for p in self.rank)
        self.cache: dict[str, int] = {}

    def part(self, text: str) -> int:
        """Tokens of one part: symbols minus merges."""
        rank = self.rank
        n = len(text)
        count = n
        for ch in text:
            if ch not in rank:
                count += len(ch.encode("utf-8", "surrogatepass")) - 1
        if n < 2:
            return count
        symbol: list[str] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbol[i] + symbol[i + 1]
            r = rank.get(pair)
            if r is not None:
                heap.append((r, i, pair))
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            # out of date if either side was merged meanwhile
            if not symbol[i] or j >= n or symbol[i] + symbol[j] != pair:
                continue
            symbol[i], symbol[j] = pair, ""
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = pair + symbol[k]
                r = rank.get(new)
                if r is not None:
                    heappush(heap, (r, i, new))
            h = before[i]
            if h >= 0:
                new = symbol[h] + pair
                r = rank.get(new)
                if r is not None:
                    heappush(heap, (r, h, new))
        return count

    def _cached(self, key: str) -> int:
        got = self.cache.get(key)
        if got is None:
            got = self.part(key)
            if len(key) <= CACHED_PART:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[key] = got
        return got

    def count(self, text: str) -> int:
        if not text:
            return 0
        get, total = self.cache.get, 0
        lines = (MARK + text.replace(" ", MARK)).split("\n") if self.line_feed_alone else [MARK + text.replace(" ", MARK)]
        total += len(lines) - 1
        for line in lines:
            head, *rest = line.split(MARK)
            if head:
                total += self._cached(head)
            marks = MARK
            for word in rest[:-1]:
                if word:
                    word = marks + word
                    marks = MARK
                    total += get(word) or self._cached(word)
                else:
                    marks += MARK
            if rest:
                total += self._cached(marks + rest[-1])
        return total


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    with open(model_path, "rb") as f:
        model = f.read(MAX_MODEL + 1)
    if len(model) > MAX_MODEL:
        raise ValueError(f"model over {MAX_MODEL} bytes")
    Merger(model)  # refused here rather than in a task
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(shared.value)
        for b in batches:
            n = np.fromiter((merger.count(t.as_py() or "") for t in b.column(1)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(n > limit)],
                                             names=[id_col, "n_bytes", "n_tokens", "over_limit"])
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    schema = T.StructType([rows.schema[id_col], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return rows.mapInArrow(run, schema)
