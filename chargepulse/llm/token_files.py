"""Token ids in binary files of independent zstandard frames.

A container is one frame per document (its ids as little-endian unsigned
32-bit integers), then a skippable frame with the documents' ids, then the
seek table in the layout of the public zstandard seekable format: a skippable
frame of compressed size, decompressed size and checksum (low half of the
content's XXH64) per frame, the number of frames, a flag byte and the magic
number.  A reader goes from the end: the table tells where each document's
frame is, so only the requested ones are decompressed, and the checksum is
verified.  A file is a row of containers, so that a writer keeps no more than
about ``CONTAINER`` bytes.

Files are written by Spark's own text writer, so that its committer covers
lost executors and any file system will do: a record is a container without
its last byte, and the line separator is that byte.

Documents are written in ascending id order (null ids first, repeated ids in
the order read).  Null text counts as empty: only the end id.  An empty table
gives no document.  Texts are encoded whole.  Only the id and text columns
are read.

The tokenizer splits at white space and drops it, and lower-cases, so the
words between spaces and line feeds are encoded once each by the library and
kept in a table of about ``CACHE`` words a worker.  Runs of Latin letters go
straight to the library's model: they are one pre-token each.
This holds for tokenizers of that kind only; the pipeline of the tokenizer is
checked when it is read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

#: Fixed values of the zstandard formats.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

LAST_BYTE = "\u008f"
CONTAINER = 8 << 20
FILE_BYTES = 16 << 20
CACHE = 500_000
CACHED_WORD = 48
#: First bytes of the combining marks U+0300 to U+037F.
_MARKS = (b"\xcc", b"\xcd")
_MARK = r"!-&(-/:-@\[-`{-~"
_LETTER = "a-z\xdf-\xf6\xf8-\xff"
#: Runs of such letters, runs of ASCII punctuation without apostrophe and single
#: digits are always separate tokens beside each other; from anything else on, the
#: rest of the word is one part.
_PARTS = re.compile(rf"[{_LETTER}]++(?=[{_MARK}0-9]|\Z)|[0-9](?=[{_LETTER}{_MARK}0-9]|\Z)"
                    rf"|[{_MARK}]++(?=[{_LETTER}0-9]|\Z)|.+", re.S)
_PLAIN = re.compile(rf"[{_LETTER}]+|[0-9]|[{_MARK}]+")
#: Punctuation behind an ASCII letter up to the end of the word.
_TRAILING = re.compile(rb"[%s](?<=[a-z].)[%s]*+(?=[ \n]|\Z)" % ((_MARK.encode(),) * 2))
MAX_TOKENIZER = 64 << 20
#: What the tokenizer takes as tokens before merging; fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FILES_PER_GROUP = 4096


# ------------------------------------------------------------------- format
def pack_container(ids: list[int | None], frames: list[bytes], sizes: list[int], checksums: list[int]) -> bytes:
    """One container of documents' frames."""
    known = bytes(i is not None for i in ids)
    own = struct.pack(f"<{len(ids)}q", *(i or 0 for i in ids)) + known
    entries = b"".join(struct.pack("<III", len(f), n, c) for f, n, c in zip(frames, sizes, checksums, strict=True))
    table = entries + struct.pack("<IBI", len(frames), CHECKSUMS, SEEK_MAGIC)
    return b"".join([*frames, struct.pack("<II", SKIPPABLE, len(own)), own,
                     struct.pack("<II", SEEK_TABLE, len(table)), table])


def containers(data: bytes) -> list[tuple[int, np.ndarray, list[int | None]]]:
    """(begin, table rows, document ids) of each container in a file, in order."""
    found, end = [], len(data)
    while end:
        n, flags, magic = struct.unpack_from("<IBI", data, end - 9)
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table")
        at = end - 9 - 12 * n
        if struct.unpack_from("<II", data, at - 8) != (SEEK_TABLE, 12 * n + 9):
            raise ValueError("damaged seek table")
        rows = np.frombuffer(data, "<u4", 3 * n, at).reshape(n, 3)
        at -= 8 + 9 * n
        ids = struct.unpack_from(f"<{n}q", data, at)
        known = data[at + 8 * n:at + 9 * n]
        begin = at - 8 - int(rows[:, 0].sum(dtype=np.int64))
        found.append((begin, rows, [i if k else None for i, k in zip(ids, known, strict=True)]))
        end = begin
    return found[::-1]


def read_documents(data: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of the documents of a file, or of the ``wanted`` ones only."""
    unpack = zstandard.ZstdDecompressor()
    for begin, rows, ids in containers(data):
        at = begin + np.concatenate(([0], np.cumsum(rows[:, 0], dtype=np.int64)))
        for k, i in enumerate(ids):
            if wanted is not None and i not in wanted:
                continue
            raw = unpack.decompress(data[at[k]:at[k + 1]], max_output_size=int(rows[k, 1]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(rows[k, 2]) or len(raw) != int(rows[k, 1]):
                raise ValueError(f"document {i}: checksum does not match")
            yield i, np.frombuffer(raw, "<u4")


# ------------------------------------------------------------------- encode
def check_tokenizer(tokenizer: str) -> None:
    """Refuse tokenizers whose tokens could depend on more than a lower-cased word."""
    spec = json.loads(tokenizer)
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    if steps != ["NFC", "Replace", "Lowercase"] or splits[0].get("type") != "Split" or \
            splits[0].get("behavior") != "Removed" or not splits[0].get("invert") or \
            splits[0]["pattern"].get("Regex") != WORD_PATTERN or \
            [p.get("type") for p in splits[1:]] != ["ByteLevel"] or splits[1].get("add_prefix_space") or \
            splits[1].get("use_regex") or spec.get("truncation") or spec.get("padding") or \
            any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"] != t["content"].lower()
                or set(t["content"]) & set(" \n") for t in spec.get("added_tokens", [])):
        raise ValueError("this tokenizer does not work word by word")


class Words(dict):
    """Ids (as bytes) of words (as bytes).  The table is bounded by two generations: a word
    found in the old one moves to the new one, which becomes the old one when it is full."""

    def __init__(self, tokenizer):
        super().__init__()
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.old: dict[bytes, bytes] = {}
        # the characters that the library puts for the bytes of plain parts
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        chars = [chr(c) for c in range(256)]
        for c in range(0xC0, 0x100):
            chars[0xC3], chars[c - 0x40] = level.pre_tokenize_str(chr(c))[0][0]
        self.chars = "".join(chars)

    def _encode(self, part: str) -> bytes:
        if _PLAIN.fullmatch(part):  # one pre-token: straight to the library's model
            ids = [t.id for t in self.model.tokenize(charmap_decode(part.encode(), "strict", self.chars)[0])]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            if not text.isascii() and max(text) <= "\xff":
                text = text.lower()
            if not _PLAIN.fullmatch(text) and len(parts := _PARTS.findall(text)) > 1:
                ids = b"".join([self[x.encode()] for x in parts])
            else:
                ids = self._encode(text)
        if len(word) <= CACHED_WORD:
            self[word] = ids
        return ids

    def trim(self) -> None:
        """Bound the table."""
        if len(self) > CACHE // 2:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of texts as bytes."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Words(self.tokenizer)

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8", "replace")
        low = raw.lower()
        if any(x in low for x in self.added):
            # strings of added tokens are found in the text as it is
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # the tokenizer lower-cases; without combining marks A-Z can go first
        if not any(m in raw for m in _MARKS):
            raw = low
        self.words.trim()
        return b"".join(map(self.words.__getitem__, _TRAILING.sub(rb" \g<0>", raw).replace(b"\n", b" ").split(b" ")))


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    """The worker's encoder, kept for its later tasks."""
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def _encode(shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(shared.value), struct.pack("<I", end_id)
        pack = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                raw = [own.encode(t) + end for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([pack.compress(r) for r in raw], pa.binary()),
                    pa.array([len(r) for r in raw], pa.int64()),
                    pa.array([xxhash.xxh64_intdigest(r) & 0xFFFFFFFF for r in raw], pa.int64())],
                    names=["id", "frame", "size", "checksum"])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[list] = [[], [], [], []]
    held = 0

    def out() -> pa.RecordBatch:
        whole = pack_container(*rows)
        for r in rows:
            r.clear()
        return pa.RecordBatch.from_arrays([pa.array([whole[:-1]], pa.binary())], names=["value"])

    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            for own, v in zip(rows, row, strict=True):
                own.append(v)
            held += len(row[1])
            if held >= CONTAINER:
                yield out()
                held = 0
    if rows[0]:
        yield out()


def write_tokens(docs: DataFrame, tokenizer_path: str, out_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every text and write the files under ``out_path``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read(MAX_TOKENIZER + 1)
    if len(tokenizer) > MAX_TOKENIZER:
        raise ValueError(f"tokenizer over {MAX_TOKENIZER} characters")
    check_tokenizer(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    frames = stored(rows.mapInArrow(_encode(shared, end_id), "id long, frame binary, size long, checksum long")
                    .withColumn("row", F.monotonically_increasing_id()), "token-frames")
    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    (frames.repartitionByRange(files, "id", "row").sortWithinPartitions("id", "row")
     .select("id", "frame", "size", "checksum").mapInArrow(_pack, "value binary")
     .select(F.col("value").cast("string"))
     .write.option("lineSep", LAST_BYTE).option("encoding", "ISO-8859-1").text(out_path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids_crc32, per document of the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                at, rows = 0, []
                for i, ids in read_documents(content.as_buffer().to_pybytes()):
                    rows.append((name, i, at, len(ids), zlib.crc32(ids.tobytes())))
                    at += len(ids)
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5, strict=True)],
                    names=["file", "id", "start", "n_tokens", "ids_crc32"])

    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    docs = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(number.alias("file"), "content")
            .mapInArrow(run, "file long, id long, start long, n_tokens long, ids_crc32 long"))
    docs = stored(docs, "token-rows")
    # running total over files: within groups of files, then over the groups
    files = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    files = files.withColumn("part", F.floor(F.col("file") / FILES_PER_GROUP))
    within = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("whole"))
    starts = (files.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
              .join(groups, "part").select("file", (F.col("inner") + F.col("whole")).alias("base")))
    return (docs.join(starts, "file")
            .select("id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"))


def tokens_to_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", out_path: str | None = None) -> DataFrame:
    """Write the files (in the shared folder unless ``out_path`` is given) and read them back."""
    spark = docs.sparkSession
    path = out_path or scratch_path(spark, "llm", "tokens")
    write_tokens(docs, tokenizer_path, path, end_id, id_col, text_col)
    return read_tokens(spark, path).withColumnRenamed("id", id_col)
