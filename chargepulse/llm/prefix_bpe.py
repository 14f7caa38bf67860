"""BPE encoding and decoding by per-prefix dynamic programming.

The last token of the encoding of a prefix is unique: it is the only piece
that ends there and fits behind the last token of the prefix before it.  So
one pass over a word stores that token for every prefix.  The pieces that end
at a position are the matches of a suffix-link automaton over the vocabulary;
two tokens fit if undoing their merges, latest first, along their common border
meets no pair that would have merged earlier across it.  Following the stored
tokens back from the word's end gives the exact ids.  A word of n symbols costs
n times the pieces that end at a position, whatever its length.

The tokenizer's own normaliser and splitter (of the tokenizers library) make
the words; both work within the runs between ASCII white space, so a worker
keeps the ids of about ``CACHE`` such runs, and of as many words.  Strings of added tokens inside a
text become their ids, as in the library.  Decoding joins the pieces of the
ids with spaces, which is the library's way for a tokenizer without a decoder.

Null text counts as empty: no ids, empty decoded text.  Repeated rows give
repeated results, an empty table an empty result; texts are encoded whole.
Only the id and text columns are read, so further columns of any name do not
matter.  Tokenizers of another kind are refused: the steps before the merges
are checked, the model must hold every byte symbol, and each piece must come
from one merge whose parts come earlier.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_files import check_tokenizer

MAX_TOKENIZER = 64 << 20
CACHE = 400_000
CACHED_WORD = 48
PAIRS = 1 << 20
#: A word's last symbol is its character moved by this much.
LAST = 0x10000
ROWS = 256
NEVER = 1 << 62
#: ASCII punctuation (no apostrophe) behind an ASCII letter at the end of a run: a word of its own.
_TRAILING = re.compile(rb"(?<=[A-Za-z])[!-&(-/:-@\[-`{-~]+(?=[ \n]|\Z)")


class Merges:
    """Pieces, their parts and ranks, read from a tokenizer's JSON text."""

    def __init__(self, tokenizer: str):
        check_tokenizer(tokenizer)
        spec = json.loads(tokenizer)
        model = spec["model"]
        if model.get("type") != "BPE" or spec.get("decoder") or spec.get("post_processor") or \
                any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("this tokenizer's model is not plain BPE")
        suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get("normalized") for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that are searched in normalised text")
        self.names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.added.items()}
        self.size = max(self.names) + 1
        #: symbols of each piece; a base piece is one symbol
        self.symbols: dict[int, str] = {}
        for s, i in vocab.items():
            if len(s) == 1:
                self.symbols[i] = s
            elif suffix and s == s[0] + suffix:
                self.symbols[i] = chr(ord(s[0]) + LAST)
        self.has_suffix = bool(suffix)
        self.made = dict.fromkeys(self.symbols, -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, new = vocab[a], vocab[b], vocab[a + b]
            if x not in self.made or y not in self.made or new in self.made:
                raise ValueError(f"merge {rank} is not the one source of a piece from earlier pieces")
            self.made[new], self.left[new], self.right[new] = rank, x, y
            self.rank[x * self.size + y] = rank
            self.symbols[new] = self.symbols[x] + self.symbols[y]
        self.reached = set(i for i, rank in self.made.items() if rank < 0)
        for i, rank in self.made.items():  # in the order of the merges
            if rank >= 0 and self.left[i] in self.reached and self.right[i] in self.reached and \
                    self.fit(self.left[i], self.right[i], rank):
                self.reached.add(i)

    def fit(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether the merges below ``before`` leave ``a`` and ``b`` beside each other.

        The pieces at the border are taken apart from the latest merge on.  While a pair
        stands at the border, its own merge must not come before the merges that use up
        its parts; of equal merges the left one comes first."""
        until_a = until_b = before
        while True:
            across = self.rank.get(a * self.size + b, NEVER)
            if across < until_a and across <= until_b and across < before:
                return False
            ra, rb = self.made[a], self.made[b]
            if ra < 0 and rb < 0:
                return True
            if rb >= ra:
                until_b, b = rb, self.left[b]
            else:
                until_a, a = ra, self.right[a]


class Recent(dict):
    """Values of recent keys, in two generations: a key found in the old one moves to the
    new one, which becomes the old one when it is full."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def found(self, key):
        """Value of a key that the new generation lacks, or None."""
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHE // 2:
            self.old = dict(self)
            self.clear()


class PrefixEncoder:
    """Ids of texts, by the last token of every prefix."""

    def __init__(self, tokenizer: str):
        import ahocorasick
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.merges = Merges(tokenizer)
        own = Tokenizer.from_str(tokenizer)
        self.normal, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        known = set(self.merges.symbols.values())
        if any(c not in known or (self.merges.has_suffix and chr(ord(c) + LAST) not in known)
               for c in ByteLevel.alphabet()):
            raise ValueError("the vocabulary lacks byte symbols")
        self.automaton = ahocorasick.Automaton()
        for i in self.merges.reached:
            s = self.merges.symbols[i]
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        self.names = [self.merges.names.get(i, "") for i in range(self.merges.size)]
        self.added = re.compile("|".join(re.escape(s) for s in sorted(self.merges.added, key=len, reverse=True))) \
            if self.merges.added else None
        self.fits: dict[int, bool] = {}
        self.runs, self.words = Recent(), Recent()

    def word(self, symbols: str) -> list[int]:
        """Ids of one word, given as byte symbols."""
        n, size, fits = len(symbols), self.merges.size, self.fits
        if self.merges.has_suffix:
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + LAST)
        last = [-1] * (n + 1)
        width = [0] * (n + 1)
        for end, (token, length) in self.automaton.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            before = end - length
            if before:
                if last[before] < 0:
                    continue
                key = last[before] * size + token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) >= PAIRS:
                        fits.clear()
                    ok = fits[key] = self.merges.fit(last[before], token)
                if not ok:
                    continue
            last[end], width[end] = token, length
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]

    def run(self, raw: bytes) -> bytes:
        """Ids (packed) of a run without ASCII white space."""
        packed = self.runs.found(raw)
        if packed is not None:
            return packed
        parts = []
        for symbols, _ in self.split(self.normal(raw.decode())):
            ids = self.words.get(symbols)
            if ids is None and (ids := self.words.found(symbols)) is None:
                ids = array("I", self.word(symbols)).tobytes()
                if len(symbols) <= CACHED_WORD:
                    self.words[symbols] = ids
            parts.append(ids)
        packed = b"".join(parts)
        if len(raw) <= CACHED_WORD:
            self.runs[raw] = packed
        return packed

    def plain(self, text: str) -> bytes:
        self.runs.trim()
        self.words.trim()
        get, run = self.runs.get, self.run
        return b"".join([run(w) if (ids := get(w)) is None else ids for w in _TRAILING.sub(rb" \g<0>", text.encode()).split()])

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.added is None or not self.added.search(text):
            return self.plain(text)
        parts, at = [], 0
        for m in self.added.finditer(text):
            parts += [self.plain(text[at:m.start()]), array("I", [self.merges.added[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*parts, self.plain(text[at:])])

    def decode(self, packed: bytes) -> str:
        """Text of packed ids, added tokens included."""
        ids = array("I")
        ids.frombytes(packed)
        return " ".join(map(self.names.__getitem__, ids))


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(tokenizer: str) -> PrefixEncoder:
    """The worker's encoder, kept for its later tasks."""
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = PrefixEncoder(tokenizer)
    return _ENCODERS[tokenizer]


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                packed = [own.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), pa.array(map(own.decode, packed), pa.string())],
                    names=["id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` (long), ids (little-endian unsigned 32-bit integers), decoded text, per row."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read(MAX_TOKENIZER + 1)
    if len(tokenizer) > MAX_TOKENIZER:
        raise ValueError(f"tokenizer over {MAX_TOKENIZER} characters")
    Merges(tokenizer)  # refused here rather than in a task
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_encode(shared), "id long, ids binary, decoded string")
            .withColumnRenamed("id", id_col))
