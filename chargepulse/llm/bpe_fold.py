"""Byte-level BPE encoding and decoding with higher-order functions.

Encoding folds ranked merges over the byte array of a word.  A symbol is a
number that packs its id and the rank of its pair with the next symbol; a step
joins the leftmost pair of the lowest rank and looks up the two ranks it
touches.  The rank map is a literal (a session variable, which the optimizer
replaces by its value).  Spark searches a map from end to end, so the literal
is an array addressed by two remainders of the pair of ids.

Words repeat, so distinct words are folded once into a dictionary that is used
like the rank map: of the words that fall into one of its ``SLOTS`` slots by
hash, the ``WAYS`` that occur most often in the whole table (of at most
``DICTIONARY_WORD`` bytes, so its size is bounded).  Every other word is
folded where it stands; the dictionary changes cost, never a result.  A word
that is a piece has that piece's id even if the merges do not lead to it; such
pieces are found when the ranks are read (there are none in usual files).

Decoding looks the ids up in the array of pieces and joins them.  Pieces are
held as strings of any bytes, which array_join copies as they are.

The split pattern runs in Java's regex engine, with the Unicode white-space set
written out and with the letters and numbers that the tiktoken library knows and
the JVM's Unicode version does not: both are asked once, for every code point.

Null text counts as empty: no ids, empty bytes.  Repeated rows give repeated
results, an empty table an empty result.  Only the id and text columns are
read, so further columns of any name do not matter.  A word of n bytes costs
up to n steps; a step looks at all symbols of a word of up to ``LONG_WORD`` bytes
and at about sqrt(n) of a longer one, kept in blocks.  No text is cut.
"""

from __future__ import annotations

import base64
import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

#: Unicode White_Space, as the inside of a Java character class.
_SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SLOTS = 1 << 17
#: Words of a slot.
WAYS = 6
DICTIONARY_WORD = 32
MAX_RANK_FILE = 64 << 20
#: Words of more bytes are folded by blocks.
LONG_WORD = 256
ID_BITS = 20
#: A rank above all others.
NO_PAIR = 1 << ID_BITS
#: Symbols of short words hold their position between id and rank.
AT_BITS = 22
RANK_AT = ID_BITS + AT_BITS
NO_ROW = (1 << 62) - 1
NUMBERS = "array<bigint>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.  An aggregate hands its state on as it
    is; a transform would copy the result, with all that is nested in it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda own, _: own, body)


def _code_points(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("utf-32-le"), dtype="<u4")


def _ranges(points: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of ascending numbers."""
    cuts = np.flatnonzero(np.diff(points.astype(np.int64)) != 1) + 1
    return [(int(run[0]), int(run[-1])) for run in np.split(points, cuts) if len(run)]


_EVERY = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
_ADDED: dict[str, str] = {}


def _library_text(name: str) -> str:
    """All characters of a Unicode class, as the tiktoken library splits them, in order."""
    import tiktoken

    own = tiktoken.Encoding("class", pat_str=rf"\p{{{name}}}", mergeable_ranks={bytes([i]): i for i in range(256)},
                            special_tokens={})
    return own.decode(own.encode_ordinary(_EVERY))


def _library_has(name: str) -> frozenset[str]:
    return frozenset(_library_text(name))


def _java_text(spark: SparkSession, name: str) -> str:
    """All characters of a Unicode class, as the JVM has them, in order.  The characters are made from
    their numbers: as a literal, all of them would stand in the plan and in each of its descriptions."""
    points = spark.range(0x110000).where(~F.col("id").between(0xD800, 0xDFFF))
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    inside = points.select(char.alias("c")).where(F.col("c").rlike(rf"^\p{{{name}}}$"))
    return inside.agg(F.array_join(F.array_sort(F.collect_list("c")), "")).first()[0]


def unicode_class(spark: SparkSession, name: str) -> str:
    """``\\p{name}`` for the inside of a Java class, with what Java's tables lack.  Below
    the first added character a look at one range is enough."""
    if name not in _ADDED:
        java, library = _code_points(_java_text(spark, name)), _code_points(_library_text(name))
        if len(np.setdiff1d(java, library)):
            raise ValueError("the JVM's Unicode tables are newer than the library's")
        more = _ranges(np.setdiff1d(library, java))
        inner = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in more)
        _ADDED[name] = rf"[\x{{{more[0][0]:X}}}-\x{{{more[-1][1]:X}}}&&[{inner}]]" if more else ""
    return rf"\p{{{name}}}{_ADDED[name]}"


def java_pattern(pattern: str, spark: SparkSession) -> str:
    """``pattern`` with \\s and \\S spelled out for Java, and \\p{L} and \\p{N} as the library has them."""
    out, inside = [], False
    for m in re.finditer(r"\\p\{[LN]\}|\\.|.", pattern, re.S):
        t = m[0]
        if t in (r"\p{L}", r"\p{N}"):
            t = unicode_class(spark, t[3]) if inside else f"[{unicode_class(spark, t[3])}]"
        elif t == r"\s":
            t = _SPACE if inside else f"[{_SPACE}]"
        elif t == r"\S":
            if inside:
                raise ValueError("\\S inside a class")
            t = f"[^{_SPACE}]"
        elif t in "[]":
            inside = t == "["
        out.append(t)
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 piece and its rank per line."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_FILE + 1)
    if len(data) > MAX_RANK_FILE:
        raise ValueError(f"rank file over {MAX_RANK_FILE} bytes")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def literal(value: DataFrame, kind: str, names: list[str]) -> Column:
    """The single value of ``value`` as a literal.  The variable's name goes to ``names``,
    to be dropped when the plans that use it have been made."""
    spark = value.sparkSession
    name = f"v_{uuid.uuid4().hex}"
    names.append(name)
    spark.sql(f"DECLARE VARIABLE {name} {kind}")
    spark.sql(f"SET VAR {name} = (SELECT * FROM {{value}})", value=value)
    return F.expr(f"system.session.{name}")


def _is_text(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:  # part of a character: never a word
        return False
    return True


def two_slots(entries: dict[int, int]) -> tuple[list[int], int, int]:
    """A table in which the entry of each key is at one of two places, its remainders
    by m and (behind those) by n; a row packs key and value."""
    m = 2 * len(entries) + 257
    while True:
        m, n = m + 2, m + 4
        rows: list[int | None] = [None] * (m + n)
        for key, value in entries.items():
            row, at = key << ID_BITS | value, key % m
            for _ in range(500):
                row, rows[at] = rows[at], row
                if row is None:
                    break
                k = row >> ID_BITS
                at = m + k % n if at == k % m else k % m
            if row is not None:
                break
        else:
            return [NO_ROW if r is None else r for r in rows], m, n


class Ranks:
    """The literals of one rank file: pairs of ids to the rank of their
    union (which is the id of the piece), byte ids, and the pieces."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], names: list[str] | None = None):
        self.ranks = ranks
        self.names = [] if names is None else names
        self.size = max(ranks.values()) + 1
        self.stride = self.size + 1   # the id ``size`` stands for both ends of a word
        if self.size >= 1 << ID_BITS:
            raise ValueError(f"more than {1 << ID_BITS} pieces")
        pairs: dict[int, int] = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * self.stride + b] = rank
        pieces: list[bytes | None] = [None] * self.size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        rows, self.m, self.n = two_slots(pairs)
        self.pairs = literal(spark.createDataFrame([(rows,)], f"v {NUMBERS}"), NUMBERS, self.names)
        # bytes as strings, which array_join puts together as they are
        self.pieces = literal(spark.createDataFrame([(pieces,)], "v array<binary>").select(F.col("v").cast("array<string>").alias("v")),
                              "array<string>", self.names)
        ids = [*[ranks[bytes([i])] for i in range(256)], self.size]
        self.bytes = F.lit(ids[:256])
        # symbols without position, by a byte and the next one; 256 stands for both ends of a word
        first = [pairs.get(a * self.stride + b, NO_PAIR) << RANK_AT | a for a in ids for b in ids]
        self.first = literal(spark.createDataFrame([(first,)], f"v {NUMBERS}"), NUMBERS, self.names)
        odd = {piece.decode(): rank for piece, rank in ranks.items()
               if len(piece) > 1 and not self._reached(piece, pairs) and _is_text(piece)}
        self.odd = F.create_map(*[F.lit(x) for item in odd.items() for x in item]) if odd else None

    def _reached(self, piece: bytes, pairs: dict[int, int]) -> bool:
        """Whether the merges of the piece's own bytes end in the piece."""
        ids = [self.ranks[piece[k:k + 1]] for k in range(len(piece))]
        while len(ids) > 1:
            low, at = min((pairs.get(a * self.stride + b, NO_PAIR), k)
                          for k, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if low == NO_PAIR:
                return False
            ids[at:at + 2] = [low]
        return True

    def of(self, a: Column, b: Column) -> Column:
        """Rank of the pair of ids ``a``, ``b``; ``NO_PAIR`` if there is none or an id is null."""
        def found(key: Column) -> Column:
            # a row of the same key leaves its rank, any other row more than NO_PAIR
            def at(slot: Column) -> Column:
                return F.get(self.pairs, slot.cast("int")).bitwiseXOR(F.shiftleft(key, ID_BITS))
            return F.least(at(key % self.m), at(key % self.n + self.m), F.lit(NO_PAIR))
        return let(a * self.stride + b, found)


def _id(symbol: Column) -> Column:
    return symbol.bitwiseAND(F.lit((1 << ID_BITS) - 1))


def _symbol(own: Column, rank: Column) -> Column:
    return F.shiftleft(rank, ID_BITS).bitwiseOR(own)


def _at(array: Column, i: Column) -> Column:
    """Entry ``i`` of an array, from 0; null outside."""
    return F.when(i >= 0, F.get(array, i))


def _merge(s: Column, i: Column, low: Column, beyond: Column, ranks: Ranks) -> Column:
    """Symbols ``i`` and ``i + 1`` of ``s``, from 0, become the one of id ``low`` (the rank of
    the pair); ``beyond`` is the symbol that follows ``s``, if there may be one."""
    after = F.coalesce(F.get(s, i + 2), beyond)
    return F.transform(F.filter(s, lambda x, j: j != i + 1), lambda x, j: F.when(
        j == i - 1, _symbol(_id(x), ranks.of(_id(x), low))).when(
        j == i, _symbol(low, F.when(after.isNotNull(), ranks.of(low, _id(after))).otherwise(F.lit(NO_PAIR))))
        .otherwise(x))


def _lowest(ranks_: Column) -> Column:
    """The lowest rank of an array and its first position, from 0."""
    return let(F.array_min(ranks_), lambda low: F.struct(
        low.alias("low"), (F.array_position(ranks_, low) - 1).cast("int").alias("at")))


def _cut(s: Column, i: Column, n: Column) -> Column:
    """``n`` entries from entry ``i`` on, from 0."""
    return F.slice(s, i + 1, n)


def _rank(s: Column) -> Column:
    return F.transform(s, lambda x: F.shiftright(x, ID_BITS))


def _block(s: Column) -> Column:
    return F.struct(F.shiftright(F.array_min(s), ID_BITS).alias("low"), s.alias("s"))


def _fold_short(word: Column, ranks: Ranks) -> Column:
    """Ids after all merges, from a character for each byte, between two ends.  A symbol holds the
    rank of its pair, its position and its id, so the least symbol is the leftmost pair of the
    lowest rank.  Nothing is searched for: outside of generated code array_position ends its
    search by an exception, which took most of a step."""
    low_bits = F.lit((1 << RANK_AT) - 1)

    def symbol(rank: Column, rest: Column) -> Column:
        return F.shiftleft(rank, RANK_AT).bitwiseOR(rest)

    def start(b: Column) -> Column:
        return F.transform(b, lambda a, i: F.get(ranks.first, a * 257 + F.coalesce(F.get(b, i + 1), F.lit(256)))
                           .bitwiseOR(F.shiftleft(i.cast("long"), ID_BITS)))

    def step(s: Column, _i: Column) -> Column:
        return let(F.array_min(s), lambda m: F.when(m < NO_PAIR << RANK_AT, let(
            F.shiftright(m.bitwiseAND(low_bits), ID_BITS).cast("int"),
            lambda i: merged(s, m, i))).otherwise(s))

    def merged(s: Column, m: Column, i: Column) -> Column:
        low = F.shiftright(m, RANK_AT)
        # symbols differ, so the second of the pair is removed by its value
        return F.transform(F.array_remove(s, F.get(s, i + 1)), lambda x, j: F.when(j > i, x - (1 << ID_BITS)).when(
            j == i, symbol(ranks.of(low, _id(F.get(s, i + 2))), F.shiftleft(i.cast("long"), ID_BITS).bitwiseOR(low))).when(
            j == i - 1, symbol(ranks.of(_id(x), low), x.bitwiseAND(low_bits))).otherwise(x))

    def inner(s: Column) -> Column:
        return F.transform(F.slice(s, F.lit(2), F.size(s) - 2), lambda x: _id(x).cast("int"))
    codes = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.ascii(F.substring(word, i, F.lit(1))))
    return let(F.aggregate(F.sequence(F.lit(3), F.length(word)), let(codes, start), step), inner)


def _fold_long(start: Column, n: Column, ranks: Ranks) -> Column:
    """The same by blocks that know their lowest rank: a step looks at one number of each
    block and at the symbols of up to three blocks, of sqrt(n) / 3 each."""
    none = F.array().cast(NUMBERS)

    def step(blocks: Column, _i: Column) -> Column:
        return let(_lowest(blocks["low"]), lambda p: F.when(
            p["low"] < NO_PAIR, merged(blocks, p["low"], p["at"])).otherwise(blocks))

    def merged(blocks: Column, low: Column, k: Column) -> Column:
        def inside(b: Column) -> Column:
            at = (F.array_position(_rank(b), low) - 1).cast("int")
            # the block before matters if the pair begins the block, the next ones if it reaches its end
            return let(at, lambda i: let(F.struct(
                b.alias("b"), i.alias("at"),
                F.when(i == 0, F.coalesce(_at(blocks, k - 1)["s"], none)).otherwise(none).alias("a"),
                F.when(i + 2 >= F.size(b), F.coalesce(F.get(blocks, k + 1)["s"], none)).otherwise(none).alias("c")), rebuilt))

        def rebuilt(w: Column) -> Column:
            na, nb, nc = F.size(w["a"]), F.size(w["b"]), F.size(w["c"])
            beyond = F.when(nc > 0, F.get(F.get(blocks, k + 2)["s"], F.lit(0)))
            i = na + w["at"]
            before = F.least(i, F.lit(1))   # symbols before the pair that change

            def joined(s: Column) -> Column:
                near = let(_cut(s, i - before, before + 3), lambda x: _merge(x, before, low, beyond, ranks))
                return F.concat(_cut(s, F.lit(0), i - before), near, _cut(s, i + 3, F.size(s)))

            # the pair's own block gets one symbol less, its neighbours keep their sizes
            new = let(let(F.concat(w["a"], w["b"], w["c"]), joined), lambda x: F.filter(F.array(
                _block(_cut(x, F.lit(0), na)), _block(_cut(x, na, nb - 1)), _block(_cut(x, na + nb - 1, nc))),
                lambda b: F.size(b["s"]) > 0))
            first, last = k - F.least(na, F.lit(1)), k + F.least(nc, F.lit(1))
            return F.concat(_cut(blocks, F.lit(0), first), new, _cut(blocks, last + 1, F.size(blocks)))
        return let(F.get(blocks, k)["s"], inside)

    width = F.greatest(F.lit(1), (F.sqrt(n) / 3).cast("int"))   # symbols cost more than blocks
    blocks = let(start, lambda s: F.transform(F.sequence(F.lit(1), n, width), lambda i: _block(F.slice(s, i, width))))
    return F.flatten(F.transform(F.aggregate(F.sequence(F.lit(1), n), blocks, step), lambda b: b["s"]))


def fold_word(word: Column, ranks: Ranks, long_word: int = LONG_WORD) -> Column:
    """Ids of one non-empty word, by folding ranked merges over its bytes; words of over
    ``long_word`` bytes by blocks, with the same result."""
    def start(b: Column) -> Column:
        ids = F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: F.get(
            ranks.bytes, F.ascii(F.substring(b, i, F.lit(1)))).cast("long"))
        return let(ids, lambda x: F.transform(x, lambda a, i: _symbol(a, ranks.of(a, F.get(x, i + 1)))))

    def fold(b: Column) -> Column:
        n = F.length(b)
        long = F.transform(_fold_long(start(b), n, ranks), lambda x: _id(x).cast("int"))
        # the character after those of the bytes stands for an end
        return F.when(n > long_word, long).otherwise(
            let(F.concat(F.lit("\u0100"), b, F.lit("\u0100")), lambda x: _fold_short(x, ranks)))

    # one character for each byte, so that substring and ascii see bytes
    folded = let(F.decode(word.cast("binary"), "ISO-8859-1"), fold)
    if ranks.odd is None:
        return folded
    own = F.try_element_at(ranks.odd, word)
    return F.when(own.isNotNull(), F.array(own)).otherwise(folded)


def _words(text: Column, pattern: str) -> Column:
    """Words of a text, by a pattern for Java."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _slot(word: Column) -> Column:
    """First place of the word's slot."""
    return F.hash(word).bitwiseAND(F.lit(SLOTS - 1)) * WAYS


def dictionary(docs: DataFrame, ranks: Ranks, pattern: str, text_col: str = "text") -> tuple[Column, Column]:
    """Words (by a pattern for Java) and their ids, ``WAYS`` for each slot, as literals.  Words are counted over all documents."""
    spark = docs.sparkSession
    counts = (docs.select(F.explode(_words(F.col(text_col), pattern)).alias("word"))
              .where(F.octet_length("word") <= DICTIONARY_WORD)
              .groupBy("word").count().where(F.col("count") > 1))
    best = Window.partitionBy("slot").orderBy(F.desc("count"), "word")
    counts = stored(counts.withColumn("slot", _slot(F.col("word"))).withColumn("way", F.row_number().over(best))
                    .where(F.col("way") <= WAYS).select((F.col("slot") + F.col("way") - 1).alias("at"), "word"), "bpe-counts")
    kept = stored(counts.select("at", "word", fold_word(F.col("word"), ranks).alias("ids")), "bpe-dictionary")
    places = (spark.range(SLOTS * WAYS).select(F.col("id").cast("int").alias("at")).join(kept, "at", "left")
              .select(F.struct("at", "word", "ids").alias("x")))
    rows = stored(places.agg(F.array_sort(F.collect_list("x")).alias("x")), "bpe-places")
    return (literal(rows.select(F.col("x.word").alias("v")), "array<string>", ranks.names),
            literal(rows.select(F.col("x.ids").alias("v")), "array<array<int>>", ranks.names))


def encode(text: Column, ranks: Ranks, words: tuple[Column, Column], pattern: str) -> Column:
    """Ids of a text: its words' ids one after the other."""
    def known(w: Column, at: Column) -> Column:
        found = F
        for k in range(WAYS):
            found = found.when(F.get(words[0], at + k) == w, F.get(words[1], at + k))
        return found

    def one(w: Column) -> Column:
        return F.coalesce(let(_slot(w), lambda at: known(w, at)), fold_word(w, ranks))
    return F.flatten(F.transform(_words(text, pattern), one))


def decode(ids: Column, pieces: Column) -> Column:
    """The binary pieces of ``ids``, concatenated."""
    return F.array_join(F.transform(ids, lambda x: F.get(pieces, x)), "").cast("binary")


def bpe(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """``id_col``, ids (array of int), decoded (binary) per row of ``docs``."""
    spark = docs.sparkSession
    pattern = java_pattern(pattern, spark)
    names: list[str] = []
    try:
        ranks = Ranks(spark, read_ranks(rank_path), names)
        words = dictionary(docs, ranks, pattern, text_col)
        out = docs.select(F.col(id_col), encode(F.col(text_col), ranks, words, pattern).alias("ids"))
        return out.select(id_col, "ids", decode(F.col("ids"), ranks.pieces).alias("decoded"))
    finally:
        for name in names:  # the plan has the values now; the session need not keep them
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {name}")
