"""Secret scan over a trigram inverted index, in DataFrame operations only.

From each rule's regex a Boolean trigram query is derived: a conjunction of
alternatives, each the set of trigrams that one possible literal run must
have.  Postings (trigram, document) are made for the trigrams that any rule
asks for, over the lower-cased texts; the postings of a document are
intersected as bit sets, and only candidate documents are verified with the
regex.  A rule without mandatory trigrams (the hexadecimal one) scans all
documents.  A document is known in the index by a hash of id and text; two
documents of one hash share a candidate set, which verification corrects.

Spans are code points, end exclusive, found leftmost and non-overlapping per
rule: the gaps come from ``split``, the matches from ``regexp_extract_all``.

Null text counts as empty and has no spans.  Null ids stay null.  Repeated
rows are repeated in the result; an empty table gives an empty result.
Texts are scanned whole; matches are summed and cut in runs of ``RUN``, so that a
text with many is no square.  A column of the result's name in the given table is
refused.  Rules that repeat a group without a bound are refused, because the regex
engine would recurse once for each repetition.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let

MAX_ALTERNATIVES = 64
MAX_CLASS = 8
WORD_BITS = 63
#: Matches handled by one fold.
RUN = 256
#: Repetitions of a group from which on a rule is refused.
MAX_REPEATS = 64


@dataclass(frozen=True)
class Rule:
    """``regex`` in syntax that Java and Python share; a match counts if its ``group``
    has ``least`` characters or more."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


#: The three base kinds, then further ones; this order breaks ties of start.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),  # the same matches as AKIA[A-Z0-9]+ of 16 or more
    Rule("hex", r"[0-9a-f]{32,}"),  # the same matches as [0-9a-f]+ of 32 or more
)
FURTHER = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
)

Query = list[list[frozenset[str]]]


def _exact(nodes) -> set[str] | None:
    """All strings a node sequence can match, lower-cased, if they are few."""
    out = {""}
    for op, arg in nodes:
        if op is sre.LITERAL:
            own = {chr(arg).lower()}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= MAX_CLASS:
            own = {chr(a).lower() for _, a in arg}
        elif op is sre.SUBPATTERN:
            own = _exact(arg[3])
        elif op is sre.BRANCH:
            each = [_exact(b) for b in arg[1]]
            own = None if None in each else set().union(*each)
        elif op is sre.MAX_REPEAT and arg[1] == 1:
            own = _exact(arg[2])
            own = None if own is None else own | ({""} if arg[0] == 0 else set())
        elif op is sre.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= MAX_CLASS:
            own = _exact(list(arg[2]) * arg[0])
        else:
            own = None
        if own is None or len(out) * len(own) > MAX_ALTERNATIVES:
            return None
        out = {a + b for a in out for b in own}
    return out


def _check_repeats(nodes) -> None:
    """Refuse long repetitions of more than one character's pattern."""
    single = (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY, sre.CATEGORY)
    for op, arg in nodes:
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            inner = list(arg[2])
            if arg[1] > MAX_REPEATS and not (len(inner) == 1 and inner[0][0] in single):
                raise ValueError("a rule may repeat a group only up to a small bound")
            _check_repeats(inner)
        elif op is sre.SUBPATTERN:
            _check_repeats(arg[3])
        elif op is sre.BRANCH:
            for branch in arg[1]:
                _check_repeats(branch)


def trigram_query(regex: str) -> Query:
    """Conjunction of alternatives of trigram sets that every match must have."""
    def clause(runs: set[str]) -> list[list[frozenset[str]]]:
        if any(len(r) < 3 for r in runs):
            return []
        sets = {frozenset(r[i:i + 3] for i in range(len(r) - 2)) for r in runs}
        return [[s for s in sets if not any(t < s for t in sets)]]

    def walk(nodes) -> Query:
        query: Query = []
        runs = {""}
        for node in nodes:
            own = _exact([node])
            if own is not None and len(runs) * len(own) <= MAX_ALTERNATIVES:
                runs = {a + b for a in runs for b in own}
                continue
            query += clause(runs)
            runs = own or {""}
            op, arg = node
            if own is None and op is sre.SUBPATTERN:
                query += walk(arg[3])
        return query + clause(runs)
    parsed = sre_parse.parse(regex)
    _check_repeats(parsed)
    return walk(parsed)


def _masks(trigrams: frozenset[str], number: dict[str, int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for t in trigrams:
        w, b = divmod(number[t], WORD_BITS)
        out[w] = out.get(w, 0) | 1 << b
    return out


def postings(docs: DataFrame, key: Column, text: Column, trigrams: Sequence[str]) -> DataFrame:
    """(key, number of trigram): one row for each of ``trigrams`` in each document."""
    low = F.lower(text)
    have = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return docs.select(key.alias("key"), F.explode(have).alias("trigram"))


def candidates(docs: DataFrame, key: Column, text: Column, rules: Sequence[Rule]) -> tuple[DataFrame | None, list[Rule]]:
    """(key, kinds): rules that may match in a document, and the rules that have to scan all."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    full = [r for r in rules if not queries[r.kind]]
    number = {t: i for i, t in enumerate(sorted({t for q in queries.values() for c in q for s in c for t in s}))}
    if not number:
        return None, full
    words = range(len(number) // WORD_BITS + 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % WORD_BITS).cast("int"))
    sets = (postings(docs, key, text, list(number)).groupBy("key")
            .agg(*[F.coalesce(F.bit_or(F.when(F.floor(F.col("trigram") / WORD_BITS) == w, bit)), F.lit(0).cast("long"))
                   .alias(f"w{w}") for w in words]))

    def holds(query: Query) -> Column:
        whole = F.lit(True)
        for alternatives in query:
            some = F.lit(False)
            for trigrams in alternatives:
                every = F.lit(True)
                for w, m in _masks(trigrams, number).items():
                    every = every & (F.col(f"w{w}").bitwiseAND(F.lit(m).cast("long")) == m)
                some = some | every
            whole = whole & some
        return whole
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items() if q]))
    return sets.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0), full


def _runs(items: Column) -> Column:
    """An array cut into runs."""
    return let(items, lambda whole: F.when(F.size(whole) > 0, F.transform(
        F.sequence(F.lit(1), F.size(whole), F.lit(RUN)), lambda i: F.slice(whole, i, F.lit(RUN))))
        .otherwise(F.slice(F.array(whole), 1, 0)))


def _before(values: Column, plus) -> Column:
    """For each run's value the fold of those before it, from 0."""
    return F.aggregate(values, F.array(F.lit(0)), lambda out, v: F.concat(out, F.array(plus(F.element_at(out, -1), v))))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, end) of one rule in a text."""
    pattern = F.lit(rule.regex)
    gaps = F.split(text, rule.regex, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    parts = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.arrays_zip(found.alias("m"), counted.alias("g")),
                       lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b["m"]).alias("len"),
                                             F.length(b["g"]).alias("own")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,own:int>>")

    def placed(run: Column, begin: Column) -> Column:
        return F.aggregate(
            run, F.struct(begin.alias("at"), none.alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["len"]).alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + x["gap"]).alias("start"), F.lit(order).alias("kind"),
                    (s["at"] + x["gap"] + x["len"]).alias("end"), x["own"].alias("own")))).alias("out")),
            lambda s: s["out"])

    def width(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["len"])
    # lengths are summed by run first, so that each run knows where it begins
    spans = let(_runs(parts), lambda runs: let(
        _before(F.transform(runs, width), lambda a, b: a + b),
        lambda begin: F.flatten(F.transform(runs, lambda run, i: placed(run, F.get(begin, i))))))
    kept = F.filter(spans, lambda x: x["own"] >= rule.least) if rule.least else spans
    return F.when(F.regexp_like(text, pattern), F.transform(
        kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + FURTHER, id_col: str = "doc_id",
                 text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col``: array of (start, kind as its number in ``rules``, end) by start and kind."""
    if spans_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {spans_col} already")
    key, kinds = fresh(docs, "key"), fresh(docs, "kinds")
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.xxhash64(F.col(id_col), text)
    maybe, full = candidates(docs.select(id_col, text_col), name, text, rules)
    keyed = docs.withColumn(key, name)
    if maybe is None:
        keyed = keyed.withColumn(kinds, F.lit(None).cast("array<string>"))
    else:
        keyed = keyed.join(maybe.select(F.col("key").alias(key), F.col("kinds").alias(kinds)), key, "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    each = []
    for n, rule in enumerate(rules):
        own = _spans(text, rule, n)
        if rule not in full:
            own = F.when(F.array_contains(F.col(kinds), rule.kind), own)
        each.append(F.coalesce(own, none))
    return keyed.withColumn(spans_col, F.array_sort(F.flatten(F.array(*each)))).drop(key, kinds)


def span_text(spans: Column, rules: Sequence[Rule]) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: Sequence[Rule] = BASE + FURTHER, mark: str = "[SECRET]", id_col: str = "doc_id",
           text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every stretch of a text that spans cover replaced by ``mark``; where
    a text changes, ``length_col`` (if there is one) takes its new length."""
    spans = fresh(docs, "spans")
    found = find_secrets(docs, rules, id_col, text_col, spans)
    text = F.col(text_col)
    none = F.array().cast("array<string>")

    def furthest(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: F.greatest(n, x["end"]))

    def cut(run: Column, begin: Column) -> Column:
        """The text from ``begin`` up to the run's last span, covered stretches replaced."""
        piece = F.substring(text, begin + 1, F.greatest(furthest(run) - begin, F.lit(0)))
        return let(F.struct(piece.alias("piece"), begin.alias("begin")), lambda p: F.aggregate(
            run, F.struct(p["begin"].alias("at"), none.alias("out")),
            lambda s, x: F.struct(
                F.greatest(s["at"], x["end"]).alias("at"),
                F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(
                    F.substring(p["piece"], s["at"] - p["begin"] + 1, x["start"] - s["at"]), F.lit(mark))))
                .otherwise(s["out"]).alias("out")),
            lambda s: F.array_join(s["out"], "")))
    new = let(_runs(F.col(spans)), lambda runs: let(
        _before(F.transform(runs, furthest), F.greatest),
        lambda begin: F.concat(
            F.array_join(F.transform(runs, lambda run, i: cut(run, F.get(begin, i))), ""),
            F.substring(text, F.element_at(begin, -1) + 1, F.length(text)))))
    some = F.size(spans) > 0
    out = found.withColumn(text_col, F.when(some, new).otherwise(text))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(some, F.length(text_col).cast(docs.schema[length_col].dataType))
                             .otherwise(F.col(length_col)))
    return out.select(*docs.columns)
