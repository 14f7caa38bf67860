"""How a set of document filters overlap, in every order they could run.

Each document gets the set of the filters that it fails; per part (language)
the documents are counted by that set.  With k filters the 2^k coalitions'
removals follow from those counts: a coalition removes the documents that fail
any of its filters.  A step of an order is the difference of two coalitions.

The share of a filter over all orders is its Shapley value, found as the exact
solution of a least-squares problem: fit one number a filter to the removals
of all coalitions, weighted by the Shapley kernel, under the constraint that
the numbers add up to the removal of all filters.  The normal equations with
the constraint's multiplier are solved in rational numbers, so the result
times k! is an integer, the filter's removals summed over all orders.

The last filter finds documents whose text is that of a document with a
smaller id, in the whole table: texts are grouped by SHA-256 and length, and
ids are pre-aggregated, so a text with many copies is no large group.

Null text counts as empty, a null part as the empty string.  A repeated row
is a document of its own and no duplicate of a row with the same id; a null
id is neither a duplicate nor the original of one.  A document counts as good
or toxic if any of its label rows says so.  A table without rows has no parts
and gives no rows.  Only the named columns are read, so further columns of
any name do not matter.  Texts are judged whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Check = Callable[[Column, Column], Column]

#: Whether a text (and its words) fails, by filter.
CHECKS: dict[str, Check] = {
    "A": lambda text, words: F.size(words) < 100,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
    "C": lambda text, words: F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 10,
    "D": lambda text, words: text.rlike(r"[#$%&*|]"),
}
DUPLICATE = "E"
#: The orders of more filters would be too many rows for one part.
MAX_FILTERS = 7
COUNTS = ("n", "good", "toxic")
STEP = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long")


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def failures(docs: DataFrame, checks: dict[str, Check], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, fails (bit k: fails the k-th check), digest and length of the text."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", "part", "text", words_of(F.col("text")).alias("words"))
    bits = sum((F.when(check(F.col("text"), F.col("words")), 1 << k).otherwise(0)
                for k, check in enumerate(checks.values())), F.lit(0))
    return rows.select("id", "part", bits.alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest"),
                       F.octet_length("text").alias("bytes"))


def tabulate(failed: DataFrame, labels: DataFrame, copy_bit: int, label_id: str = "doc_id",
             good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """part, fails, n, good, toxic: documents by the set of filters they fail, duplicates included."""
    marks = labels.groupBy(F.col(label_id).alias("label_id")).agg(
        F.max((F.col(good) == 1).cast("long")).alias("good"), F.max((F.col(toxic) == 1).cast("long")).alias("toxic"))
    text = ["digest", "bytes"]
    # rows of one id and text together, so that a repeated id is known as such
    ids = (failed.join(marks, failed["id"] == marks["label_id"], "left")
           .groupBy("id", "part", "fails", *text, F.coalesce("good", F.lit(0)).alias("g"),
                    F.coalesce("toxic", F.lit(0)).alias("t")).agg(F.count(F.lit(1)).alias("n")))
    ids = ids.select("id", "part", "fails", *text, "n", (F.col("n") * F.col("g")).alias("good"),
                     (F.col("n") * F.col("t")).alias("toxic"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", *COUNTS))
    groups = ids.groupBy(*text, "part", "fails").agg(
        F.min(known).alias("first"), *[F.sum(c).alias(c) for c in COUNTS],
        *[F.sum(F.when(F.col("id").isNull(), F.col(c)).otherwise(0)).alias(f"no_id_{c}") for c in COUNTS])
    # a text has at most one row here for each part
    smallest = F.min("first.id").over(Window.partitionBy(*text))

    def kept(c: str) -> Column:
        first = F.when(F.col("first.id") == F.col("smallest"), F.col(f"first.{c}")).otherwise(0)
        return F.col(f"no_id_{c}") + F.coalesce(first, F.lit(0))
    groups = groups.withColumn("smallest", smallest)
    both = groups.select("part", F.inline(F.array(
        F.struct(F.col("fails"), *[kept(c).alias(c) for c in COUNTS]),
        F.struct((F.col("fails") + copy_bit).alias("fails"), *[(F.col(c) - kept(c)).alias(c) for c in COUNTS]))))
    return both.where(F.col("n") > 0).groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in COUNTS])


def removals(by_set: dict[int, int], k: int) -> list[int]:
    """Documents that each of the 2^k coalitions removes, from the counts by failed set."""
    return [sum(n for fails, n in by_set.items() if fails & s) for s in range(1 << k)]


def shapley(value: list[int], k: int) -> list[Fraction]:
    """Kernel-weighted least squares under the efficiency constraint, in rationals."""
    def member(s: int) -> list[int]:
        return [s >> i & 1 for i in range(k)]
    if k == 1:
        return [Fraction(value[1])]
    # normal equations of k unknowns and the constraint's multiplier, bordered
    rows = [[Fraction(0)] * (k + 2) for _ in range(k + 1)]
    for s in range(1, (1 << k) - 1):
        z = member(s)
        size = sum(z)
        weight = Fraction(k - 1, comb(k, size) * size * (k - size))
        for i in range(k):
            if z[i]:
                for j in range(k):
                    rows[i][j] += weight * z[j]
                rows[i][-1] += weight * value[s]
    for i in range(k):
        rows[i][k] = rows[k][i] = Fraction(1)
    rows[k][-1] = Fraction(value[-1])
    for c in range(k + 1):
        pivot = next(r for r in range(c, k + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(k + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [rows[i][-1] for i in range(k)]


def steps(part: str, counts: dict[str, dict[int, int]], letters: str) -> Iterator[tuple]:
    """The rows of one part: every order, every step."""
    k = len(letters)
    total = sum(counts["n"].values())
    n, good, toxic = (removals(counts[c], k) for c in COUNTS)
    share = [x * factorial(k) for x in shapley(n, k)]
    assert all(x.denominator == 1 for x in share)
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = n[after] - n[before]
            yield (part, "".join(letters[j] for j in order), step, total - n[after], removed, n[1 << i] - removed,
                   counts["n"].get(1 << i, 0), good[after] - good[before], toxic[after] - toxic[before], int(share[i]))
            before = after


def audit(docs: DataFrame, labels: DataFrame, checks: dict[str, Check] | None = None, duplicate: str = DUPLICATE,
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step."""
    checks = CHECKS if checks is None else checks
    letters = "".join(checks) + duplicate
    if len(letters) > MAX_FILTERS or len(set(letters)) != len(letters) or len(letters) != len(checks) + 1:
        raise ValueError(f"at most {MAX_FILTERS} filters, each with a letter of its own")
    failed = failures(docs, checks, id_col, text_col, part_col)
    by_set = tabulate(failed, labels, 1 << len(checks))
    # at most 2^k entries a part
    parts = by_set.groupBy("part").agg(F.collect_list(F.struct("fails", *COUNTS)).alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in STEP.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
        for b in batches:
            for row in b.to_pylist():
                counts = {c: {s["fails"]: s[c] for s in row["sets"]} for c in COUNTS}
                cols = zip(*steps(row["part"], counts, letters), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
    return parts.mapInArrow(run, STEP)
