"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counted over the whole text.  Each is cut into at most ``BINS``
quantile bins.  Training is cyclic boosting: in turn, each feature gets a
shallow tree on its bins, fitted to the gradient of the logistic loss and
added, shrunk, to the feature's lookup table; then the pairs of features with
the largest remaining gain get two-dimensional tables the same way.  A score
is the sigmoid of the intercept plus the looked-up bins, added up in arrays.

Training rows: labelled documents that are not held out, at most about
``TRAIN_ROWS`` of them, chosen by 63 bits of a hash of the id (a documented
bound; all documents are scored; if no id is chosen, training raises).  Documents of one id share the weight of its label
rows, and equal features are one training row.  If ids are repeated with so
many different texts that the rows would pass the bound, an id's rows are put
by a hash into as many slots as the bound leaves, and one row stands for its
slot with the slot's weight.  Only features of the text enter a score.

Null or empty text has all counts zero and is scored like any other.  Label
rows with null id or null label, or whose document is missing, are ignored;
repeated label rows count again.  Without any usable label there is no
evidence against a document: every score is 1.  Null ids are not held out.
Repeated documents are repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

BINS = 48
ROUNDS = 120
PAIR_ROUNDS = 60
PAIRS = 8
RATE = 0.15
LEAVES = 4
L2 = 1.0
TRAIN_ROWS = 50_000
THRESHOLD = 0.7

FEATURES = ("length", "upper", "symbols", "digits", "spaces", "high", "pipes", "word_length", "distinct",
            "adjacent", "lines_repeated", "exclaims", "stops", "ends")
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = np.array([chr(b) in "#$%&*+/<=>@[\\]^_`{|}~" for b in range(256)])


def features(text: str | None) -> list[float]:
    """Counts and ratios of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = raw.split()
    w = len(words) or 1
    lines = raw.split(b"\n")
    upper = int(h[_UPPER].sum())
    letters = upper + int(h[_LOWER].sum()) or 1
    return [
        float(np.log1p(n)), upper / letters, float(h[_SYMBOLS].sum()) / n, float(h[_DIGIT].sum()) / n,
        float(h[32] + h[9] + h[10]) / n, float(h[128:].sum()) / n, float(h[124]) / w, n / w,
        len(set(words)) / w, sum(map(eq, words, words[1:])) / w, 1 - len(set(lines)) / len(lines),
        float(h[33]) / w, float(h[46]) / w, float(h[44]) / w]


def with_features(docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``docs`` with an array of the features in place of the text."""
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            found = pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], found], names=[*b.schema.names[:-1], out_col])
    return docs.select(*rest, text_col).mapInArrow(run, schema)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf value of each bin: best-first splits of the bins by Newton gain."""
    def gain(a: int, b: int) -> tuple[float, int]:
        cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        left = cg[:-1] ** 2 / (ch[:-1] + L2)
        right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + L2)
        if not len(left):
            return 0.0, a
        k = int(np.argmax(left + right))
        return float(left[k] + right[k] - cg[-1] ** 2 / (ch[-1] + L2)), a + k + 1
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*gain(a, b), a, b) for a, b in parts), key=lambda x: x[0])
        if best[0] <= 1e-9:
            break
        parts.remove(best[2:])
        parts += [(best[2], best[1]), (best[1], best[3])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + L2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a two-dimensional table into four, its gain and leaf values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, ha = cg[:-1, :-1], ch[:-1, :-1]
    b, hb = cg[:-1, -1:] - a, ch[:-1, -1:] - ha
    c, hc = cg[-1:, :-1] - a, ch[-1:, :-1] - ha
    d, hd = cg[-1, -1] - a - b - c, ch[-1, -1] - ha - hb - hc
    gain = a**2 / (ha + L2) + b**2 / (hb + L2) + c**2 / (hc + L2) + d**2 / (hd + L2)
    out = np.zeros(g.shape)
    if not gain.size:
        return 0.0, out
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    for s, t in ((slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)),
                 (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None))):
        out[s, t] = g[s, t].sum() / (h[s, t].sum() + L2)
    return float(gain[i, j] - cg[-1, -1]**2 / (ch[-1, -1] + L2)), out


def _quantiles(values: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Quantiles between the middles of the weights; of equal weights, those of numpy."""
    if (weight == weight[0]).all():
        return np.quantile(values, at)
    order = np.argsort(values, kind="stable")
    middle = np.cumsum(weight[order]) - weight[order] / 2
    return np.interp(middle[0] + at * (middle[-1] - middle[0]), middle, values[order])


class AdditiveModel:
    """Intercept, one table per feature, and tables for pairs of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None):
        n = len(y)
        weight = np.ones(n) if weight is None else weight
        self.empty = n == 0
        if self.empty:
            return
        self.cuts = [np.unique(_quantiles(x[:, f], weight, np.linspace(0, 1, BINS + 1)[1:-1]))
                     for f in range(x.shape[1])]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        p = ((weight * y).sum() + 1) / (weight.sum() + 2)
        self.base = float(np.log(p / (1 - p)))
        bins = self.bins(x)
        total = np.full(n, self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            q = 1 / (1 + np.exp(-total))
            return weight * (y - q), weight * (q * (1 - q))

        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                g, h = slopes()
                step = RATE * _tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)), LEAVES)
                table += step
                total += step[bins[f]]
        g, h = slopes()
        gains = []
        for a, b in combinations(range(len(bins)), 2):
            size = (len(self.tables[a]), len(self.tables[b]))
            at = bins[a] * size[1] + bins[b]
            gains.append((_quadrants(np.bincount(at, g, size[0] * size[1]).reshape(size),
                                     np.bincount(at, h, size[0] * size[1]).reshape(size))[0], a, b))
        self.pairs = [(a, b, np.zeros((len(self.tables[a]), len(self.tables[b]))))
                      for _, a, b in sorted(gains, key=lambda t: (-t[0], t[1:]))[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for a, b, table in self.pairs:
                g, h = slopes()
                at = bins[a] * table.shape[1] + bins[b]
                step = RATE * _quadrants(np.bincount(at, g, table.size).reshape(table.shape),
                                         np.bincount(at, h, table.size).reshape(table.shape))[1]
                table += step
                total += step.ravel()[at]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.ones(len(x))
        if not len(x):
            return np.empty(0)
        bins = self.bins(x)
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[f]]
        for a, b, table in self.pairs:
            total += table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(featured: DataFrame, labels: DataFrame, id_col: str, features_col: str, label_col: str = "quality",
          rows: int = TRAIN_ROWS) -> AdditiveModel:
    """A model from at most about ``rows`` labelled rows that are not held out."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .select(id_col, F.col(label_col).cast("double").alias("y")))
    n_known = known.count()
    if n_known > rows:  # of the 2^63 values of the hash, the share that leaves about ``rows`` rows
        known = known.where(F.shiftrightunsigned(F.xxhash64(id_col), 1) < F.lit(rows * 2 ** 63 // n_known))
    chosen = known.groupBy(id_col).agg(F.avg("y").alias("y"), F.count("*").alias("n_labels"))
    if n_known > rows and chosen.isEmpty():
        raise ValueError(f"no training row is left of {n_known}: too few different ids are labelled")
    # distinct features of the labelled ids with their number of rows, before anything is joined or collected
    own = (featured.join(chosen.select(id_col), id_col, "left_semi")
           .groupBy(id_col, features_col).agg(F.count("*").alias("n_rows")))
    if own.count() > rows:
        slots = max(1, rows // max(1, chosen.count()))
        own = (own.groupBy(id_col, F.pmod(F.xxhash64(features_col), F.lit(slots)).alias("slot"))
               .agg(F.min(features_col).alias(features_col), F.sum("n_rows").alias("n_rows")))
    data = own.join(chosen, id_col).select(id_col, "y", features_col, "n_rows", "n_labels").collect()
    data.sort(key=lambda r: r[:3])
    of_id: Counter = Counter()
    for r in data:
        of_id[r[0]] += r[3]
    x = np.array([r[2] for r in data], float).reshape(len(data), len(FEATURES))
    return AdditiveModel(x, np.array([r[1] for r in data], float),
                         np.array([r[4] * r[3] / of_id[r[0]] for r in data], float))


def with_scores(featured: DataFrame, model: AdditiveModel, features_col: str, out_col: str) -> DataFrame:
    shared = featured.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(shared.value.score(np.array(part.tolist(), float).reshape(len(part), len(FEATURES))))
    return featured.withColumn(out_col, score(features_col)).drop(features_col)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted for every row of ``docs``."""
    featured = stored(with_features(docs.select(id_col, text_col), text_col, "features"), "quality-features")
    model = train(featured, labels, id_col, "features")
    out = with_scores(featured, model, "features", "score")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``.

    The features of all rows are written once for training; the rows
    themselves are scored where they stand, without a join."""
    featured = stored(with_features(docs.select(id_col, text_col), text_col, "features"), "quality-features")
    model = train(featured, labels, id_col, "features")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array([features(t) for t in part], float).reshape(len(part), len(FEATURES))
            yield pd.Series(shared.value.score(x))
    name = fresh(docs, "score")
    return docs.withColumn(name, score(text_col)).where(F.col(name) >= threshold).select(*docs.columns)
