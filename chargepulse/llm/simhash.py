"""SimHash near-duplicate detection with a Gray-order hierarchical index.

Fingerprint: lower-case A-Z, words between ASCII white space, shingles of
``shingle`` words (repeats included; fewer words make one shingle), each
hashed with XXH64 (seed 42); a bit is set if it is set in over half of the
hashes.  A text without words, or null, has fingerprint zero and is linked
like any other.

Links: two fingerprints link at ``distance`` or fewer differing bits.  Equal
fingerprints are first folded into one node.  The 64 bits are cut into six
segments; with at most four differing bits two segments agree, so every link
lies in one of the fifteen groups by (pair of segments, their bits).  All
group members are sorted by (group, Gray rank) into range partitions, which
splits a group of any size; consecutive members form leaves, whose shared
masked bit patterns form upper nodes, and two nodes are compared only if the
bits fixed in both differ in ``distance`` places at most.  A group that spans
several blocks is finished by a join of its blocks, pruned by the blocks'
patterns and dealt over cells: as many, squared, as leave about ``CELL``
blocks on each side of a cell, and at least ``SALT`` squared.  From each comparison only a
spanning set of the links is kept, which leaves the components unchanged.

Components are found by rounds of contraction over written tables; nothing
but counts reaches the driver.

Nulls: a null id takes part in linking and is never the smallest id; a
component of null ids only has a null component id.  Repeated rows are
repeated in the result.  An empty table gives an empty result.  Only the id
and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

SEED = 42
SEGMENTS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
MAX_DISTANCE = 4
LEAF = 64
BLOCK = 16384
SALT = 6
CELL = 8
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[:len(words) - shingle + 1]
        h = xxhash.xxh64_intdigest
        hashes = [h(line[a:b], SEED) for a, b in
                  zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist(), strict=True)]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    out = 0
    for j in range(8):
        set_in = np.bincount(octets[:, j], minlength=256) @ _BITS
        for k in np.flatnonzero(set_in * 2 > len(hashes)):
            out |= 1 << (8 * j + int(k))
    return out


def fingerprints(docs: DataFrame, text_col: str, out_col: str, shingle: int) -> DataFrame:
    """``docs`` with the fingerprint (long, two's complement) of ``text_col``;
    other columns pass through unread."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints.view(np.int64))],
                                             names=[*b.schema.names, out_col])
    return docs.mapInArrow(run, schema)


# --------------------------------------------------------------------- links
def _prune(nodes: list[np.ndarray], others: list[np.ndarray], distance: int) -> np.ndarray:
    """Which node pairs may hold a link: bits fixed in both nodes, and how many of them differ."""
    (one, none), (one2, none2) = nodes, others
    differ = (one[:, None] & none2[None, :]) | (none[:, None] & one2[None, :])
    return np.bitwise_count(differ) <= distance


def _patterns(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Bits set in all, and bits set in none, of each run of ``size`` members."""
    at = np.arange(0, len(x), size)
    return [np.bitwise_and.reduceat(x, at), ~np.bitwise_or.reduceat(x, at)]


def _upper(p: list[np.ndarray]) -> list[np.ndarray]:
    at = np.arange(0, len(p[0]), LEAF)
    return [np.bitwise_and.reduceat(p[0], at), np.bitwise_and.reduceat(p[1], at)]


class _Union:
    """Union-find over the members of a comparison."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, idx: np.ndarray) -> np.ndarray:
        r = self.parent[idx]
        while True:
            up = self.parent[r]
            if (up == r).all():
                return r
            r = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        ra, rb = self.roots(a), self.roots(b)
        new = ra != rb
        if not new.any():
            return
        for x, y in set(zip(ra[new].tolist(), rb[new].tolist(), strict=True)):
            x, y = int(self.roots(np.array([x]))[0]), int(self.roots(np.array([y]))[0])
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def spanning_links(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """A spanning set of the links among ``left`` (Gray order), or of those between
    ``left`` and ``right``: pairs of positions in the two put together."""
    x = left if right is None else np.concatenate([left, right])
    off = 0 if right is None else len(left)
    y = x[off:]
    u = _Union(len(x))
    leaf_l, leaf_r = _patterns(left, LEAF), _patterns(y, LEAF)
    top_l, top_r = _upper(leaf_l), _upper(leaf_r)
    for i, j in np.argwhere(_prune(top_l, top_r, distance)):
        if right is None and j < i:
            continue
        a, b = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
        below = _prune([p[a] for p in leaf_l], [p[b] for p in leaf_r], distance)
        for p, q in np.argwhere(below) + (i * LEAF, j * LEAF):
            if right is None and q < p:
                continue
            m = np.arange(p * LEAF, min((p + 1) * LEAF, len(left)))
            n = np.arange(q * LEAF, min((q + 1) * LEAF, len(y)))
            roots = u.roots(np.concatenate([m, n + off]))
            if (roots == roots[0]).all():
                continue  # all of them are in one component already
            s, t = np.nonzero(np.bitwise_count(left[m][:, None] ^ y[n][None, :]) <= distance)
            s, t = m[s], n[t] + off
            u.join(s[s != t], t[s != t])
    roots = u.roots(np.arange(len(x)))
    order = np.argsort(roots, kind="stable")
    same = roots[order][1:] == roots[order][:-1]
    return list(zip(order[:-1][same].tolist(), order[1:][same].tolist(), strict=True))


def _gray_rank(x: Column) -> Column:
    """Rank of the word in Gray order, as a long that sorts as unsigned."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, k))
    return x.bitwiseXOR(F.lit(-1 << 63))


def _groups(nodes: DataFrame) -> DataFrame:
    """(group, fp) for the fifteen pairs of segments; group packs pair and bits."""
    def part(x: Column, s: tuple[int, int]) -> Column:
        return F.shiftrightunsigned(x, s[0]).bitwiseAND(F.lit((1 << s[1]) - 1))
    fp = F.col("fp")
    keys = [F.shiftleft(F.lit(n).cast("long"), 24)
            .bitwiseOR(F.shiftleft(part(fp, a), 11)).bitwiseOR(part(fp, b))
            for n, (a, b) in enumerate(combinations(SEGMENTS, 2))]
    return nodes.select(F.explode(F.array(*keys)).alias("grp"), "fp")


_FOUND = "a long, b long, grp long, members array<long>"


def _link_runs(distance: int):
    """Over rows sorted by (group, Gray rank): links inside blocks, and the blocks of
    groups that may go on in another block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        blocks: list[tuple[int, list[int]]] = []

        def block(grp: int, x: np.ndarray, alone: bool) -> None:
            if len(x) > 1:
                u = x.view(np.uint64)
                edges.extend((int(x[i]), int(x[j])) for i, j in spanning_links(u, None, distance))
            if not alone:
                blocks.append((grp, x.tolist()))

        def out() -> pa.RecordBatch:
            n, m = len(edges), len(blocks)
            r = pa.RecordBatch.from_arrays([
                pa.array([e[0] for e in edges] + [None] * m, pa.int64()),
                pa.array([e[1] for e in edges] + [None] * m, pa.int64()),
                pa.array([None] * n + [g for g, _ in blocks], pa.int64()),
                pa.array([None] * n + [x for _, x in blocks], pa.list_(pa.int64()))],
                names=["a", "b", "grp", "members"])
            edges.clear()
            blocks.clear()
            return r

        carry_g, carry, first, cut = None, np.empty(0, np.int64), None, False
        for b in batches:
            g = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).to_numpy(zero_copy_only=False)
            if not len(g):
                continue
            if first is None:
                first = int(g[0])
            at = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]))
            sizes = np.diff(at)
            # groups of one that neither begin nor end the batch have no link here
            for k in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
                grp, own = int(g[at[k]]), x[at[k]:at[k + 1]]
                if grp == carry_g:
                    carry = np.concatenate([carry, own])
                else:
                    if carry_g is not None:
                        block(carry_g, carry, alone=not cut and carry_g != first)
                    carry_g, carry, cut = grp, own, False
                while len(carry) > BLOCK:
                    block(carry_g, carry[:BLOCK], alone=False)
                    carry, cut = carry[BLOCK:], True
            if len(edges) > 50_000 or len(blocks) > 64:
                yield out()
        if carry_g is not None:
            block(carry_g, carry, alone=False)
        yield out()
    return run


def _link_blocks(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges = set()
            for left, right in zip(b.column(0), b.column(1), strict=True):
                x = np.array(left.values, np.int64)
                y = np.array(right.values, np.int64)
                both = np.concatenate([x, y])
                edges.update((int(both[i]), int(both[j])) for i, j in
                             spanning_links(x.view(np.uint64), y.view(np.uint64), distance))
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                              pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])
    return run


def links(nodes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """A spanning set (a, b) of all links between the distinct ``fp`` of ``nodes``."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    rows = _groups(nodes)
    gray = _gray_rank(F.col("fp"))
    found = stored(rows.repartitionByRange("grp", gray).sortWithinPartitions("grp", gray)
                   .select("grp", "fp").mapInArrow(_link_runs(distance), _FOUND), "simhash-links")
    one = F.aggregate("members", F.lit(-1).cast("long"), lambda s, x: s.bitwiseAND(x))
    some = F.aggregate("members", F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))
    whole = found.where(F.col("members").isNotNull())
    salts = whole.groupBy("grp").agg(F.greatest(F.lit(SALT), F.ceil(F.count("*") / CELL).cast("int")).alias("salt"))
    blocks = whole.join(salts, "grp").select(
        "grp", "members", "salt", F.get("members", F.lit(0)).alias("head"), one.alias("one"),
        F.bitwise_not(some).alias("none"), F.pmod(F.hash("members"), F.col("salt")).alias("cell"))
    cells = F.explode(F.sequence(F.lit(0), F.col("salt") - 1))
    left = blocks.select("*", cells.alias("other")).alias("l")
    right = blocks.select("*", cells.alias("other")).alias("r")
    differ = (F.col("l.one").bitwiseAND(F.col("r.none"))).bitwiseOR(F.col("l.none").bitwiseAND(F.col("r.one")))
    across = (left.join(right, (F.col("l.grp") == F.col("r.grp")) & (F.col("l.cell") == F.col("r.other"))
                        & (F.col("l.other") == F.col("r.cell")) & (F.col("l.head") < F.col("r.head"))
                        & (F.bit_count(differ) <= distance))
              .select(F.col("l.members").alias("x"), F.col("r.members").alias("y"))
              .mapInArrow(_link_blocks(distance), "a long, b long"))
    return found.where(F.col("a").isNotNull()).select("a", "b").unionByName(across)


# ---------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node with an edge; None if there is no edge.

    Each round hooks a node to its smallest neighbour, shortens the pointers
    until they reach their roots, and contracts the edges to roots."""
    def canonical(e: DataFrame) -> DataFrame:
        return (e.where(F.col("a") != F.col("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    left = stored(canonical(edges), "edges")
    whole: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("root")), "hooks")
        while True:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            hook = stored(hook.join(up, "root").select("node", F.col("up").alias("root"),
                                                       (F.col("up") != F.col("root")).alias("moved")), "hooks")
            if hook.where("moved").isEmpty():
                break
            hook = hook.drop("moved")
        hook = hook.drop("moved")
        if whole is None:
            whole = hook
        else:
            next_root = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            whole = stored(whole.join(next_root, "root", "left")
                           .select("node", F.coalesce("up", "root").alias("root"))
                           .unionByName(hook.join(whole, "node", "left_anti")), "components")
        to_a = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = stored(canonical(left.join(to_a, "a").join(to_b, "b")
                                .select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    return whole


def component_ids(prints: DataFrame, fp_col: str, least: Column, distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component_id): the smallest ``least`` of the rows whose fingerprints are
    linked to ``fp``, directly or over others."""
    nodes = stored(prints.groupBy(F.col(fp_col).alias("fp")).agg(F.min(least).alias("least")), "simhash-nodes")
    found = components(links(nodes.select("fp"), distance))
    if found is None:
        return nodes.withColumnRenamed("least", "component_id")
    rooted = (nodes.join(found, nodes["fp"] == found["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(rooted.join(roots, "root").select("fp", "component_id"), "simhash-components")


def simhash_groups(docs: DataFrame, shingle: int = 4, distance: int = MAX_DISTANCE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col``, fingerprint (hex string), component_id for every row of ``docs``."""
    fp = fresh(docs, "fp")
    prints = stored(fingerprints(docs.select(id_col, text_col), text_col, fp, shingle)
                    .select(id_col, fp), "simhash-prints")
    ids = component_ids(prints, fp, F.col(id_col), distance).withColumnRenamed("fp", fp)
    return prints.join(ids, fp).select(
        id_col, F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = MAX_DISTANCE, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one of the smallest id, and among
    repeated ids the first row as read.  Columns stay as they are."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    kept = stored(fingerprints(docs, text_col, fp, shingle)
                  .withColumn(row, F.monotonically_increasing_id()), "simhash-documents")
    # nulls sort first in a struct, so a flag puts them last
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    ids = component_ids(kept.select(id_col, fp, row), fp, order, distance)
    winners = ids.select(F.col("component_id.row").alias(row)).distinct()
    return kept.join(winners, row, "left_semi").select(*docs.columns)
