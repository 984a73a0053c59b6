"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, so neighbours in the order share long bit
patterns. Consecutive fingerprints form leaf groups; every group, and every run
of ``FAN`` groups above it, keeps the bits that all of its members share (mask
and pattern). The self-join descends that tree from both sides at once and
drops a pair of groups as soon as the shared bits alone differ in more than
``max_bits`` places. Only surviving leaf pairs are compared bit by bit.

Defined results: a text without words (null and empty too) has fingerprint
zero and links like any other; equal texts have equal fingerprints; a repeated
row is returned as often as it is given; a null doc_id is never a component
id unless its component has no other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, map_arrow, saved

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
LEAF = 512            # fingerprints of a leaf group
SUBLEAF = 16          # of a node inside a leaf group
FAN_BITS = 4          # 16 nodes form one upper node

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- fingerprints ---------------------------------------------------------------------------------------------

def fingerprints(offsets: np.ndarray, data: np.ndarray, width: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """SimHash (unsigned) of every document of a slice."""
    n = len(offsets) - 1
    data = _LOWER[data]
    starts, ends, n_words = TB.words(offsets, data)
    out = np.zeros(n, dtype=np.uint64)
    if not len(starts):
        return out
    size = ends - starts
    at = np.zeros(len(size) + 1, dtype=np.int64)          # words joined by one space
    np.cumsum(size + 1, out=at[1:])
    joined = np.full(at[-1], 32, dtype=np.uint8)
    inside = np.ones(at[-1], dtype=bool)
    inside[at[1:] - 1] = False
    joined[inside] = data[TB.IS_WORD[data]]
    n_shingles = np.where(n_words > 0, np.maximum(n_words - width + 1, 1), 0)
    first_word = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    ordinal = np.arange(n_shingles.sum()) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    head = np.repeat(first_word, n_shingles) + ordinal
    last = head + np.repeat(np.minimum(n_words, width), n_shingles) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], seed) for a, b in zip(at[head].tolist(), (at[last + 1] - 1).tolist())),
                    dtype=np.uint64, count=len(head))
    docs = np.flatnonzero(n_shingles)
    cut = (np.cumsum(n_shingles) - n_shingles)[docs]
    for bit in range(64):
        ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), cut)
        out[docs] |= (2 * ones > n_shingles[docs]).astype(np.uint64) << np.uint64(bit)
    return out


def simhash(docs: DataFrame, width: int = SHINGLE_WORDS, *keep: str) -> DataFrame:
    """doc_id, the fingerprint as a signed 64-bit integer, and ``keep`` (long columns)."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in TB.slices(batch):
                got = fingerprints(*TB.utf8(part.column("text")), width)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "fp": pa.array(got.view(np.int64)),
                                                      **{c: part.column(c) for c in keep}})

    return map_arrow(doc_text(docs, *keep), hashed, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keep)))


def hex64(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def gray_rank(value: Column) -> Column:
    """Place of a 64-bit word in Gray order, shifted so that signed order is that order."""
    for step in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, step))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


# --- the index ------------------------------------------------------------------------------------------------

def _leaves(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf groups of a partition that is sorted by Gray rank."""
    from pyspark import TaskContext

    part, no, held = TaskContext.get().partitionId(), 0, np.zeros(0, dtype=np.uint64)
    kind = pa.schema([("part", pa.int64()), ("no", pa.int64()), ("ones", pa.int64()), ("any", pa.int64()),
                      ("members", pa.binary())])

    def group(members: np.ndarray) -> dict:
        return {"part": part, "no": no, "ones": int(np.bitwise_and.reduce(members).view(np.int64)),
                "any": int(np.bitwise_or.reduce(members).view(np.int64)), "members": members.tobytes()}

    for batch in rows:
        held = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
        while len(held) >= LEAF:
            yield pa.RecordBatch.from_pylist([group(held[:LEAF])], schema=kind)
            held, no = held[LEAF:], no + 1
    if len(held):
        yield pa.RecordBatch.from_pylist([group(held)], schema=kind)


def leaf_groups(fps: DataFrame, n_parts: int) -> DataFrame:
    """part and no (the leaf's place in Gray order), ones (bits that all members have), any (that some have)."""
    ranked = fps.select("fp", gray_rank(F.col("fp")).alias("rank"))
    ranked = ranked.repartitionByRange(n_parts, "rank").sortWithinPartitions("rank")
    return map_arrow(ranked.select("fp"), _leaves, "part long, no long, ones long, any long, members binary")


def numbered(leaves: DataFrame) -> tuple[DataFrame, int]:
    """The leaves with one number each in Gray order, and the levels above them."""
    most = leaves.agg(F.max("no").alias("no"), F.max("part").alias("part")).first()
    if most["no"] is None:
        return leaves.withColumn("node", F.lit(0).cast("long")), 1
    no_bits = -(-int(most["no"]).bit_length() // FAN_BITS) * FAN_BITS
    bits = no_bits + int(most["part"]).bit_length()
    node = F.shiftleft("part", no_bits).bitwiseOR(F.col("no")) if no_bits else F.col("part")
    return leaves.withColumn("node", node), max(1, -(-bits // FAN_BITS))


def apart(a: str, b: str) -> Column:
    """Bits in which every member of one node differs from every member of the other."""
    one = F.col(f"{a}.ones").bitwiseAND(F.bitwise_not(F.col(f"{b}.any")))
    two = F.col(f"{b}.ones").bitwiseAND(F.bitwise_not(F.col(f"{a}.any")))
    return F.bit_count(one.bitwiseOR(two))


def surviving_pairs(leaves: DataFrame, levels: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs of leaf groups (a <= b) whose shared bits differ in ``max_bits`` places at most.

    Level by level from the root: a pair of nodes is expanded to the pairs of
    their children; pairs that differ too much go, with all below them.
    """
    tree = [leaves.select("node", "ones", "any")]
    for _ in range(levels - 1):
        tree.append(tree[-1].groupBy(F.shiftright("node", FAN_BITS).alias("node"))
                    .agg(F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any")))
    pairs = None
    for level in reversed(tree):
        child = level.withColumn("up", F.shiftright("node", FAN_BITS))
        x, y = child.alias("x"), child.alias("y")
        near = (F.col("x.node") <= F.col("y.node")) & (apart("x", "y") <= max_bits)
        if pairs is None:       # the children of the root
            joined = x.join(y, (F.col("x.up") == F.col("y.up")) & near)
        else:
            joined = pairs.join(x, F.col("a") == F.col("x.up")).join(y, (F.col("b") == F.col("y.up")) & near)
        pairs = joined.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return pairs


# --- links ----------------------------------------------------------------------------------------------------

def _close(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of members within ``max_bits``; sub-nodes prune before members are compared."""
    ca, cb = np.arange(0, len(a), SUBLEAF), np.arange(0, len(b), SUBLEAF)
    one_a, any_a = np.bitwise_and.reduceat(a, ca), np.bitwise_or.reduceat(a, ca)
    one_b, any_b = np.bitwise_and.reduceat(b, cb), np.bitwise_or.reduceat(b, cb)
    gap = np.bitwise_count((one_a[:, None] & ~any_b[None]) | (one_b[None] & ~any_a[:, None])) <= max_bits
    if same:
        gap &= ca[:, None] <= cb[None]
    x, y = np.nonzero(gap)
    rows = lambda k, size: np.minimum(k[:, None] * SUBLEAF + np.arange(SUBLEAF), size - 1)
    ra, rb = rows(x, len(a)), rows(y, len(b))
    k, i, j = np.nonzero(np.bitwise_count(a[ra][:, :, None] ^ b[rb][:, None, :]) <= max_bits)
    return ra[k, i], rb[k, j]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index connected to each of ``n`` nodes by the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(pairs: DataFrame, leaves: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """u, v: links that connect what the leaf pairs hold within ``max_bits`` (a forest per leaf pair)."""

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            us, vs = [], []
            for a, b, same in zip(batch.column("ma").to_pylist(), batch.column("mb").to_pylist(),
                                  batch.column("same").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                i, j = _close(a, b, same, max_bits)
                if same:
                    i, j = i[i != j], j[i != j]
                if len(i):
                    both = a if same else np.concatenate([a, b])
                    root = _forest(i, j if same else j + len(a), len(both))
                    child = np.flatnonzero(root != np.arange(len(both)))
                    us.append(both[child])
                    vs.append(both[root[child]])
            if us:
                yield pa.RecordBatch.from_pydict({"u": pa.array(np.concatenate(us).view(np.int64)),
                                                  "v": pa.array(np.concatenate(vs).view(np.int64))})

    members = leaves.select("node", "members")
    full = (pairs.join(members.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a")
            .join(members.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b")
            .select("ma", "mb", (F.col("a") == F.col("b")).alias("same")))
    return map_arrow(full, compare, "u long, v long").where("u != v")


def stars(edges: DataFrame) -> DataFrame:
    """u, v: every linked node u with the smallest node v of its component.

    Alternates the large-star and small-star steps; each round is a written
    table, so an executor's loss costs one round at most.
    """
    down = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    edges = saved(down(edges).distinct(), "links")
    while True:
        wide = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = wide.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = wide.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = down(large).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        edges = saved(down(small).distinct(), "stars")
        parents = edges.select(F.col("v").alias("u"))
        if not edges.join(parents, "u", "left_semi").limit(1).count() and \
                not edges.groupBy("u").count().where("count > 1").limit(1).count():
            return edges


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """fp, rep (its smallest doc_id) and root (a fingerprint that stands for the component) of every fingerprint."""
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    n_parts = max(1, -(-nodes.count() // (LEAF * 64)))
    leaves, levels = numbered(saved(leaf_groups(nodes, n_parts), "leaves"))
    root = stars(links(surviving_pairs(leaves, levels, max_bits), leaves, max_bits))
    return nodes.join(root.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))


def link_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps`` (doc_id, fp) with component_id: the smallest doc_id reachable over links of ``max_bits`` bits."""
    labelled = _rooted(fps, max_bits)
    low = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(labelled.join(low, "root").select("fp", "component_id"), "fp")   # AQE splits a hot fp


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id, one row per row of ``docs``."""
    fps = saved(simhash(docs, width), "simhash")
    return link_components(fps, max_bits).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (of repeated rows, one).

    Rows that share a doc_id but have different texts are documents of their own.
    A document without doc_id goes by a number made from its text, larger than
    any doc_id below 2^62, so it stays only if no document with one is near.
    """
    top = 1 << 62
    stand_in = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(top - 1)).bitwiseOR(F.lit(top))
    # the given columns go along as one, so that none of theirs can be taken for one of ours
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("_near_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_near_text"))
    given = keyed.select(F.col("_near_id").alias("doc_id"), F.col("row.text").alias("text"), "_near_text")
    fps = saved(simhash(given, width, "_near_text"), "simhash")
    roots = _rooted(fps.select("doc_id", "fp"), max_bits).select("fp", "root")
    firsts = fps.join(roots, "fp").groupBy("root").agg(F.min(F.struct("doc_id", "_near_text")).alias("first")).select(
        F.col("first.doc_id").alias("_near_id"), F.col("first._near_text").alias("_near_text"))
    key = ["_near_id", "_near_text"]
    return keyed.join(firsts, key, "left_semi").dropDuplicates(key).select("row.*")
