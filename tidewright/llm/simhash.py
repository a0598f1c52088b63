"""SimHash near-duplicates: fingerprints, a vantage-point tree over them, components.

Fingerprints are made in the tasks that read the text. Documents with the same
fingerprint are one node from then on, so a group of exact copies costs one row
however large it is.

The tree has one vantage point for each level, the same for all its nodes; the
children of a node are the rings of equal Hamming distance from that point. A
leaf is thus named by its distances from all vantage points. By the triangle
inequality two fingerprints at most ``radius`` bits apart lie in rings at most
``radius`` apart on every level, and as the parity of all their ring differences is
the parity of their distance, few leaves around a fingerprint's own remain.
Each fingerprint is stored in its own leaf and looks into those of them that come
after it, so every pair is met exactly once. Leaves are the shards: Spark
deals them to tasks, and a task compares one leaf at a time, going on down the tree
with further vantage points while a leaf is large.

A leaf reports what its links connect, at most one row for each fingerprint it
holds, not all pairs. Components come from alternating stars over those rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import cut

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints that a query should meet in a leaf, above this the tree gets another level.
LEAF = 400
#: Share of random 64-bit fingerprints in which two of them have a ring in common.
RING = 0.0705
#: Levels of shards. A fingerprint visits (3**n + 2**n) / 2 leaves of n levels, so larger tables get larger leaves.
LEVELS = (3, 5)
#: Fingerprints of a leaf that are compared side by side, and the most levels that the tree goes on to inside a task.
SIDE_BY_SIDE, DEEPEST = 512, 24
#: Links that a task takes in a round of the components.
EDGES = 50_000
#: A node of more links than this, or than this share of all, is met apart from the others.
HUB, HUB_SHARE = 64, 10_000
#: Comparisons made at once in a task.
BLOCK = 1 << 22
# The pipeline's stage has settings of its own.
STAGE_SHINGLE, SIMILAR = 5, (8, 10)
#: Bits of 128 in which linked fingerprints differ at most (at similarity 0.8 about 19 do).
STAGE_RADIUS = 36
#: A tree of the stage measures distances over so many bits, and its rings are visited up to this difference.
SAMPLE, SAMPLE_RADIUS = 24, 3
#: Share of the bits that differ at similarity 0.8, and of the pairs with that share that all trees may miss.
APART, MISSED = 0.1515, 0.001
#: Fingerprints of a shard, and of a leaf, that a task aims at.
SHARD, STAGE_LEAF = 4096, 128
#: Rows of a shard up to which it is one leaf.
LAGS = 512
#: Texts of a block of a group that is compared in whole, and the most blocks of a group.
GROUP_BLOCK, GROUP_BLOCKS = 128, 64


def vantage_points(n: int) -> list[int]:
    """The first ``n`` points: a fixed sequence of well-mixed 64-bit words."""
    out, x = [], 0
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) % 2**64
        z = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        out.append(z ^ (z >> 31))
    return [v - 2**64 if v >= 2**63 else v for v in out]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text; zero without words."""
    import xxhash

    digest = xxhash.xxh64_digest
    w = (text or b"").lower().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < shingle else map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
    hashes = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), dtype=np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(hashes[i : i + 8192], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), 8192))
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp for each row. Only A-Z are lower-cased; a null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(rows, f"doc_id {kind}, fp long")


def levels_for(n: int) -> int:
    """Levels at which a leaf meets a query with at most ``LEAF`` fingerprints."""
    k, most = LEVELS
    while k < most and n * RING**k > LEAF:
        k += 1
    return k


def steps_to_visit(levels: int, radius: int = RADIUS) -> list[tuple[int, ...]]:
    """Ring differences of the leaves after a fingerprint's own that may hold one within ``radius``."""
    out = []
    for d in product(range(-radius, radius + 1), repeat=levels):
        if len({x % 2 for x in d}) == 1 and d > (0,) * levels:
            out.append(d)
    return out


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 the smallest node that the links reach."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        label = new[label]
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def leaf_links(stored: np.ndarray, visiting: np.ndarray, radius: int = RADIUS, level: int = LEVELS[1]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints that connect what the links within a leaf and into it connect, a forest of them.

    A large leaf is parted into the rings around the next vantage point: a ring's
    fingerprints meet each other, and those of the rings up to ``radius`` after it and
    of the visitors' rings about it.
    """
    if len(stored) <= SIDE_BY_SIDE or level >= LEVELS[1] + DEEPEST:
        return _side_by_side(stored, visiting, radius)
    point = np.int64(vantage_points(level + 1)[-1])
    ring, far = (np.bitwise_count((x ^ point).view(np.uint64)).astype(np.int64) for x in (stored, visiting))
    u, v = [], []
    for r in np.unique(ring):
        after = stored[(ring > r) & (ring <= r + radius)]
        a, b = leaf_links(stored[ring == r], np.concatenate([after, visiting[np.abs(far - r) <= radius]]), radius, level + 1)
        u.append(a)
        v.append(b)
    u, v = np.concatenate(u), np.concatenate(v)
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = connected(len(names), at[: len(u)], at[len(u) :])
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def _side_by_side(stored: np.ndarray, visiting: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by comparing in blocks; after each block only a forest of the links stays."""
    both = np.concatenate([stored, visiting])
    bits = both.view(np.uint64)  # bitwise_count takes the absolute value of signed ones
    label = np.arange(len(both))
    step = max(1, BLOCK // max(1, len(stored)))
    for at in range(0, len(both), step):
        i, j = np.nonzero(np.bitwise_count(bits[at : at + step, None] ^ bits[None, : len(stored)]) <= radius)
        i += at
        once = i > j  # two stored ones are met from both sides, and each by itself
        if once.any():
            moved = np.nonzero(label != np.arange(len(both)))[0]
            label = connected(len(both), np.concatenate([moved, i[once]]), np.concatenate([label[moved], j[once]]))
    moved = np.nonzero(label != np.arange(len(both)))[0]
    return both[moved], both[label[moved]]


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stored and visiting fingerprints of each leaf, from batches sorted by leaf."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        leaf, fp, own = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        edges = np.flatnonzero(leaf[1:] != leaf[:-1]) + 1
        if held and held[0][0][0] == leaf[0]:
            upto = edges[0] if len(edges) else len(leaf)
            held.append((leaf[:upto], fp[:upto], own[:upto]))
            if not len(edges):
                continue
        else:
            upto = 0
        if held:
            yield _one_leaf(held)
        bounds = [upto, *(e for e in edges if e > upto), len(leaf)]
        for x, y in zip(bounds[:-2], bounds[1:-1], strict=True):
            yield _one_leaf([(leaf[x:y], fp[x:y], own[x:y])])
        held = [(leaf[bounds[-2] :], fp[bounds[-2] :], own[bounds[-2] :])]
    if held:
        yield _one_leaf(held)


def _one_leaf(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    fp = np.concatenate([p[1] for p in parts])
    own = np.concatenate([p[2] for p in parts]).astype(bool)
    return fp[own], fp[~own]


def links(nodes: DataFrame, radius: int = RADIUS, count: int | None = None) -> DataFrame:
    """u, v: rows that connect the distinct fingerprints ``nodes.fp`` as their links do."""
    levels = levels_for(nodes.count() if count is None else count)
    ring = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(v))) + radius for v in vantage_points(levels)]
    # seven bits hold a ring and the visits beyond either end
    home = sum((r.cast("long") * 128**k for k, r in enumerate(reversed(ring))), F.lit(0).cast("long"))
    visits = [sum(d * 128**k for k, d in enumerate(reversed(step))) for step in steps_to_visit(levels, radius)]
    dealt = nodes.select("fp", home.alias("home")).select(
        "fp", "home", F.explode(F.array(F.lit(0).cast("long"), *(F.lit(v).cast("long") for v in visits))).alias("step")
    )
    dealt = dealt.select((F.col("home") + F.col("step")).alias("leaf"), "fp", (F.col("step") == 0).alias("own"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stored, visiting in _leaves(b for b in batches if b.num_rows):
            if len(stored):
                u, v = leaf_links(stored, visiting, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(rows, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """u, v: each linked node and the smallest node of its component (itself left out).

    Alternating stars: every node hands its larger neighbours to its smallest one,
    then keeps only its smallest. The rows of hubs, nodes of very many links, do not
    meet in one task: there are few hubs, so these are broadcast (at most twice
    ``HUB_SHARE`` or so). Each round is cut to the checkpoint folder; the rounds end
    when one changes nothing.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    # the rows only get fewer; no more tasks than they need
    most = edges.count()
    tasks = most // EDGES + 1
    most = max(HUB, most // HUB_SHARE)
    edges = edges.coalesce(tasks)
    seen = None

    def with_smallest(links: DataFrame, at: str, most: int) -> DataFrame:
        low = links.groupBy("u").agg(F.min(at).alias("m"), F.count("*").alias("n"))
        hubs = low.where(F.col("n") > most).select(F.col("u").alias("hub"), F.col("m").alias("of_hub"))
        known = links.join(F.broadcast(hubs), F.col("u") == F.col("hub"), "left").drop("hub")
        plain = known.where("of_hub IS NULL").drop("of_hub").join(low.where(F.col("n") <= most).select("u", "m"), "u")
        return plain.unionByName(known.where("of_hub IS NOT NULL").withColumnRenamed("of_hub", "m").select(*plain.columns))

    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_smallest(both.withColumn("low", F.least("u", "v")), "low", most).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = with_smallest(large, "v", most).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges
        seen = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included; null ids take part but are never the smallest unless a component has
    no other. Repeated rows are linked like copies. Texts without words share the
    fingerprint zero and are linked like any others.
    """
    marked = cut(fingerprints(docs, id_col, text_col))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def shingles(text: bytes | None) -> np.ndarray:
    """The set of hashes of a text's ``STAGE_SHINGLE``-word shingles: two 64-bit words each, sorted."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    w = (text or b"").lower().split()
    if not w:
        return np.zeros((0, 2), ">u8")
    grams = {b" ".join(w)} if len(w) < STAGE_SHINGLE else set(map(b" ".join, zip(*(w[i:] for i in range(STAGE_SHINGLE)), strict=False)))
    return np.frombuffer(b"".join(sorted(digest(g, SEED) for g in grams)), ">u8").reshape(-1, 2)


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """The 128-bit SimHash of a set of shingles."""
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 16)
    ones = sum((np.unpackbits(octets[i : i + 8192], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(octets), 8192)), np.zeros(128, np.int64))
    return np.packbits(2 * ones > len(octets)).tobytes()


def _node(hashes: np.ndarray) -> int:
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(hashes.tobytes(), SEED), "big", signed=True)


def _row_key(docs: DataFrame) -> DataFrame:
    """Rows as the struct ``whole``, and ``key``, a digest of all columns, so that rows of one digest are interchangeable."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    return rows.withColumn("key", F.md5(F.to_json("whole", {"ignoreNullFields": "false"}).cast("binary")))


def forest(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Indices of links that form the least spanning forest of nodes 0 to n - 1; ties go by the nodes."""
    order = np.lexsort((np.maximum(a, b), np.minimum(a, b), w))
    label, chosen = np.arange(n), []
    while len(order):
        la, lb = label[a[order]], label[b[order]]
        order, la, lb = order[la != lb], la[la != lb], lb[la != lb]
        first = np.full(n, len(order))
        np.minimum.at(first, la, np.arange(len(order)))
        np.minimum.at(first, lb, np.arange(len(order)))
        pick = np.unique(first[first < len(order)])
        chosen.append(order[pick])
        label = connected(n, la[pick], lb[pick])[label]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def _differing(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> np.ndarray:
    return np.bitwise_count(x[0] ^ y[0]).astype(np.int64) + np.bitwise_count(x[1] ^ y[1])


def forest_for(n: int) -> tuple[int, int]:
    """Bits that part each tree of ``n`` fingerprints into shards, and the number of trees."""
    k = max(0, math.ceil(math.log2(max(1, n) / SHARD)))
    within = sum(math.comb(SAMPLE, d) * APART**d * (1 - APART) ** (SAMPLE - d) for d in range(SAMPLE_RADIUS + 1))
    return k, math.ceil(math.log(MISSED) / math.log1p(-within * (1 - APART) ** k))


def tree_bits(tree: int, k: int) -> tuple[np.ndarray, tuple[np.uint64, np.uint64]]:
    """Positions of the ``k`` bits that name a shard of a tree, and masks of the bits over which it measures."""
    order = np.random.default_rng(SEED + tree).permutation(128).tolist()
    mask = sum(1 << (127 - b) for b in order[k : k + SAMPLE])
    return np.array(order[:k], np.int64), (np.uint64(mask >> 64), np.uint64(mask % 2**64))


def tree_leaves(f1: np.ndarray, f2: np.ndarray, mask: tuple[np.uint64, np.uint64], stored: np.ndarray, visiting: np.ndarray, level: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows stored in each leaf of the vantage-point tree over the bits of ``mask``, and those that visit it.

    Children are the rings around one vantage point a level, as in ``leaf_links``. Each two rows
    at most ``SAMPLE_RADIUS`` of these bits apart meet in one leaf, once.
    """
    if len(stored) <= STAGE_LEAF or level >= DEEPEST:
        yield stored, visiting
        return
    p1, p2 = (np.int64(v).view(np.uint64) for v in vantage_points(2 * level + 2)[-2:])
    ring, far = (np.bitwise_count((f1[x] ^ p1) & mask[0]).astype(np.int64) + np.bitwise_count((f2[x] ^ p2) & mask[1]) for x in (stored, visiting))
    for r in np.unique(ring):
        after = stored[(ring > r) & (ring <= r + SAMPLE_RADIUS)]
        yield from tree_leaves(f1, f2, mask, stored[ring == r], np.concatenate([after, visiting[np.abs(far - r) <= SAMPLE_RADIUS]]), level + 1)


def bucket_pairs(bucket: np.ndarray, size: np.ndarray, f1: np.ndarray, f2: np.ndarray, mask_of: Callable[[int], tuple[np.uint64, np.uint64]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows i, j that connect in each bucket what pairs at most ``STAGE_RADIUS`` bits apart, of fitting sizes, connect.

    A bucket is a shard of a tree over the bits ``mask_of`` gives for it, and the pairs are those that
    meet in a leaf; without ``mask_of``, or in a small bucket, all pairs meet. Of these the
    shortest are taken, ties by the order of the rows. Rows are sorted by
    bucket, then node, so buckets that hold the same nodes give the same pairs, and a
    group of near copies gives fewer pairs than it has rows.
    """
    num, den = SIMILAR

    def near(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        sized = den * np.minimum(size[i], size[j]) >= num * np.maximum(size[i], size[j])
        i, j = i[sized], j[sized]
        d = _differing((f1[i], f2[i]), (f1[j], f2[j]))
        return i[d <= STAGE_RADIUS], j[d <= STAGE_RADIUS], d[d <= STAGE_RADIUS]

    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    lengths = np.diff(np.r_[starts, len(bucket)])
    out_i, out_j, small = [], [], []
    at = np.flatnonzero(np.repeat(lengths <= LAGS, lengths))
    end = np.repeat(starts + lengths, lengths)
    for lag in range(1, LAGS):
        at = at[at + lag < end[at]]
        if not len(at):
            break
        i, j, d = near(at, at + lag)
        small.append((i, j, d))
    if small:
        i, j, d = (np.concatenate(c) for c in zip(*small, strict=True))
        keep = forest(len(bucket), i, j, d)
        out_i.append(i[keep])
        out_j.append(j[keep])
    for s, n in zip(starts[lengths > LAGS], lengths[lengths > LAGS], strict=True):
        a, b, w = (np.zeros(0, np.int64) for _ in range(3))
        held: list[tuple[np.ndarray, ...]] = []
        all_, none = np.arange(n), np.zeros(0, np.int64)
        leaves = tree_leaves(f1[s : s + n], f2[s : s + n], mask_of(int(bucket[s])), all_, none) if mask_of else [(all_, none)]
        for stored, visiting in leaves:
            both = np.concatenate([stored, visiting])
            step = max(1, BLOCK // len(stored))
            for x in range(0, len(both), step):
                # each two stored ones once, and visitors with all stored ones
                i, j = np.nonzero(np.arange(x, min(len(both), x + step))[:, None] > np.arange(len(stored))[None, :])
                i, j, d = near(both[i + x] + s, stored[j] + s)
                held.append((i - s, j - s, d))
                if sum(len(h[0]) for h in held) > 8 * n:
                    a, b, w = (np.concatenate(c) for c in zip((a, b, w), *held, strict=True))
                    keep = forest(int(n), a, b, w)
                    a, b, w = a[keep], b[keep], w[keep]
                    held.clear()
        a, b, w = (np.concatenate(c) for c in zip((a, b, w), *held, strict=True))
        keep = forest(int(n), a, b, w)
        out_i.append(a[keep] + s)
        out_j.append(b[keep] + s)
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def similar_pairs(nodes: DataFrame) -> DataFrame:
    """u, v: nodes (node, size, f1, f2) that meet in a leaf of some tree and differ in few of all bits.

    Around a whole fingerprint rings part nothing at this radius, so there are several vantage-point
    trees, each over a sample of the bits and with a small radius. Spark deals each tree by
    further bits into shards; their number grows with the table, and that of the trees
    so that a pair's chance to meet stays the same. Within a shard the tree goes on in the task.
    """
    k, trees = forest_for(nodes.count())
    places = np.stack([tree_bits(t, k)[0] for t in range(trees)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 1000):
                b = whole.slice(x, 1000)
                node, size, f1, f2 = (b.column(c).to_numpy() for c in range(4))
                bits = np.unpackbits(np.stack([f1, f2], axis=1).astype(">i8").view(np.uint8).reshape(-1, 16), axis=1)
                shard = bits[:, places.ravel()].reshape(len(node), trees, k) @ (1 << np.arange(k))
                bucket = (shard + (np.arange(trees) << k)).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (bucket, *(np.repeat(y, trees) for y in (node, size, f1, f2)))], names=["bucket", "node", "size", "f1", "f2"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out() -> pa.RecordBatch:
            bucket, node, size, f1, f2 = (np.concatenate(c) for c in zip(*held, strict=True))
            i, j = bucket_pairs(bucket, size, f1.view(np.uint64), f2.view(np.uint64), lambda b: tree_bits(b >> k, k)[1])
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], names=["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in range(5)]
            edge = int(np.searchsorted(cols[0], cols[0][-1]))  # the last bucket may go on
            if edge:
                held.append([c[:edge] for c in cols])
                yield out()
                held.clear()
            held.append([c[edge:] for c in cols])
        if held:
            yield out()

    form = "bucket long, node long, size long, f1 long, f2 long"
    dealt = nodes.select("node", "size", "f1", "f2").mapInArrow(deal, form)
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(meet, "u long, v long").distinct()


def block_links(root: np.ndarray, f1: np.ndarray, f2: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots that connect what exact links of the rows ``left`` to the rows ``right`` connect, a forest of them.

    Only rows at most ``STAGE_RADIUS`` bits apart are compared, and only if nothing before has connected them.
    """
    num, den = SIMILAR
    names, label = np.unique(root, return_inverse=True)
    start = label.copy()
    grams, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(x) for x in sets])
    ends = np.cumsum(size)
    here = np.zeros(len(grams), bool)
    label, u, v = np.arange(len(names)), [], []
    for i in left:
        j = right[label[start[right]] != label[start[i]]]
        j = j[(_differing((f1[i], f2[i]), (f1[j], f2[j])) <= STAGE_RADIUS) & (den * np.minimum(size[i], size[j]) >= num * np.maximum(size[i], size[j]))]
        if not len(j):
            continue
        own = flat[ends[i] - size[i] : ends[i]]
        here[own] = True
        common = np.array([np.count_nonzero(here[flat[ends[x] - size[x] : ends[x]]]) for x in j])
        here[own] = False
        for x in j[common * den >= (size[i] + size[j] - common) * num]:
            a, b = label[start[i]], label[start[x]]
            if a != b:
                u.append(names[start[i]])
                v.append(names[start[x]])
                label[label == max(a, b)] = min(a, b)
    return np.array(u, np.int64), np.array(v, np.int64)


def remaining_links(members: DataFrame) -> DataFrame:
    """u, v: roots that exact links connect within each group of ``members`` (group, n, node, root, f1, f2, grams).

    A group of ``n`` texts is cut into blocks, and each two blocks meet once, so a text is
    dealt to at most ``GROUP_BLOCKS`` tasks.
    """
    blocks = F.least(F.lit(GROUP_BLOCKS), F.ceil(F.col("n") / GROUP_BLOCK)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("group", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "root", "f1", "f2", "grams")

    def meet(t: pa.Table) -> pa.Table:
        x, y, block, root, f1, f2 = (t.column(c).to_numpy() for c in ("x", "y", "block", "root", "f1", "f2"))
        sets = [np.asarray(g, np.int64) for g in t.column("grams").to_numpy()]
        left, right = np.flatnonzero(block == x[0]), np.flatnonzero(block == y[0])
        u, v = block_links(root, f1.view(np.uint64), f2.view(np.uint64), sets, left, right) if len(left) and len(right) else (np.zeros(0, np.int64),) * 2
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy("group", "x", "y").applyInArrow(meet, "u long, v long")


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key of the row, text digest, root for each row of ``docs``; links are exact Jaccard of shingle sets >= 0.8."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col("whole").getField(text_col).cast("string").cast("binary")
    keyed = _row_key(docs)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(2).to_pylist()]
            wide = np.frombuffer(b"".join(map(wide_fingerprint, sets)), ">i8").reshape(-1, 2).astype(np.int64)
            cols = [b.column(0), b.column(1), b.column(3), pa.array([_node(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(wide[:, 0]), pa.array(wide[:, 1])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "digest", "node", "size", "f1", "f2"])

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(0).to_pylist()]
            grams = [np.unique(x[:, 0].astype(np.uint64)).view(np.int64) for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in sets], pa.int64()), pa.array(grams, pa.list_(pa.int64()))], names=["node", "grams"])

    whole = keyed.select(F.col("whole").getField(id_col).alias("doc_id"), "key", text.alias("text"), F.md5(F.coalesce(text, F.lit("").cast("binary"))).alias("digest"))
    marked = cut(whole.mapInArrow(mark, f"doc_id {kind}, key string, digest string, node long, size long, f1 long, f2 long"))
    nodes = cut(marked.groupBy("node").agg(F.min("key").alias("key"), F.first("size").alias("size"), F.first("f1").alias("f1"), F.first("f2").alias("f2")).where("size > 0"))
    pairs = cut(similar_pairs(nodes))
    met = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    read = nodes.join(met, "node", "left_semi").select("key")
    # a row that is repeated in all columns comes once
    sets = cut(keyed.select("key", text.alias("text")).join(read, "key", "left_semi").select("text").mapInArrow(sets_of, "node long, grams array<long>").dropDuplicates(["node"]))
    num, den = SIMILAR
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("grams").alias("gu")), "u").join(sets.select(F.col("node").alias("v"), F.col("grams").alias("gv")), "v")
    both = both.select("u", "v", (F.size("gu") + F.size("gv")).alias("n"), F.size(F.array_intersect("gu", "gv")).alias("common"))
    checked = cut(both.select("u", "v", (F.col("common") * den >= (F.col("n") - F.col("common")) * num).alias("similar")))
    roots = components(checked.where("similar").select("u", "v"))
    # where a pair fails the check, links that the forests left out for it may remain: such groups are compared in whole
    of = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    failed = checked.where("NOT similar").join(of.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left").join(of.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left")
    near = components(failed.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    group = near.unionByName(near.select(F.col("v").alias("u"), "v").distinct()).select(F.col("u").alias("root"), F.col("v").alias("group"))
    # a node that no link reaches is its own root
    members = cut(sets.select("node").join(of, "node", "left").select("node", F.coalesce("root", "node").alias("root")).join(group, "root"))
    count = members.groupBy("group").agg(F.count("*").alias("n")).where("n > 2")
    members = members.join(count, "group").join(nodes.select("node", "f1", "f2"), "node").join(sets, "node")
    more = components(remaining_links(members))
    final = F.coalesce("last", "root", "node").alias("root")
    rooted = marked.join(of, "node", "left").withColumn("root", F.coalesce("root", "node")).join(more.select(F.col("u").alias("root"), F.col("v").alias("last")), "root", "left")
    return rooted.select("doc_id", "key", "digest", final)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the first by id, text and other columns.

    Rows are linked where their sets of five-word shingles have a Jaccard similarity of 0.8
    or more; texts without words are linked with each other. An id that several rows
    share does not link them. Of the rows of a group that have no id the first is kept too.
    """
    found = shingle_components(docs, id_col, text_col)
    first = found.groupBy("root", F.col("doc_id").isNull().alias("nameless")).agg(F.min(F.struct("doc_id", "digest", "key")).alias("first"))
    kept = first.select(F.col("first.key").alias("key"))
    return _row_key(docs).join(kept, "key", "left_semi").dropDuplicates(["key"]).select("whole.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
