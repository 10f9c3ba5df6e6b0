"""SimHash near-duplicate detection with a Gray-order hierarchical index.

A document's fingerprint has a bit set where over half of its shingles' hashes
have it set.  Fingerprints within ``max_bits`` differing bits are linked, and
linked documents form classes.

Distribution: of ``max_bits + 1`` disjoint groups of bits, two linked
fingerprints agree in at least one.  So each different fingerprint is dealt out
once per group of bits, keyed by the bits it has there, and both ends of every
link meet under some key.  A key with over ``MOST_LEAVES`` fingerprints is dealt
again over the bits not used yet (the same argument holds for those) if that at
least halves the pairs under it; if not, as in a large group of near copies, its Gray-sorted
fingerprints are cut into subtrees of ``MOST_LEAVES``, and a fingerprint visits only the later subtrees whose shared
bits it comes within ``max_bits`` of; a subtree's visitors come in shares of ``TURNS`` times that size, so
what a task holds is bounded.  (In a dense crowd, whose fingerprints differ by little more than links do, most
subtrees are near most fingerprints, and rows still grow with the square over the size of a subtree.)  No link is lost either way.

Under each key the fingerprints form a tree: sorted by Gray rank, so that
neighbours share bits; a node factors out the bits on which all its leaves agree
(those not factored out above it).  All fingerprints descend together; the
differences to the nodes' patterns add up on the way, a node beyond
``max_bits`` is pruned with its whole group, and one whose open bits can't exceed
it any more is taken as a whole.  Each key yields a star per class found, never
its pairs; classes that share a fingerprint are then merged by ``components``.

Null and empty texts have fingerprint 0 and are linked like any other.  Rows with
a null doc_id get a fingerprint and a class; a class of such rows only has a
null component_id.  Repeated rows each give a row.  An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, components, documents, hot_keys, join_spread, without_rows, word_sections, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
MOST_LEAVES = 4096       # fingerprints under one key before it is dealt again or cut into subtrees
TURNS = 16               # visitors of a subtree at a time, for each of its leaves, about
VISITORS = 1 << 16       # fingerprints of a key that are compared with its subtrees in one task, about
DEALS = 4                # times a fingerprint is dealt at most
FAN_OUT = 8              # children of a node
PAIRS = 1 << 21          # (fingerprint, node) pairs looked at together
HASHES = 1 << 16         # shingles hashed together
SECTION = 1 << 20        # characters of a text whose words are held together


# ---- fingerprints ---------------------------------------------------------------

BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 for one without words."""
    counts, total, parts = np.zeros(64, np.int64), 0, []
    for section in word_sections(text, SECTION, lower=True):
        parts = parts[max(0, len(parts) - words + 1):] + section       # a shingle may begin in an earlier section
        if len(parts) >= words:
            counts += bit_counts(parts, words)
            total += len(parts) - words + 1
    if parts and not total:                                            # fewer words: the whole sequence
        counts, total = bit_counts(parts, len(parts)), 1
    return int(((2 * counts > total).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def bit_counts(parts: list[bytes], words: int) -> np.ndarray:
    """How many hashes of the shingles of ``parts`` (``words`` of them at least) have each bit set."""
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[words - 1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), HASHES):
        some = zip(starts[at:at + HASHES].tolist(), ends[at:at + HASHES].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in some], np.uint64)
        octets = hashes.view(np.uint8).reshape(-1, 8)                 # little-endian
        if len(hashes) < 64:
            counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for k in range(8):
                counts[8 * k:8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ BYTE_BITS
    return counts


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    kind = dict(docs.dtypes)["doc_id"]
    return documents(docs).mapInArrow(run, f"doc_id {kind}, fp long")


# ---- the index under one key, for many keys at a time ------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _tree(codes: np.ndarray, group_of: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels, root first: (own mask, pattern, open bits, first child, end of children, first leaf, end leaf).

    ``codes`` are sorted by group and Gray rank.  The last level is the leaves.
    """
    starts, levels = np.arange(len(codes)), []
    group = group_of
    all_and, all_or = codes, codes
    first_leaf, end_leaf = starts, starts + 1
    child, child_end = starts, starts
    while True:
        agree = all_and | ~all_or
        levels.append([agree, all_and, child, child_end, first_leaf, end_leaf])
        new = np.concatenate(([True], group[1:] != group[:-1]))
        if new.all():
            break
        begin = np.flatnonzero(new)                       # first node of each group
        within = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
        heads = np.flatnonzero(within % FAN_OUT == 0)
        child, child_end = heads, np.append(heads[1:], len(group))
        all_and, all_or = np.bitwise_and.reduceat(all_and, heads), np.bitwise_or.reduceat(all_or, heads)
        first_leaf, end_leaf = first_leaf[heads], end_leaf[child_end - 1]
        group = group[heads]
    levels.reverse()
    out = []
    for no, (agree, pattern, child, child_end, first, end) in enumerate(levels):
        own = agree
        if no:                                            # what the parent has factored out is not looked at again
            above, a, b = levels[no - 1][0], levels[no - 1][2], levels[no - 1][3]
            own = agree & ~np.repeat(above, b - a)
        out.append((own, pattern, np.bitwise_count(~agree).astype(np.int16), child, child_end, first, end))
    return out


def _spread(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges: (index of the range, member) of all their members."""
    sizes = end - first
    at = np.repeat(np.arange(len(first)), sizes)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[at]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs into ``root`` (each leaf's smallest known companion)."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def classes(codes: np.ndarray, group_of: np.ndarray, max_bits: int = MAX_BITS, asks: np.ndarray | None = None) -> np.ndarray:
    """Index of the first code of each code's class; codes link within their group only.

    Input sorted by group and, in it, by Gray rank.  ``asks``: the codes (ascending) that
    look for the codes after them; all, if not given.
    """
    asks = np.arange(len(codes)) if asks is None else asks
    root = np.arange(len(codes))
    if len(codes) < 2:
        return root
    levels = _tree(codes, group_of)
    tops = np.concatenate(([True], group_of[1:] != group_of[:-1])).cumsum() - 1    # the root node of each leaf's group
    sizes = np.bincount(tops)
    load = np.cumsum(sizes[tops[asks]])                                             # pairs in the worst case
    fused = [np.zeros(len(level[0]), bool) for level in levels]
    at = 0
    while at < len(asks):
        end = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + PAIRS, "right")))
        query, node = asks[at:end], tops[asks[at:end]]
        apart = np.zeros(end - at, np.int16)
        at = end
        for no, (own, pattern, open_bits, child, child_end, first, last) in enumerate(levels):
            apart = apart + np.bitwise_count((codes[query] ^ pattern[node]) & own[node])
            near = (apart <= max_bits) & (last[node] - 1 > query)     # a pair counts once: the leaf after the query
            query, node, apart = query[near], node[near], apart[near]
            whole = apart + open_bits[node] <= max_bits               # the whole group is near
            if whole.any():
                q, n = query[whole], node[whole]
                fused[no][n] = True
                root = _merge(root, q, first[n])
                query, node, apart = query[~whole], node[~whole], apart[~whole]
            if no + 1 == len(levels) or not len(query):
                break
            which, node = _spread(child[node], child_end[node])
            query, apart = query[which], apart[which]
    for (_, _, _, _, _, first, last), taken in zip(levels, fused):
        which, leaf = _spread(first[taken], last[taken])
        root = _merge(root, first[taken][which], leaf)
    return root


# ---- distribution -----------------------------------------------------------------

def deal_masks(used: int, parts: int) -> list[int]:
    """``parts`` disjoint masks that cover the bits outside ``used``, most significant first."""
    free = [b for b in range(63, -1, -1) if not used >> b & 1]
    size, more = divmod(len(free), parts)
    out, at = [], 0
    for k in range(parts):
        n = size + (k < more)
        out.append(sum(1 << b for b in free[at:at + n]))
        at += n
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(rows: DataFrame, used: dict[int, int], parts: int) -> tuple[DataFrame, dict[int, int]]:
    """Deal (path, fp, parent) again: one row with a key for each group of unused bits."""
    masks = {path * parts + k: mask | new
             for path, mask in used.items() for k, new in enumerate(deal_masks(mask, parts))}
    steps = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.col("path") * parts + k)
    table = F.create_map(*[F.lit(x) for path, mask in masks.items() for x in (path, _signed(mask))])
    out = rows.select("fp", "parent", F.explode(steps).alias("path"))
    bits = F.col("fp").bitwiseAND(table[F.col("path")])
    return out.select("path", F.xxhash64("path", bits).alias("key"), "fp", "parent"), masks


def gray_order(fp: str) -> Column:
    """The Gray rank, as a long that sorts like the unsigned rank."""
    rank = F.col(fp)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-1 << 63))


def _subtrees(rows: DataFrame, most: int, max_bits: int) -> DataFrame:
    """(key, fp, asks) of (key, fp, n): new keys, under each of which one subtree's fingerprints and a share of its visitors meet.

    Ranges of (key, Gray rank) are sorted and cut every ``most`` rows, so no key need fit a task.
    """
    ranked = (rows.withColumn("rank", gray_order("fp")).repartitionByRange("key", "rank").sortWithinPartitions("key", "rank")
              .withColumn("nth", F.monotonically_increasing_id()))      # ascending over the ranges, from 2^33 times the range on
    low = F.col("nth").bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(ranked.select("key", "fp", "n", (F.col("nth") - F.pmod(low, F.lit(most))).alias("tree")), "ranked")
    trees = placed.groupBy("key", "tree").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("any"), F.max("n").alias("n"))
    salts = F.ceil(F.col("n") / VISITORS)
    every = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    agree = F.col("both").bitwiseOR(F.bitwise_not("any"))
    subtrees = trees.select("key", F.col("tree").alias("visited"), F.col("both").alias("pattern"), agree.alias("agree"), every)
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("pattern")).bitwiseAND(F.col("agree")))
    visits = written(placed.withColumn("salt", F.pmod(F.xxhash64("fp"), salts)).join(subtrees, ["key", "salt"])
                     .filter((F.col("visited") > F.col("tree")) & (apart <= max_bits)).select("key", "visited", "fp"), "visits")
    shares = (visits.groupBy("key", "visited").agg(F.ceil(F.count(F.lit(1)) / (TURNS * most)).alias("shares"))
              .withColumnRenamed("visited", "tree"))
    shares = written(shares, "shares")
    at_home = placed.select(F.xxhash64("key", "tree").alias("key"), "fp", F.lit(True).alias("asks"))
    visiting = (visits.withColumnRenamed("visited", "tree").join(shares, ["key", "tree"])
                .select(F.xxhash64("key", "tree", F.pmod(F.xxhash64("fp"), "shares")).alias("key"), "fp", F.lit(True).alias("asks")))
    leaves = (placed.join(shares, ["key", "tree"]).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
              .select(F.xxhash64("key", "tree", "share").alias("key"), "fp", F.lit(False).alias("asks")))
    return at_home.union(visiting).union(leaves)


def links(fps: DataFrame, max_bits: int = MAX_BITS, most_leaves: int = MOST_LEAVES) -> DataFrame:
    """(root, member): stars that connect the linked fingerprints of ``fps`` (fp, unique)."""
    parts = max_bits + 1
    first = fps.select("fp", F.lit(0).alias("path"), F.lit(0).cast("long").alias("parent"))
    dealt, used = _deal(first, {0: 0}, parts)
    leaves = []
    for deal in range(1, DEALS + 1):
        sizes = written(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key-sizes")
        large = sizes.filter(F.col("n") > most_leaves)
        if large.isEmpty():
            break
        total = sizes.agg(F.sum("n")).first()[0]
        hot = large.filter(F.col("n") * HOT_SHARE > total).select("key")
        marked = written(join_spread(dealt, large, "key", hot), "dealt")
        leaves.append(marked.filter("n is null").select("key", "fp", F.lit(True).alias("asks")))
        crowd = marked.filter("n is not null")
        dealt, used = _deal(crowd.select("fp", "path", F.col("key").alias("parent")), used, parts)
        pairs = (dealt.groupBy("parent", "key").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("parent").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")))
        pays = (pairs.join(large, pairs["parent"] == large["key"])
                .filter((2 * F.col("pairs") < F.col("n").cast("double") * F.col("n")) & F.lit(deal < DEALS))
                .select("parent", F.lit(True).alias("pays")))
        pays = written(pays, "pays")
        kept = join_spread(crowd, pays.withColumnRenamed("parent", "key"), "key", hot)
        stuck = kept.filter("pays is null").select("key", "fp", "n")
        if not stuck.isEmpty():
            leaves.append(_subtrees(stuck, most_leaves, max_bits))
        dealt = written(join_spread(dealt, pays, "parent", hot.withColumnRenamed("key", "parent")).filter("pays").drop("pays"), "dealt")
    leaves.append(dealt.select("key", "fp", F.lit(True).alias("asks")))
    rows = reduce(DataFrame.union, leaves).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_link_groups(max_bits), "root long, member long").distinct()


def _link_groups(max_bits: int):
    def stars(key: np.ndarray, fp: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
        codes = fp.view(np.uint64)
        order = np.lexsort((gray_rank(codes), key))
        key, codes = key[order], codes[order]
        root = classes(codes, key, max_bits, np.flatnonzero(asks[order]))
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(codes[root[linked]].view(np.int64)), pa.array(codes[linked].view(np.int64))],
            names=["root", "member"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        for batch in batches:                     # sorted by key: the last key may go on in the next batch
            held = [np.concatenate((old, c.to_numpy(zero_copy_only=False))) for old, c in zip(held, batch.columns)]
            done = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if done:
                yield stars(*(x[:done] for x in held))
                held = [x[done:] for x in held]
        if len(held[0]):
            yield stars(*held)

    return run


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               most_leaves: int = MOST_LEAVES) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id."""
    own = written(fingerprints(docs, words), "fingerprints")
    fps = written(own.groupBy("fp").agg(F.min("doc_id").alias("label")), "fps")
    # nodes are fingerprints; a label is the smallest doc_id, so that labels are unique
    found = components(fps.select(F.col("fp").alias("node"), "label"), links(fps, max_bits, most_leaves))
    found = written(found.select(F.col("node").alias("fp"), F.col("label").alias("component_id")), "classes")
    return (join_spread(own, found, "fp", hot_keys(own, "fp"))
            .select("doc_id", hex64("fp").alias("fingerprint"), "component_id"))


def hex64(col: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of each class the row whose doc_id names it stays.

    Rows with the same doc_id are one document and share its fate.
    """
    named = near_dedup(docs, **options).select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("names"))
    dropped = named.groupBy(F.xxhash64("doc_id").alias("key")).agg(F.max("names").alias("names")).filter("not names")
    return without_rows(docs, F.xxhash64("doc_id"), written(dropped.select("key"), "dropped"))
