"""MinHash near-dedup by a chosen-path set similarity join.

A document is its set of distinct 5-word shingles; documents with
``|A & B| / |A | B| >= 0.75`` are linked and components are their closure.

1. One Arrow pass gives set size, a 64-bit fingerprint of the set and a MinHash
   signature. Equal sets become one class (copies cost one aggregated row).
2. Independent trees branch the classes: a node is refined by the minwise tokens
   of coordinates its path selects. Nodes are counted in Spark; those of at most
   ``LEAF`` classes are leaves, larger ones branch again. In a larger node the
   classes that look alike its smallest one are compared with it in leaves of
   their own and then count as one group, so a node of one group ends there and
   a huge family of near copies costs linear work. From level ``DENSE_FROM`` on a
   node of at most ``DENSE`` classes is a leaf (a family's nodes hardly shrink by
   branching again); a larger one at ``DEPTH`` is compared block against block.
3. Leaves drop classes whose signature agrees with no other one of the leaf in half
   the coordinates (a true link fails that with probability 1e-5). Equal leaves of
   several trees are compared once.
4. Full sets, made from the texts of the classes that are left, meet in the
   leaves; links are confirmed exactly and leave as a spanning forest.
5. Components: alternating large-star and small-star steps, staged each round.

A link survives a tree with probability 0.66 to 0.75; ``TREES`` = 10 misses less than 1 in
10,000, and families have many links to be found by.

Defined results: texts without words have the empty set and link with nothing;
rows with a null id link with nothing and are kept; rows of one id and equal sets
are one class; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import by_key, checked_broadcast, keyed, release, staged
from markforge.llm.words import Words, document_of, mix64, slices

WIDTH, PERCENT = 5, 75
COORDINATES, TREES, LEAF, DEPTH = 64, 10, 128, 4
DENSE, DENSE_FROM = 4096, 3  # classes of a node that one task compares, from this level on
ALIKE = 32  # equal coordinates that make a pair worth comparing
_SEEDS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _shingles(words: Words, buf, offsets, width: int):
    """``(hashes, bounds)``: the sorted distinct shingles of each document."""
    starts, ends, first = words.split(buf, offsets)
    h = words.hashes(buf, starts, ends)
    start, s = words.windows(h, first, width)
    doc = document_of(first, start)
    n = np.diff(first)
    few = np.flatnonzero((n > 0) & (n < width))
    s = np.concatenate((s, words.spans(h, first[few], first[few + 1])))
    doc = np.concatenate((doc, few))
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    s, doc = s[new], doc[new]
    return s, np.searchsorted(doc, np.arange(len(n) + 1))


def _sign(width: int):
    def run(batches):
        words = Words(lower=True)
        for part, buf, offsets in slices(batches):
            s, bounds = _shingles(words, buf, offsets, width)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            signature = np.zeros((part.num_rows, COORDINATES), np.uint32)
            mark = np.zeros(part.num_rows, np.uint64)
            if len(some):
                at = bounds[:-1][some]
                mark[some] = mix64(np.add.reduceat(mix64(s), at) + size[some].astype(np.uint64))
                for k, seed in enumerate(_SEEDS):
                    signature[some, k] = np.minimum.reduceat((s * seed) >> np.uint64(32), at).astype(np.uint32)
            raw = signature.tobytes()
            step = 4 * COORDINATES
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(size.astype(np.int64)), pa.array(mark.view(np.int64)),
                 pa.array([raw[i:i + step] for i in range(0, len(raw), step)], pa.binary())],
                ["doc_id", "row_key", "n_shingles", "node", "signature"])

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _child(path, coordinate, signature):
    """Path keys after the minwise token of a coordinate per row."""
    token = signature[np.arange(len(path)), coordinate].astype(np.uint64)
    return mix64(path * np.uint64(3) + mix64((token << np.uint64(8)) + coordinate.astype(np.uint64) + np.uint64(1)))


def _roots(trees: int):
    def run(batches):
        for batch in batches:
            signature, node = _matrix(batch.column(1)), np.asarray(batch.column(0))
            for tree in range(trees):
                path = np.full(len(node), mix64(np.uint64([tree + 1]))[0])
                key = _child(path, np.full(len(node), tree % COORDINATES), signature)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), batch.column(0)],
                                                 ["key", "node", "part"])

    return run


def _branch(batches):
    """Two children per row, by coordinates that the path selects."""
    for batch in batches:
        key, signature = np.asarray(batch.column(0)).view(np.uint64), _matrix(batch.column(3))
        one = mix64(key + np.uint64(7)) % np.uint64(COORDINATES)
        step = np.uint64(1) + mix64(key + np.uint64(11)) % np.uint64(COORDINATES - 1)
        for c in (one, (one + step) % np.uint64(COORDINATES)):
            child = _child(key, c.astype(np.int64), signature)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column(1), batch.column(2)],
                                             ["key", "node", "part"])


def _whole_groups(batches, least: int = 4096):
    """Tables that hold whole groups of rows with an equal first column (rows come sorted)."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = table.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _look_alikes(batches):
    """Per leaf, the classes joined by signatures that agree in enough places."""
    for table in _whole_groups(batches):
        key, node, part = (table.column(i).to_numpy() for i in range(3))
        signature = _matrix(table.column(3))
        row = np.arange(len(key))
        label, used = row.copy(), np.zeros(len(key), bool)
        end = np.searchsorted(key, key, "right")
        for d in range(1, int((end - row).max())):
            i = np.flatnonzero(row + d < end)
            i = i[(part[i] != part[i + d]) & (node[i] != node[i + d])]
            i = i[(signature[i] == signature[i + d]).sum(axis=1) >= ALIKE]
            used[i] = used[i + d] = True
            i = i[label[i] != label[i + d]]
            while len(i):  # unite the labels of each pair
                a, b = label[i], label[i + d]
                to = row.copy()
                np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
                while (to[to] != to).any():
                    to = to[to]
                label = to[label]
                i = i[label[i] != label[i + d]]
        used = np.flatnonzero(used)
        order = used[np.lexsort((node[used], label[used]))]
        if not len(order):
            continue
        cut = np.flatnonzero(np.diff(label[order], prepend=-1))
        nodes = node[order]
        lists = [np.unique(nodes[s:e]).tolist() for s, e in zip(cut, [*cut[1:], len(order)])]
        yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], ["nodes"])


def _sets(width: int):
    def run(batches):
        words = Words(lower=True)
        for part, buf, offsets in slices(batches):
            s, bounds = _shingles(words, buf, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                ["node", "shingles"])

    return run


def _confirm(percent: int):
    """Spanning links of each leaf, confirmed on full sets."""

    def linked(x, y):
        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return False
        both = np.concatenate((x, y))
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(x) + len(y) - common)

    def run(batches):
        for table in _whole_groups(batches, least=64):
            key, node = table.column(0).to_numpy(), table.column(1).to_numpy()
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            links = []
            for s, e in zip(cut, [*cut[1:], len(key)]):
                sets = [np.frombuffer(x, np.uint64) for x in table.column(2).slice(s, e - s).to_pylist()]
                groups: list[list[int]] = []  # members linked so far
                for i, x in enumerate(sets):
                    mine, rest = [i], []
                    for group in groups:
                        j = next((j for j in group if linked(x, sets[j])), None)
                        if j is None:
                            rest.append(group)
                        else:
                            links.append((int(node[s + i]), int(node[s + j])))
                            mine = group + mine
                    groups = [*rest, mine]
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _leaves(classes: DataFrame, trees: int) -> list[DataFrame]:
    """Staged ``(key, node, part)`` rows of all leaves, at most about LEAF rows a key."""
    out = []
    rows = classes.select("node", "signature").mapInArrow(_roots(trees), "key long, node long, part long")
    for depth in range(1, DEPTH + 1):
        rows = staged(rows, f"op3-level{depth}")
        sizes = (rows.groupBy("key").agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"),
                                         F.min("node").alias("pivot")).filter("lo <> hi").select("key", "n", "pivot"))
        level = staged(rows.join(sizes, "key"), f"op3-nodes{depth}")
        release(rows)
        out.append(level.filter(F.col("n") <= LEAF).select("key", "node", "part"))
        large = level.filter(F.col("n") > LEAF)
        if depth >= DENSE_FROM:
            out.append(large.filter(F.col("n") <= DENSE).select("key", "node", "part"))
            large = large.filter(F.col("n") > DENSE)
        if large.isEmpty():
            return out
        if depth == DEPTH:
            blocks = F.ceil(F.col("n") / (DENSE // 2))
            mine = F.pmod(F.xxhash64("node", "key"), blocks)
            pairs = large.select("key", "node", "part", mine.alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("y"))
            out.append(pairs.select(F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("key"), "node", "part"))
            return out
        pivots = large.groupBy("key").agg(F.first("pivot").alias("node")).join(classes.select("node", "signature"), "node")
        pivots = staged(pivots.select("key", F.col("node").alias("p_node"), F.col("signature").alias("p_signature")), f"op3-pivots{depth}")
        seen = large.join(classes.select("node", "signature"), "node").join(
            checked_broadcast(pivots, F.lit(4 * COORDINATES)), "key")
        seen = seen.select("key", "node", "part", "signature", "n", "p_node", "p_signature").mapInArrow(
            _against_pivot, "key long, node long, part long, signature binary, n long, p_node long, alike boolean")
        seen = staged(seen, f"op3-large{depth}")
        # leaves of a pivot and some of its look-alikes
        near = seen.filter("alike and node <> p_node")
        block = F.xxhash64("key", F.lit("pivot"), F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / (LEAF // 2))))
        mates = near.select(block.alias("key"), "node", F.col("node").alias("part"), "p_node")
        out.append(staged(mates.select("key", "node", "part").union(
            mates.groupBy("key").agg(F.first("p_node").alias("node")).select("key", "node", F.col("node").alias("part"))), f"op3-mates{depth}"))
        part = F.when(F.col("alike"), F.col("p_node")).otherwise(F.col("part"))
        rows = seen.select("key", "node", part.alias("part"), "signature").mapInArrow(_branch, "key long, node long, part long")
    return out


def _against_pivot(batches):
    """Whether a row's signature is nearly that of its node's pivot."""
    for batch in batches:
        same = (_matrix(batch.column(3)) == _matrix(batch.column(6))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(same >= COORDINATES * 13 // 16)],
                                         ["key", "node", "part", "signature", "n", "p_node", "alike"])


def components(links: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable over ``(a, b)`` links."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "op3-edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v")).distinct()
        edges = staged(small, "op3-stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """Per document: ``doc_id, row_key, n_shingles, component_id, kept``."""
    rows = keyed(docs)
    signed = staged(rows.select("doc_id", "text", "row_key").mapInArrow(
        _sign(width), "doc_id long, row_key long, n_shingles long, node long, signature binary"), "op3-signed")
    classes = staged(signed.filter("n_shingles > 0 and doc_id is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "row_key", "signature")).alias("f"), F.count("*").alias("copies"))
        .select("node", "copies", "f.*"), "op3-classes")
    leaves = _leaves(classes, trees)
    every = leaves[0]
    for leaf in leaves[1:]:
        every = every.union(leaf)
    every = every.join(classes.select("node", "signature"), "node").select("key", "node", "part", "signature")
    alike = every.repartition("key").sortWithinPartitions("key").mapInArrow(_look_alikes, "nodes array<long>").distinct()
    alike = staged(alike.select(F.xxhash64("nodes").alias("key"), F.explode("nodes").alias("node")), "op3-alike")
    wanted = staged(alike.select("node").distinct().join(classes, "node").select("node", "doc_id", "row_key"), "op3-wanted")
    texts = by_key(rows, checked_broadcast(wanted), "inner").select("node", "text")
    sets = staged(texts.mapInArrow(_sets(width), "node long, shingles binary").dropDuplicates(["node"]), "op3-sets")
    met = alike.join(sets, "node").select("key", "node", "shingles").repartition("key").sortWithinPartitions("key")
    found = components(met.mapInArrow(_confirm(percent), "a long, b long"))
    # components by their smallest document
    grouped = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("members"))
    several = staged(grouped.select("node", "component").join(least.filter("members > 1"), "component").select("node", "component_id"),
                     "op3-components")
    named = signed.drop("signature").join(checked_broadcast(several), "node", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "row_key", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_key")
