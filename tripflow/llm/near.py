"""N-gram Jaccard self-join of texts: a MinHash LSH forest proposes, exact set comparison decides."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import slices, sparing, tokens
from .common import checkpointed, fresh, table
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
MAX_DEPTH = 8
TARGET_RECALL = 0.999
# Texts are compared in blocks of about so many shingles and texts; a larger group is cut into several. Memory
# grows with the square of the texts, so short ones need the second bound.
BLOCK_SHINGLES = 100_000
BLOCK_TEXTS = 800
_BASE = 0x9E3779B97F4A7C15


def forest_depth(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """How many values a matched prefix must have: shortened from ``max_depth`` until a pair just at the
    threshold shares a prefix in some tree with the target probability. Closer pairs do so more surely."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's word shingles; all words as one for shorter texts."""
    n = len(texts)
    words, rows = tokens(pc.ascii_split_whitespace(texts))
    coded = words.dictionary_encode()
    by_code = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    hashed = by_code.astype(np.uint64)[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)
    bounds = np.searchsorted(rows, np.arange(n + 1))
    rolled = np.zeros(max(0, len(hashed) - width + 1), np.uint64)
    for i in range(width):
        rolled = rolled * np.uint64(_BASE) + hashed[i : i + len(rolled)]
    rolled ^= rolled >> np.uint64(31)
    rolled *= np.uint64(_BASE)
    out = []
    for start, stop in zip(bounds[:-1], bounds[1:]):
        if stop - start >= width:
            out.append(np.unique(rolled[start : stop - width + 1]))
        else:
            whole = np.full(min(1, stop - start), stop - start, np.uint64)
            for h in hashed[start:stop]:
                whole = whole * np.uint64(_BASE) + h
            out.append(whole)
    return out


def forest_labels(sets: list[np.ndarray], trees: int, depth: int, seed: int = 3) -> np.ndarray:
    """For each set and tree, a hash of the first ``depth`` values of the tree's MinHash signature."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, (trees, depth), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    addends = rng.integers(0, 2**63, (trees, depth), dtype=np.int64).astype(np.uint64)
    sizes = np.array([len(s) for s in sets])
    labels = np.zeros((len(sets), trees), np.uint64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return labels
    joined = np.concatenate([sets[i] for i in filled])
    starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
    for tree in range(trees):
        label = np.full(len(filled), np.uint64(tree + 1))
        for factor, addend in zip(factors[tree], addends[tree]):
            mixed = joined * factor
            mixed ^= mixed >> np.uint64(32)
            mixed *= addend | np.uint64(1)
            label = label * np.uint64(_BASE) + np.minimum.reduceat(mixed, starts)
            label ^= label >> np.uint64(29)
        labels[filled, tree] = label
    return labels


def signatures(docs: DataFrame, width: int, trees: int, depth: int) -> DataFrame:
    """``doc_id, text_hash, node, size, labels``: the node is a 64-bit digest of the text's shingle set, so
    texts with the same set are one node. Null and empty texts have no node."""

    @sparing
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            nodes, sizes, labels = [], [], [np.zeros((0, trees), np.uint64)]
            for _, texts in slices(batch):
                sets = shingle_sets(texts, width)
                for s in sets:
                    digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                    nodes.append(int.from_bytes(digest, "little", signed=True) if len(s) else None)
                sizes += [len(s) for s in sets]
                labels.append(forest_labels(sets, trees, depth))
            flat = pa.array(np.concatenate(labels).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * trees), flat)
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists]
            yield pa.StructArray.from_arrays(columns, ["node", "size", "labels"])

    signed = F.arrow_udf(sign, "struct<node: long, size: long, labels: array<long>>")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), signed("text").alias("s"))
    return keyed.select("doc_id", "text_hash", "s.*")


def candidate_groups(signed: DataFrame) -> DataFrame:
    """``node, root``: nodes connected through shared prefixes. Nodes that share none are left out."""
    prefixes = signed.where("node is not null").select("node", F.explode("labels").alias("label"))
    ends = prefixes.groupBy("label").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    # Stored, so that the join is shuffled on both sides and Spark can split a prefix that most texts share.
    buckets = checkpointed(ends.where("least < most").drop("most"))
    return components(prefixes.join(buckets, "label").select(F.col("node").alias("u"), F.col("least").alias("v")))


def _compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which sets of ``left`` (rows) have at least ``threshold`` Jaccard similarity to which of ``right``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    codes, _ = pd.factorize(np.concatenate(sets))
    shared = np.bincount(codes) > 1
    renumbered = np.cumsum(shared) - 1
    kept = shared[codes]
    owners, codes = owners[kept], renumbered[codes[kept]]
    order = np.argsort(codes, kind="stable")
    owners, codes = owners[order], codes[order]
    common = np.zeros((len(left), len(right)), np.float32)
    n_shared = int(shared.sum())
    step = min(n_shared, max(64, (1 << 22) // len(sets)))
    for low in range(0, n_shared, step or 1):
        a, b = np.searchsorted(codes, [low, low + step])
        block = np.zeros((len(sets), step), np.float32)
        block[owners[a:b], codes[a:b] - low] = 1.0
        common += block[left] @ block[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * union - 1e-6


def _spanning(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each one is connected to."""
    label = np.arange(len(linked))
    seen = np.zeros(len(linked), bool)
    for start in range(len(linked)):
        if seen[start]:
            continue
        seen[start] = True
        front = [start]
        while front:
            reached = linked[front].any(axis=0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached).tolist()
            label[front] = start
    return label


def verified_links(docs: DataFrame, signed: DataFrame, groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """``node, peer, links`` for each node and block: a node it is linked with directly or through others
    of the block, and the number of documents of the block that it is linked with.

    All texts of a group are compared with each other, not only those that shared a prefix. A group of more
    than ``BLOCK_SHINGLES`` shingles or ``BLOCK_TEXTS`` texts is cut into parts, and every two parts meet in a block of their own, so
    that no task holds a whole large group. What a block gives back has one row per text, not per pair.
    """
    named = signed.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("text_hash").alias("rep_hash"),
        F.min_by("doc_id", "text_hash").alias("rep_id"),
        F.max("size").alias("size"),
    )
    members = checkpointed(groups.join(named, "node"))
    cuts = F.greatest(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS))
    cuts = members.groupBy("root").agg(cuts.cast("int").alias("cuts"))
    members = members.join(checkpointed(cuts), "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    with_text = texts.join(
        members, texts["doc_id"].eqNullSafe(members["rep_id"]) & (texts["text_hash"] == members["rep_hash"])
    )
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    blocks = (
        with_text.select("root", "part", "node", "copies", "text", other.alias("other"))
        .withColumn("first", F.least("part", "other"))
        .withColumn("second", F.greatest("part", "other"))
        .select("root", "first", "second", "part", "node", "copies", "text")
    )
    key = ["root", "first", "second"]

    def block_links(rows: list[dict]) -> pa.RecordBatch:
        rows = list({r["node"]: r for r in rows}.values())  # rows repeated in the table
        nodes, copies, part = (np.array([r[c] for r in rows]) for c in ("node", "copies", "part"))
        sets = [s for _, some in slices(pa.array([r["text"] for r in rows])) for s in shingle_sets(some, width)]
        first, second = rows[0]["first"], rows[0]["second"]
        left, right = np.flatnonzero(part == first), np.flatnonzero(part == second)
        linked = np.zeros((len(rows), len(rows)), bool)
        if len(left) and len(right):
            found = _compare(sets, left, right, threshold)
            linked[np.ix_(left, right)] = found
            linked[np.ix_(right, left)] |= found.T
        np.fill_diagonal(linked, False)
        return pa.record_batch([nodes, nodes[_spanning(linked)], linked @ copies], ["node", "peer", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (at := tuple(row[c] for c in key)) != current:
                    if rows:
                        yield block_links(rows)
                    current, rows = at, []
                rows.append(row)
        if rows:
            yield block_links(rows)

    # Comparing costs far more than its bytes suggest, so the blocks are not left to be gathered by size.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = blocks.repartition(parts, *key).sortWithinPartitions(*key)
    return laid.mapInArrow(sparing(run), "node long, peer long, links long")


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, class_root, class_id, n_links``.

    ``n_links`` counts the other documents whose sets of ``width``-word shingles (white-space separated,
    case-sensitive words) have a Jaccard similarity of ``threshold`` or more, copies included. Documents
    connected through links are a class; ``class_id`` is its smallest doc_id. Texts of fewer words are one
    shingle. Null and empty texts, with null ``class_root``, are linked with nothing and have their own
    doc_id as class. Equal rows each have a row and count as copies of each other. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    signed = checkpointed(signatures(docs, width, trees, forest_depth(threshold, trees, max_depth, target_recall)))
    groups = candidate_groups(signed)
    signed = signed.drop("labels")
    links = checkpointed(verified_links(docs, signed.where("node is not null"), groups, width, threshold))
    roots = components(links.select(F.col("node").alias("u"), F.col("peer").alias("v")))
    per_node = (
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"))
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(roots, "node", "left")
        .select("node", "copies", "least_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("class_root"))
    )
    per_node = checkpointed(per_node)
    classes = checkpointed(per_node.groupBy("class_root").agg(F.min("least_id").alias("class_id")))
    known = per_node.join(classes, "class_root").select(
        "node", "class_root", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    return signed.join(known, "node", "left").select(
        "doc_id",
        "text_hash",
        "class_root",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id; all columns pass through.

    Among rows with that id the one with the lowest text hash stays, and one of several equal rows. A
    class without any id keeps one of its rows. Null and empty texts all stay.
    """
    hashed, turn = fresh(docs, "text_hash", "turn")
    found = checkpointed(near_duplicates(docs, **options).where("class_root is not null"))
    first = checkpointed(found.groupBy("class_root").agg(F.min("doc_id").alias("keep_id")))
    keepers = (
        found.join(first, "class_root")
        .where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("class_root", "keep_id")
        .agg(F.min("text_hash").alias("keep_hash"))
        .select("keep_id", "keep_hash")
    )
    keepers = checkpointed(keepers)
    keyed = docs.withColumn(hashed, F.xxhash64("text"))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.where(~wordless).join(
        keepers, keyed["doc_id"].eqNullSafe(keepers["keep_id"]) & (keyed[hashed] == keepers["keep_hash"])
    )
    one = kept.withColumn(turn, F.row_number().over(Window.partitionBy("doc_id", hashed).orderBy(hashed))).where(F.col(turn) == 1)
    return one.select(*docs.columns).unionByName(docs.where(wordless))


def op5_ngram_jaccard(spark, sf_dir):
    """The class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
