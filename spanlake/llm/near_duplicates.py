"""N-gram Jaccard join by a forest of prefix tries of MinHash signatures, with exact verification.

Texts are sets of five-word shingles.  Each tree of the forest sorts the texts by a label of ``DEPTH``
signature values.  A text asks each tree for the texts that share a prefix of its label, beginning with the
whole label.  The prefix is shortened until the least similar partner that a text of so many shingles can
have is met in some tree with the target recall, and no further than the last step that brings new texts:
so lengths differ between texts, and between the trees of one text.  Texts below an asked prefix are
compared exactly.  A prefix's texts go to one task, or if they are many or long, in blocks to one task for
each pair of blocks; only counts of links and a spanning star per connected set leave the task, never
pairs.  A pair that meets in several trees counts in the first; a prefix whose texts all meet in one
earlier tree is skipped.

Where links need not be counted (``keep_one``) blocks are first compared with themselves and one text of
their prefix; then only texts outside a prefix's largest connected set are compared with all others.

Words are runs of letters and digits in lower case; a text of one to four words is one shingle.
Equal texts are one class member and are compared once.  NULL is the empty text; texts without words
are linked to nothing but equal texts.  Of repeated rows each gets its result.  An empty table gives
an empty one.  Only id and text are read; working columns are not visible.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import sorted_groups, written
from spanlake.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.999

STEP = 2
"""Bytes of a label for each signature value."""

BLOCK = 512
"""Texts below a prefix that are compared in one task with themselves or another block."""

BLOCK_BYTES = 16 << 20
"""Bytes of shingles of such a block."""

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 400_000
CACHE_LENGTH = 64
"""Longer words are hashed each time they occur."""


def prefix_length(
    similarity: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL
) -> int:
    """Longest prefix on which a pair of this similarity meets with the target recall."""
    for length in range(depth, 0, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    return 1


def least_similarity(size: int, threshold: float = THRESHOLD) -> float:
    """Smallest similarity at the threshold or above that a set of this size can have to another.

    With ``c`` common members the union has at most ``c / threshold`` of them, rounded down.
    """
    if size > 64:
        return threshold
    common = range(max(math.ceil(threshold * size - 1e-9), 1), size + 1)
    return min((c / math.floor(c / threshold + 1e-9) for c in common), default=1.0)


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, width: int = SHINGLE):
        self.width = width
        self.words: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        hashes = list(map(known.get, words))
        if None in hashes:
            if len(known) >= CACHE_WORDS:
                known.clear()
            for i, h in enumerate(hashes):
                if h is None:
                    hashes[i] = h = xxhash.xxh3_64_intdigest(words[i])
                    if len(words[i]) <= CACHE_LENGTH:
                        known[words[i]] = h
        h = np.array(hashes, np.uint64)
        count = max(len(h) - self.width + 1, 1)
        made = np.full(count, len(h[: self.width]), np.uint64)
        for i in range(min(self.width, len(h))):
            made = (made ^ h[i : i + count]) * MIX
            made ^= made >> np.uint64(29)
        return np.unique(made)


def signature_seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    draw = lambda: random.integers(0, 1 << 63, count, dtype=np.uint64)
    return draw() * np.uint64(2) + np.uint64(1), draw()


def labels(shingles: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], depth: int) -> list[bytes]:
    """The text's label in each tree: ``depth`` signature values of ``STEP`` bytes."""
    a, b = seeds
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        part = shingles[i : i + 1024]
        least = np.minimum(least, (a[:, None] * part[None, :] + b[:, None]).min(axis=1))
    raw = ((least * MIX) >> np.uint64(64 - 8 * STEP)).astype(">u2").tobytes()
    width = depth * STEP
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def text_key(text: str | Column) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def distinct_texts(
    docs: DataFrame,
    doc_id: str,
    text: str,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """Each different text; a written table.

    ``key``, ``rep`` (smallest id), ``labels`` (one for each tree), ``size`` (shingles) and ``least``, the
    length to which its prefixes may have to be shortened for the recall.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seeds = Shingler(), signature_seeds(trees * depth)

        @lru_cache(1 << 10)
        def least(size: int) -> int:
            return prefix_length(least_similarity(size, threshold), trees, depth, recall)

        for batch in batches:
            found, sizes, lengths = [], [], []
            for t in batch.column("text").to_pylist():
                shingles = shingler(t or "")
                found.append(labels(shingles, seeds, depth) if len(shingles) else None)
                sizes.append(len(shingles))
                lengths.append(least(min(len(shingles), 65)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("key"),
                    pa.array(found, pa.list_(pa.binary())),
                    pa.array(sizes, pa.int64()),
                    pa.array(lengths, pa.int32()),
                ],
                ["id", "key", "labels", "size", "least"],
            )

    rows = docs.select(F.col(doc_id).alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    signed = rows.mapInArrow(
        sign, f"id {kind}, key binary, labels array<binary>, size bigint, least int"
    )
    firsts = [F.first(c).alias(c) for c in ("labels", "size", "least")]
    return written(signed.groupBy("key").agg(F.min("id").alias("rep"), *firsts), "texts")


def node(length: str | int) -> Column:
    """The trie node of a tree's label at a prefix length."""
    length = F.col(length) if isinstance(length, str) else F.lit(length)
    return F.xxhash64("tree", length, F.substring("label", F.lit(1), length * STEP))


def paths(texts: DataFrame, shortest: int, depth: int) -> DataFrame:
    """The nodes of each text and tree from the shortest prefix to the whole label, with their texts.

    ``key``, ``tree``, ``least``, ``length``, ``node``, ``n`` (texts below) and ``bytes`` (of their shingles).  Trees in
    which a text is alone at the shortest prefix are left out before the longer ones are counted.
    """
    placed = texts.select("key", "size", "least", F.posexplode("labels").alias("tree", "label"))
    shared = placed.groupBy(node(shortest).alias("top")).agg(F.count("*").alias("n")).where("n > 1")
    met = written(
        placed.withColumn("top", node(shortest)).join(shared.select("top"), "top").drop("top"), "met"
    )
    steps = met.withColumn("length", F.explode(F.sequence(F.lit(shortest), F.lit(depth)))).select(
        "key", "tree", "least", "size", "length", node("length").alias("node")
    )
    below = steps.groupBy("node").agg(F.count("*").alias("n"), (F.sum("size") * 8).alias("bytes"))
    return written(steps.drop("size").join(below.where("n > 1"), "node"), "paths")


def matched(paths: DataFrame) -> DataFrame:
    """What each text asks each tree for: ``key``, ``tree``, ``length`` and ``node``.

    Beginning with the whole label the prefix is shortened down to ``least``, and no further than the
    last step that brings new texts: the longest of the prefixes with most texts below.
    """
    return (
        paths.where("length >= least")
        .groupBy("key", "tree")
        .agg(F.max(F.struct("n", "length", "node")).alias("best"))
        .select("key", "tree", "best.length", "best.node")
    )


def meetings(texts: DataFrame, shortest: int, depth: int, block: int, block_bytes: int) -> DataFrame:
    """Each text with the asked nodes it lies below: ``key``, ``at`` (tree, node, n, blocks).

    Of asked nodes below one another in a tree the highest is kept, which holds the pairs of the others.
    """
    steps = paths(texts, shortest, depth)
    asked = matched(steps).select("node").distinct()
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / block_bytes)).cast("int")
    highest = (
        steps.join(asked, "node")
        .groupBy("key", "tree")
        .agg(F.min(F.struct("length", "node", "n", blocks.alias("blocks"))).alias("top"))
        .select("key", F.struct("tree", "top.node", "top.n", "top.blocks").alias("at"))
    )
    return written(highest.groupBy("key").agg(F.sort_array(F.collect_list("at")).alias("at")), "company")


def members(company: DataFrame) -> DataFrame:
    """Texts of the nodes to compare: ``key``, ``node``, ``n``, ``blocks``, and ``mine``, dealt out by hash."""
    # All texts of a node meet in an earlier one if as many have both as have the node.
    earlier = (
        company.select(F.posexplode("at").alias("i", "own"), "at")
        .select("own.node", "own.n", F.explode(F.slice("at", F.lit(1), F.col("i"))).alias("other"))
        .groupBy("node", F.col("other.node").alias("other"))
        .agg(F.count("*").alias("both"), F.first("n").alias("n"))
        .where("both = n")
        .select("node")
        .distinct()
    )
    return (
        company.select("key", F.explode("at").alias("own"))
        .select("key", "own.node", "own.n", "own.blocks")
        .join(earlier, "node", "left_anti")
        .withColumn("mine", F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int"))
    )


def units(members: DataFrame, pairs: str) -> DataFrame:
    """Per text its ``units``: a node, the text's block and the pairs of blocks that it takes part in."""
    unit = F.struct("node", "mine", F.expr(pairs).alias("pairs"))
    return members.groupBy("key").agg(F.collect_list(unit.alias("unit")).alias("units"))


ALL_PAIRS = """transform(sequence(0, blocks - 1),
    o -> struct(least(mine, o) AS low, greatest(mine, o) AS high))"""
OWN_BLOCK = """CASE WHEN center THEN transform(sequence(0, blocks - 1), o -> struct(o AS low, o AS high))
    ELSE array(struct(mine AS low, mine AS high)) END"""
WITH_REST = """transform(sequence(if(rest, 0, main), main + others - 1),
    o -> struct(least(mine, o) AS low, greatest(mine, o) AS high))"""


UNIT_SCHEMA = """node bigint, low int, high int, mine int, key binary, nodes array<bigint>,
shingles binary"""


def to_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each unit of a text, with its shingles."""
    shingler = Shingler()
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
    names = ["node", "low", "high", "mine", "key", "nodes", "shingles"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    rows, size = [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "text", "units", "nodes"))
        for key, text, units, own in zip(*columns):
            raw = shingler(text or "").tobytes()
            for unit in units:
                mine = unit["mine"]
                for low, high in ((p["low"], p["high"]) for p in unit["pairs"]):
                    rows.append((unit["node"], low, high, mine, key, own, raw))
                    size += len(raw) + 200
                    if size > 1 << 23:
                        yield made(rows)
                        rows, size = [], 0
    if rows:
        yield made(rows)


def linked_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Matrix of which sets have a Jaccard similarity of the threshold or more."""
    sizes = np.array([len(s) for s in sets], np.float64)
    count = len(sets)
    if count <= 4:
        common = np.zeros((count, count))
        for i in range(count):
            for j in range(i):
                common[i, j] = common[j, i] = len(
                    np.intersect1d(sets[i], sets[j], assume_unique=True)
                )
    else:
        owner = np.repeat(np.arange(count), sizes.astype(np.int64))
        _, number, times = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        frequent = np.flatnonzero(times > 1)
        column = np.full(len(times), -1)
        column[frequent] = np.arange(len(frequent))
        at = column[number]
        owner, at = owner[at >= 0], at[at >= 0]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        common = np.zeros((count, count))
        for begin in range(0, len(frequent), 4096):
            a, b = np.searchsorted(at, (begin, begin + 4096))
            part = np.zeros((count, 4096), np.float32)
            part[owner[a:b], at[a:b] - begin] = 1
            common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = (common >= threshold * union - 1e-9) & (union > 0)
    np.fill_diagonal(linked, False)
    return linked


def share_any(lists: list[list[int]]) -> np.ndarray:
    """Matrix of which lists have an entry in common."""
    count = len(lists)
    shared = np.zeros((count, count), bool)
    _, number = np.unique(
        np.array([v for own in lists for v in own], np.int64), return_inverse=True
    )
    owner = np.repeat(np.arange(count), [len(own) for own in lists])
    for begin in range(0, number.max(initial=-1) + 1, 4096):
        here = (number >= begin) & (number < begin + 4096)
        part = np.zeros((count, 4096), np.float32)
        part[owner[here], number[here] - begin] = 1
        shared |= part @ part.T > 0
    return shared


def stars(linked: np.ndarray) -> np.ndarray:
    """For each member the first member of its connected set."""
    root = np.arange(len(linked))
    for i in range(len(linked)):
        if root[i] != i:
            continue
        todo = [i]
        while todo:
            near = np.flatnonzero(linked[todo].any(axis=0) & (root > i))
            root[near] = i
            todo = near.tolist()
    return root


def compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the texts in each unit: ``key``, ``root`` of its connected set, ``links``."""
    for _, unit in sorted_groups(
        (b.append_column("unit", _unit(b)) for b in batches), "unit"
    ):
        keys = unit.column("key").to_pylist()
        first = list({k: i for i, k in reversed(list(enumerate(keys)))}.values())
        if len(first) < 2:
            continue
        first.sort(key=lambda i: keys[i])
        rows = unit.take(pa.array(first, pa.int64()))
        keys = rows.column("key").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        linked = linked_pairs(sets, threshold)
        if not linked.any():
            continue
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        if low != high:
            side = np.array(rows.column("mine").to_pylist())
            linked &= side[:, None] != side[None, :]
        node, own = rows.column("node")[0].as_py(), rows.column("nodes").to_pylist()
        counted = linked
        if own[0] is not None:
            counted = linked & ~share_any([n[: n.index(node)] for n in own])
        links, root = counted.sum(axis=1), stars(linked)
        found = np.flatnonzero(linked.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[i] for i in found], pa.binary()),
                pa.array([keys[root[i]] for i in found], pa.binary()),
                pa.array(links[found], pa.int64()),
            ],
            ["key", "root", "links"],
        )


def _unit(batch: pa.RecordBatch) -> pa.Array:
    columns = (batch.column(c).to_pylist() for c in ("node", "low", "high"))
    return pa.array([f"{n}/{a}/{b}" for n, a, b in zip(*columns)], pa.string())


def compared(
    docs: DataFrame, doc_id: str, text: str, texts: DataFrame, wanted: DataFrame, threshold: float
) -> DataFrame:
    """Links found in the ``units`` of the texts (``key``, ``units``, ``nodes``); a written table."""
    wanted = texts.select("key", "rep").join(wanted, "key").withColumnRenamed("key", "k")
    rows = docs.select(F.col(doc_id).alias("id"), text_key(text).alias("key"), F.col(text).alias("text"))
    # Joined by id as well, the rows of a text with many copies are spread over the tasks.
    sources = rows.join(
        wanted, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("rep"))
    ).select("key", "text", "units", "nodes")
    return written(
        sources.mapInArrow(to_units, UNIT_SCHEMA)
        .repartition("node", "low", "high")
        .sortWithinPartitions("node", "low", "high")
        .mapInArrow(partial(compare, threshold=threshold), "key binary, root binary, links bigint"),
        "links",
    )


def spanning(company: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links that connect what all links would, found without comparing all blocks.

    ``find`` compares the texts of a table of units.
    """
    placed = written(members(company), "members")
    centers = placed.where("blocks > 1").groupBy("node").agg(F.min("key").alias("c"))
    first = placed.join(centers, "node", "left").withColumn("center", F.expr("key <=> c"))
    found = find(units(first, OWN_BLOCK).withColumn("nodes", F.lit(None).cast("array<bigint>")))
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return found
    roots = components(found, "key", "root").withColumnRenamed("node", "key")
    parts = written(
        large.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "parts"
    )
    sets = parts.groupBy("node", "root").agg(F.count("*").alias("n"))
    most = sets.groupBy("node").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n")
    )
    # Blocks keep their average bytes: as many for the largest set and the rest as their texts have a share.
    share = lambda n: F.ceil(F.col("blocks") * n / F.col("n")).cast("int")
    dealt = (
        parts.drop("n")
        .join(most.where("most.n < n"), "node")
        .withColumn("rest", F.col("root") != F.col("most.root"))
        .withColumn("main", share(F.col("most.n")))
        .withColumn("others", share(F.col("n") - F.col("most.n")))
        .withColumn("hash", F.xxhash64("key", F.lit(1)))
        .withColumn("mine", F.expr("int(if(rest, main + pmod(hash, others), pmod(hash, main)))"))
    )
    again = find(units(dealt, WITH_REST).withColumn("nodes", F.lit(None).cast("array<bigint>")))
    return found.union(again)


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
    block_bytes: int = BLOCK_BYTES,
    count_links: bool = True,
) -> DataFrame:
    """Each different text with its class: ``key``, ``rep``, ``root_key``, ``root_rep``, ``links``.

    ``rep`` is the smallest id of the text, ``root_key`` and ``root_rep`` those of the class's text
    of smallest id, ``links`` the number of other texts at the threshold or above (NULL if they are not to
    be counted).
    """
    texts = distinct_texts(docs, doc_id, text, threshold, trees, depth, recall)
    shortest = prefix_length(threshold, trees, depth, recall)
    company = meetings(texts, shortest, depth, block, block_bytes)
    find = partial(compared, docs, doc_id, text, texts, threshold=threshold)
    if count_links:
        own = company.select("key", F.col("at.node").alias("nodes"))
        found = find(units(members(company), ALL_PAIRS).join(own, "key"))
        counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    else:
        found = spanning(company, find)
        counts = None
    roots = components(found, "key", "root").withColumnRenamed("node", "key")
    joined = texts.select("key", "rep").join(roots, "key", "left")
    if count_links:
        joined = joined.join(counts, "key", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    else:
        joined = joined.withColumn("links", F.lit(None).cast("bigint"))
    joined = written(
        joined.select("key", "rep", F.coalesce("root", "key").alias("root"), "links"), "classes"
    )
    # Texts without id come last.
    first = F.min(F.struct(F.col("rep").isNull().alias("late"), "rep", "key"))
    tops = joined.groupBy("root").agg(first.alias("top"))
    return joined.join(tops, "root").select(
        "key", "rep", F.col("top.key").alias("root_key"), F.col("top.rep").alias("root_rep"), "links"
    )


def join_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``text_id`` and ``n_links``.

    ``class_id`` is the smallest id of the connected texts, ``text_id`` that of the equal ones, and
    ``n_links`` counts the other texts at the threshold or above.
    """
    found = classes(docs, doc_id, text, **how)
    return (
        docs.select(F.col(doc_id).alias("id"), text_key(text).alias("key"))
        .join(found, "key")
        .selectExpr(f"id AS `{doc_id}`", "root_rep AS class_id", "rep AS text_id", "links AS n_links")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One document of each class with its columns as they are: the one of smallest id.

    Of rows that repeat this id and text, the one whose columns have the smallest hash stays.
    """
    found = classes(docs, doc_id, text, count_links=False, **how)
    tops = found.where("key = root_key").select(F.col("key").alias("k"), "rep")
    names = docs.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    rows = docs.select(row.alias("row"), F.col(doc_id).alias("id"), text_key(text).alias("key"))
    kept = rows.join(tops, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("rep")))
    ranked = kept.withColumn(
        "n",
        F.expr("row_number() OVER (PARTITION BY key, id ORDER BY xxhash64(to_json(row)))"),
    )
    return ranked.where("n = 1").select("row.*")
