"""Exact Jaccard join on word shingles by T-occurrence search (DivideSkip).

A document that reaches the similarity shares at least T of its n shingles. So it shares
one of any n - T + 1 of them: its rarest ones, whose short inverted lists are merged on a
heap, while the T - 1 long lists are only probed by binary search for the candidates.

Over all documents the same count prunes before any pair is looked at. In one order of
all shingles, of two linked documents that have n - T + L of their first shingles looked
up each, one shares L of them with the other. So only first shingles meet in a shuffle,
and a document with fewer than L shared ones is done. As a linked pair has L of these
lists in common, each document may leave out its L - 1 longest lists: the shortest one
that a pair shares is among the rest of both. The documents fall into clusters by
the lists that are left, and each cluster is searched in a task of its own. In a cluster
too large for a task, documents are first linked to the leads of their lists; only those
that can have a link to another component are searched further.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, blocks, byte_class, grams, lower_ascii, member, mix, ranges, released, span_hashes, spans, text_buffer
from tidemark.llm.components import connected_components
from tidemark.llm.tables import cut, row_key, table

WORDS = 5
PERCENT = 80
FREQUENT_TERMS = 100_000  # at most so many shingles (0.8 MB) are known to be frequent
FREQUENT_COUNT = 32
TASK_SUMMARY = 50_000
BLOCK = 256  # documents searched together
BROADCAST_ROWS = 200_000  # members known to every task, up to so many (about 20 MB)
STAR_ROUNDS = 2
LEADS = 3  # a document of a large cluster is first compared with so many

_IN_WORD = byte_class(lambda b: b != 32 and not 9 <= b <= 13)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of distinct shingles, ordered by both; a text of fewer words has its whole sequence as one."""
    lowered = lower_ascii(data)
    starts, ends, first = spans(lowered, offsets, _IN_WORD)
    words = span_hashes(lowered, starts, ends)
    counts = np.diff(first)
    rows, values = [], []
    for size in range(1, k + 1):
        have = np.flatnonzero(counts >= k) if size == k else np.flatnonzero(counts == size)
        if len(have):
            number = counts[have] - size + 1
            rows.append(np.repeat(have, number))
            values.append(mix(grams(words, size)[ranges(first[have], number)] + U64(size)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(value)
    narrow = row[order].astype(np.int16) if len(counts) < 1 << 15 else row[order]
    order = order[np.argsort(narrow, kind="stable")]
    row, value = row[order], value[order]
    fresh = np.append(True, (row[1:] != row[:-1]) | (value[1:] != value[:-1]))
    return row[fresh], value[fresh]


def least_overlap(x, y, percent: int = PERCENT):
    """Shared shingles from which sets of these sizes are linked: 100 * shared >= percent * union."""
    return -(-(percent * (x + y)) // (100 + percent))


def _spare(n, percent: int = PERCENT):
    """n - T for the least T of any partner: how many shingles a linked document may have for itself."""
    return n + (-(percent * n) // 100)


def shared_at_least(n, percent: int = PERCENT):
    """L: of its first n - T + L shingles a document shares so many with a linked one whose last of these comes no earlier."""
    return np.maximum(1, _spare(n, percent) // 2)


def prefix_size(n, percent: int = PERCENT):
    """n - T + L shingles are looked up."""
    return _spare(n, percent) + shared_at_least(n, percent)


def needed(n, percent: int = PERCENT):
    """Fewest shared first shingles of a document with any link: L of the smallest partner."""
    return shared_at_least(-(-(percent * n) // 100), percent)


def _prints(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    out = []
    for salt in (U64(0x51ED270B), U64(0xA0761D64)):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value + salt), dtype=U64)])
        out.append(mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(U64)).view(np.int64))
    return out[0], out[1]


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(first row, end row, offsets of sets, shingles, two hashes) by block."""
    data, offsets = text_buffer(batch.column("text"))
    for low, high, part, part_offsets in blocks(data, offsets):
        row, value = shingle_sets(part, part_offsets)
        first = np.searchsorted(row, np.arange(high - low + 1))
        yield low, high, first, value, *_prints(value, first)


def _describe(rows: DataFrame) -> DataFrame:
    """One pass: per document (doc_id, key, n_shingles, ref, ref2), and per task the shingles it saw often (token, seen)."""
    kind = rows.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), *(T.StructField(n, T.LongType()) for n in ("key", "n_shingles", "ref", "ref2", "token", "seen"))]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = np.zeros(0, U64), np.zeros(0, np.int64)
        arrow_kind = None
        for batch in batches:
            arrow_kind = batch.schema.field("doc_id").type
            for low, high, first, value, ref, ref2 in _sets_of(batch):
                n = high - low
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, n), batch.column("key").slice(low, n), pa.array(np.diff(first)), pa.array(ref), pa.array(ref2), none, none], schema.names
                )
                tokens, seen = np.unique(value, return_counts=True)
                merged, inverse = np.unique(np.concatenate([often, tokens[seen > 1], tokens[member(tokens, often) & (seen == 1)]]), return_inverse=True)
                total = np.bincount(inverse, np.concatenate([counts, seen[seen > 1], seen[member(tokens, often) & (seen == 1)]]), minlength=len(merged)).astype(np.int64)
                if len(merged) > TASK_SUMMARY:
                    keep = np.sort(np.argsort(-total, kind="stable")[:TASK_SUMMARY])
                    merged, total = merged[keep], total[keep]
                often, counts = merged, total
        keep = counts >= 4
        if keep.any():
            n = int(keep.sum())
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(n, arrow_kind), none, none, none, none, pa.array(often[keep].view(np.int64)), pa.array(counts[keep])], schema.names)

    return rows.mapInArrow(released(run), schema)


def _postings(rows: DataFrame, frequent, often: bool) -> DataFrame:
    """(token, ref) of each set's n - T + L first shingles, by hash, those known to be frequent last; only these or only the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value
        for batch in batches:
            for _, _, first, value, ref, _ in _sets_of(batch):
                sizes = np.diff(first)
                row = np.repeat(np.arange(len(sizes)), sizes)
                late = np.zeros(len(value), np.int64)
                if len(known):
                    found = member(value, known)
                    late[found] = rank[np.searchsorted(known, value[found])]
                    order = np.lexsort((late, row))  # stable: by hash where equal
                    value, late = value[order], late[order]
                once = np.zeros(len(sizes), bool)
                once[np.unique(ref, return_index=True)[1]] = True
                take = np.where(once & (sizes > 0), prefix_size(sizes), 0)
                at = ranges(first[:-1], take)
                ours = (late[at] > 0) == often
                yield pa.RecordBatch.from_arrays([pa.array(value[at[ours]].view(np.int64)), pa.array(np.repeat(ref, take)[ours])], ["token", "ref"])

    return rows.mapInArrow(released(run), "token long, ref long")


class Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def merge_counts(lists: list[np.ndarray]) -> dict[int, int]:
    """How many of the ordered lists hold each document, by a merge on a heap."""
    counts: dict[int, int] = {}
    if len(lists) == 1:
        return dict.fromkeys(lists[0].tolist(), 1)
    for document in heapq.merge(*(x.tolist() for x in lists)):
        counts[document] = counts.get(document, 0) + 1
    return counts


def divide_skip(sets: list[np.ndarray], queries: list[np.ndarray] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (query, set) that join the components of all links; without ``queries`` the sets search each other.

    Every query is searched; a candidate already in its component needs no check. Sets
    and queries are sorted arrays of distinct shingles.
    """
    own = queries is None
    asked = sets if own else queries
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, U64)
    holder = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    holder = holder[order]
    tokens, first = np.unique(flat[order], return_index=True)
    first = np.append(first, len(flat))
    forest = Forest(len(asked) if own else len(asked) + len(sets))
    links = []
    for q, query in enumerate(asked):
        if not len(query) or not len(tokens):
            continue
        at = np.minimum(np.searchsorted(tokens, query), len(tokens) - 1)
        at = at[tokens[at] == query]
        length = first[at + 1] - first[at]
        if own:
            at, length = at[length > 1], length[length > 1]
        least = -(-(percent * len(query)) // 100)
        if len(at) < least:
            continue
        by_length = at[np.argsort(length, kind="stable")]
        short, long_ = by_length[: len(by_length) - least + 1], by_length[len(by_length) - least + 1 :]
        probe = tokens[long_]
        lists = [holder[first[t] : first[t + 1]] for t in short.tolist()]
        total = sum(len(x) for x in lists)
        if total > 4096:  # the same counts from one sort, where a heap would be slow
            found, times = np.unique(np.concatenate(lists), return_counts=True)
            counts = dict(zip(found.tolist(), times.tolist()))
        else:
            counts = merge_counts(lists)
        for candidate, shared in sorted(counts.items()):
            if own and candidate >= q:
                break
            other = candidate if own else len(asked) + candidate
            need = least_overlap(len(query), len(sets[candidate]), percent)
            if shared + len(probe) < need or forest.find(q) == forest.find(other):
                continue
            there = sets[candidate]
            place = np.minimum(np.searchsorted(there, probe), len(there) - 1)
            if shared + int((there[place] == probe).sum()) >= need:
                forest.join(q, other)
                links.append((q, candidate))
    return links


LINK = "a string, b string"


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[tuple[int, str, np.ndarray]]]]:
    """Runs of rows with equal keys in batches ordered by them: (key, [(kind, node, set)])."""
    key, rows = None, []
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        kinds, nodes, sets = batch.column("kind").to_pylist(), batch.column("node").to_pylist(), batch.column("set")
        for i, name in enumerate(names):
            if name != key:
                if rows:
                    yield key, rows
                key, rows = name, []
            rows.append((kinds[i], nodes[i], np.frombuffer(sets[i].as_py(), U64)))
    if rows:
        yield key, rows


def _links_batch(links: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.string()), pa.array([y for _, y in links], pa.string())], ["a", "b"])


def _search(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links inside each group of ``keys``: of kind 0 to kind 1, or among all if there is one kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches, keys):
            named = {(kind, node): values for kind, node, values in group}  # repeated rows once
            asked = sorted((node, v) for (kind, node), v in named.items() if kind == 0)
            held = sorted((node, v) for (kind, node), v in named.items() if kind == 1)
            if asked:
                found = divide_skip([v for _, v in held], [v for _, v in asked], percent)
                yield _links_batch([(asked[q][0], held[c][0]) for q, c in found if asked[q][0] != held[c][0]])
            else:
                found = divide_skip([v for _, v in held], None, percent)
                yield _links_batch([(held[q][0], held[c][0]) for q, c in found])

    ordered = rows.select(*keys, "kind", "node", "set").repartition(*keys).sortWithinPartitions(*keys, "kind")
    return ordered.mapInArrow(released(run), LINK)


def _compare(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links of each row of kind 1 to the few documents of kind 0 of its group; only these are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads = None, {}
        for batch in batches:
            links = []
            names = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            kinds, nodes, sets = batch.column("kind").to_pylist(), batch.column("node").to_pylist(), batch.column("set")
            for i, name in enumerate(names):
                if name != key:
                    key, heads = name, {}
                values = np.frombuffer(sets[i].as_py(), U64)
                if kinds[i] == 0:
                    heads[nodes[i]] = values
                    continue
                for node, head in heads.items():
                    need = least_overlap(len(values), len(head), percent)
                    if node != nodes[i] and need <= min(len(values), len(head)):
                        if len(np.intersect1d(values, head, assume_unique=True)) >= need:
                            links.append((nodes[i], node))
            yield _links_batch(links)

    ordered = rows.select(*keys, "kind", "node", "set").repartition(*keys).sortWithinPartitions(*keys, "kind")
    return ordered.mapInArrow(released(run), LINK)


def _star_links(large: DataFrame, postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links of each document to the documents that lead most of its lists: a few checks per document."""
    sets = large.select("node", "set").join(classes.select("node", "ref"), "node")
    sets = cut(sets, "large-sets")
    held = postings.join(sets.select("ref"), "ref")
    led = held.join(cut(_lists(held), "lists"), "token").where("ref <> lead").groupBy("ref", "lead").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("ref").orderBy(F.desc("n"), "lead"))
    led = cut(led.withColumn("place", place).where(F.col("place") <= LEADS).select("ref", "lead"), "leads")
    seats = cut(led.groupBy("lead").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("int").alias("seats")), "lead-seats")
    seat = F.pmod(F.xxhash64("ref"), F.col("seats")).cast("int")
    rows = led.join(seats, "lead").select("lead", seat.alias("seat"), "ref").join(sets, "ref").select("lead", "seat", F.lit(1).alias("kind"), "node", "set")
    heads = seats.select(F.col("lead").alias("ref"), "seats").join(sets, "ref")
    heads = heads.select(F.col("ref").alias("lead"), F.explode(F.sequence(F.lit(0), F.col("seats") - 1)).alias("seat"), F.lit(0).alias("kind"), "node", "set")
    return cut(_compare(rows.union(heads), ["lead", "seat"], percent), "star-links")


def _places(large: DataFrame, links: DataFrame) -> DataFrame:
    """(cluster, size, node, component) of all documents of the clusters."""
    labels = cut(connected_components(links), "star-components")
    members = large.select("cluster", "size", F.col("node").alias("own")).join(labels, F.col("own") == F.col("node"), "left")
    return cut(members.select("cluster", "size", F.col("own").alias("node"), F.coalesce("component", "own").alias("component")), "star-places")


def _outside(placed: DataFrame) -> DataFrame:
    """(cluster, node) of all documents that are not in the largest component of their cluster."""
    sizes = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = cut(sizes.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main")), "main-components")
    return placed.join(main, "cluster").where("component <> main").select("cluster", "node")


def _large_links(large: DataFrame, postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links that join the components inside clusters of more than ``BLOCK`` documents.

    Links to the leads of their lists draw families together. What is still missing are
    links between components; a document with one shares T of all its shingles with other components. The few that do
    form clusters of their own. Of those that are large again, each document outside of
    the largest component is searched against all, in blocks.
    """
    names = classes.select("ref", "node", "n")
    same, own = W.partitionBy("token"), W.partitionBy("ref")
    whole, links, across = large, None, postings
    for _ in range(STAR_ROUNDS):
        found = _star_links(large, across, classes, percent)
        links = found if links is None else links.union(found)
        placed = _places(whole, links)
        known = cut(placed.join(names, "node").select("ref", "node", "n", F.xxhash64("component").alias("part")), "star-labels")
        all_shingles = _all_postings(large.select("node", "set").join(known.select("ref", "node", "part"), "node"))
        ends = all_shingles.select("token", "ref", F.min("part").over(same).alias("low"), F.max("part").over(same).alias("high"))
        counted = ends.where("low <> high").select("token", "ref", F.count("*").over(own).alias("shared"))
        least = F.ceil(F.col("n") * percent / F.lit(100))
        across = cut(counted.join(known.select("ref", "n"), "ref").where(F.col("shared") >= least).select("token", "ref"), "across-postings")
        left = across.select("ref").distinct().join(names.select("ref", "node"), "ref").select("node")
        large = cut(large.join(left, "node").select("cluster", "size", "node", "set"), "across-sets")
    near = across.join(cut(_lists(across), "lists"), "token").where("ref <> lead").select(F.col("ref").alias("a"), F.col("lead").alias("b"))
    groups = cut(connected_components(near).select(F.col("node").alias("member"), F.col("component").alias("cluster")), "across-clusters")
    placed = placed.drop("cluster", "size").join(names, "node").join(groups, F.col("ref") == F.col("member"))
    placed = cut(placed.select("node", "cluster", "component"), "across-members")
    counts = cut(placed.groupBy("cluster").agg(F.count("*").alias("size")), "across-sizes")
    placed = cut(placed.join(counts, "cluster"), "across-places")
    sets = cut(large.select("node", "set").join(placed, "node"), "across-members")
    links = links.union(cut(_search(sets.where(F.col("size") <= BLOCK).withColumn("kind", F.lit(1)), ["cluster"], percent), "across-links"))
    still = sets.where(F.col("size") > BLOCK)
    if still.limit(1).count():
        links = links.union(cut(_block_links(still, percent), "block-links"))
    return links


def _all_postings(rows: DataFrame) -> DataFrame:
    """(token, ref, part) of every shingle of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, held in enumerate(batch.column("set")):
                tokens = np.frombuffer(held.as_py(), np.int64)
                ref, part = (np.full(len(tokens), batch.column(c)[i].as_py(), np.int64) for c in ("ref", "part"))
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(ref), pa.array(part)], ["token", "ref", "part"])

    return rows.select("ref", "part", "set").mapInArrow(released(run), "token long, ref long, part long")


def _block_links(large: DataFrame, percent: int) -> DataFrame:
    """Links of every document outside of its cluster's largest component to all documents of the cluster, by blocks."""
    outside = cut(_outside(large.select("cluster", "node", "component")), "outside")
    left = outside.groupBy("cluster").agg(F.count("*").alias("outside"))
    left = cut(left.select("cluster", F.ceil(F.col("outside") / BLOCK).cast("int").alias("chunks")), "chunks")
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    held = large.join(left, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), F.lit(1).alias("kind"), "node", "set"
    )
    asked = large.join(outside, ["cluster", "node"]).join(left, "cluster").select(
        "cluster", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("kind"), "node", "set"
    )
    return _search(held.union(asked), ["cluster", "chunk", "part"], percent)


def jaccard_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    Links are exact, for every pair of documents, and copies are searched once: documents
    with equal sets are one. NULL, empty and blank texts have no shingles and are alone;
    texts of fewer than five words have one. Repeated rows are linked; a document that
    only NULL ids can reach has component NULL. Shingles and sets count as equal with their
    64- and 128-bit hashes.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")))
    described = cut(_describe(rows), "shingle-counts")
    known = described.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= FREQUENT_COUNT)
    top = known.orderBy(F.desc("seen"), "token").limit(FREQUENT_TERMS).collect()
    tokens = np.array([r.token for r in top], np.int64).view(U64)
    order = np.argsort(tokens)
    rank = np.array([r.seen for r in top], np.int64)[order]
    frequent = docs.sparkSession.sparkContext.broadcast((tokens[order], rank))
    whole = described.where("token is null and n_shingles > 0")
    node = F.concat(F.lower(F.lpad(F.hex("ref"), 16, "0")), F.lower(F.lpad(F.hex("ref2"), 16, "0")))
    classes = whole.groupBy("ref", "ref2").agg(F.min("key").alias("key"), F.min("doc_id").alias("least"), F.min("n_shingles").alias("n"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("node", node), "set-classes")
    texts = rows.select("text")
    found = _shared_postings(texts, frequent)
    found = cut(_drop_sparse(found, classes, percent), "dense-postings")
    near = found.join(cut(_lists(found), "lists"), "token").where("ref <> lead").select(F.col("ref").alias("a"), F.col("lead").alias("b"))
    clusters = connected_components(near)

    placed = classes.join(clusters, classes.ref == clusters.node).select("key", "ref", "ref2", "copies", classes.node, F.col("component").alias("cluster"))
    counts = cut(placed.groupBy("cluster").agg(F.count("*").alias("size")), "cluster-sizes")
    placed = cut(placed.join(counts, "cluster"), "cluster-members")
    few = placed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    members = cut(_member_sets(rows.select("key", "text").join(F.broadcast(placed) if few else placed, "key")), "member-sets")
    # a row may repeat in the table: then each task has its set once, and these become one
    again = members.where("copies > 1").groupBy("cluster", "size", "node").agg(F.min("set").alias("set"))
    members = members.where("copies = 1").select("cluster", "size", "node", "set").union(cut(again, "repeated-sets"))
    small = members.where(F.col("size") <= BLOCK).withColumn("kind", F.lit(1))
    links = cut(_search(small, ["cluster"], percent), "links")
    if members.where(F.col("size") > BLOCK).limit(1).count():
        links = links.union(_large_links(members.where(F.col("size") > BLOCK), found, classes, percent))
    parts = cut(connected_components(links), "set-components")
    rooted = classes.select("ref", "ref2", "least", F.col("node").alias("own")).join(parts, F.col("own") == F.col("node"), "left")
    rooted = cut(rooted.select("ref", "ref2", "least", F.coalesce("component", "own").alias("root")), "set-roots")
    lowest = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "lowest")
    labels = cut(rooted.join(lowest, "root").select("ref", "ref2", "component_id"), "set-labels")
    linked = described.where("token is null and n_shingles > 0").join(labels, ["ref", "ref2"])
    alone = described.where("token is null and n_shingles = 0")
    return linked.select("doc_id", "n_shingles", "component_id").union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _lists(postings: DataFrame) -> DataFrame:
    """(token, lead, length): shingles of several sets, the lowest of these, and how many postings there are."""
    ends = postings.groupBy("token").agg(F.min("ref").alias("lead"), F.max("ref").alias("last"), F.count("*").alias("length"))
    return ends.where("lead <> last").select("token", "lead", "length")


def _shared_postings(texts: DataFrame, frequent) -> DataFrame:
    """Postings (token, ref, length) whose shingle stands in several sets, with the length of its list.

    Frequent shingles, those that tasks saw again and again inside a block of text, are
    aggregated in their tasks first and joined as skewed keys. The others have about one
    posting per block at most; they meet in one shuffle and a window.
    """
    often = cut(_postings(texts, frequent, True), "frequent-postings")
    shared = often.join(cut(_lists(often).select("token", "length"), "frequent-lists"), "token")
    same = W.partitionBy("token")
    rare = _postings(texts, frequent, False).select("token", "ref", F.min("ref").over(same).alias("low"), F.max("ref").over(same).alias("high"), F.count("*").over(same).alias("length"))
    return shared.select("token", "ref", "length").union(rare.where("low <> high").select("token", "ref", "length"))


def _drop_sparse(postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(token, ref) of the sets that share enough of their first shingles to have a link, without each set's L - 1 longest lists.

    Lists are in one order, by length. Of the L or more that a linked pair shares, the
    first has L - 1 others after it in both sets, so both keep it. A set has no more
    postings than first shingles.
    """
    spare = lambda n: n - F.ceil(n * percent / F.lit(100))
    least = F.greatest(F.lit(1), F.floor(spare(F.ceil(F.col("n") * percent / F.lit(100))) / 2))
    sizes = classes.groupBy("ref").agg(F.min("n").alias("n"))
    own = W.partitionBy("ref")
    counted = postings.withColumn("shared", F.count("*").over(own)).withColumn("place", F.row_number().over(own.orderBy("length", "token")))
    return counted.join(sizes, "ref").where(F.col("place") <= F.col("shared") - least + 1).select("token", "ref")


def _member_sets(rows: DataFrame) -> DataFrame:
    """cluster, size, node, copies, set (64-bit shingles) of rows whose text has the set that is looked for; of repeated rows one per task."""
    names = ["cluster", "size", "node", "copies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            want = np.asarray(batch.column("ref")), np.asarray(batch.column("ref2"))
            copies = np.asarray(batch.column("copies"))
            for low, high, first, value, ref, ref2 in _sets_of(batch):
                good = []
                for i in np.flatnonzero((ref == want[0][low:high]) & (ref2 == want[1][low:high])).tolist():
                    if copies[low + i] > 1:
                        node = int(ref[i]), int(ref2[i])
                        if node in seen:
                            continue
                        seen.add(node)
                    good.append(i)
                sets = [value[first[i] : first[i + 1]].tobytes() for i in good]
                at = pa.array([low + i for i in good], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in names] + [pa.array(sets, pa.binary())], [*names, "set"])

    return rows.select(*names, "ref", "ref2", "text").mapInArrow(released(run), "cluster long, size long, node string, copies long, set binary")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """The same columns; of each group of linked rows one stays, and all rows without shingles.

    A row is told by its id and text, so an id that repeats with another text is judged
    by each text. The row with the smallest id stays, NULL ids after all others, of equal
    ids the one with the lowest hash; of repeated rows the one that comes first by its
    columns, which must be orderable.
    """
    names = docs.columns
    key = "__key" + "_" * max(len(c) for c in names)
    row = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), row_key(id_column, text_column).alias("key"))
    labels = jaccard_classes(docs.select(row.alias("row"), F.col(text_column).alias("text")), "row", "text", percent).where("n_shingles > 0")
    marks = labels.groupBy(F.col("doc_id.key").alias(key)).agg(F.max(F.col("doc_id.key") != F.col("component_id.key")).alias("gone"), F.count("*").alias("copies"))
    marks = cut(marks.where("gone or copies > 1").select(key, F.col("gone").alias(key + "gone")), "near-duplicates")
    sizes = marks.agg(F.count("*").alias("all"), F.count_if(~F.col(key + "gone")).alias("again")).first()
    named = docs.withColumn(key, row_key(id_column, text_column))

    def among(rows: DataFrame, size: int, how: str) -> DataFrame:
        """The documents with one of these keys, or without; a shuffle moves the texts only if the keys are too many to send."""
        keys = rows.select(key)
        return named.join(F.broadcast(keys) if size <= BROADCAST_ROWS else keys, key, how)

    once = among(marks, sizes["all"], "left_anti").select(names)
    if not sizes["again"]:
        return once
    again = among(marks.where(~F.col(key + "gone")), sizes["again"], "left_semi")
    again = again.groupBy(key).agg(F.min(F.struct(*(again[c] for c in names))).alias("row"))
    return once.union(again.select("row.*"))


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Per document: set size and component."""
    return jaccard_classes(table(spark, sf_dir, "documents"))
