"""Prefix trie of conversations: ternary search trees per range of sequences, merged at their boundary nodes.

A conversation is a sequence of turn digests. Distinct sequences are dealt out by range
and sorted. Each task builds a ternary search tree over blocks of them, and walks it for
members, leaves and savings. Only the nodes on the first and the last sequence of a
block can lie in other blocks as well; their figures are summed up by node, and what two
neighbouring blocks both counted is taken off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.tables import cut, table

BLOCK_TURNS = 200_000
TASK_TURNS = 2_000_000
CHUNK_IDS = 4096
WIDTH = 16  # bytes of a turn's digest
SHARED = 3  # turns that may be shared in the query's conversations
SPACE = r"[\x20\x09-\x0D]+"


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text; NULL counts as empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))


def count_words(text: Column) -> Column:
    """Words between ASCII white space. Each word becomes one letter, so that a long text makes no long array."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(letters, " \t\n\x0b\f\r", "")).cast("long")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns (digest, words) of each conversation by turn number, NULL first.

    Equal numbers are ordered by role and digest, so repeated rows stay as repeated turns.
    Rows without a conversation id belong to none.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            turn_digest(F.col("role"), F.col("text")).alias("digest"),
            count_words(F.col("text")).alias("words"),
        ).alias("turn"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return turns.groupBy("conv_id").agg(ordered.alias("turns"))


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """(digests, words, ids): distinct sequences of (conv_id, turns) with their ids, in sorted lists of up to CHUNK_IDS."""
    return (
        conversations.select(
            "conv_id",
            F.col("turns.digest").alias("digests"),
            F.col("turns.words").alias("words"),
            F.floor(F.col("conv_id") / F.lit(CHUNK_IDS)).alias("chunk"),
        )
        .groupBy("digests", "words", "chunk")
        .agg(F.sort_array(F.collect_set("conv_id")).alias("ids"))
    )


class TernaryTree:
    """Turn codes in a search tree: two children by order within a depth, one to the next depth."""

    def __init__(self):
        self.code, self.low, self.high, self.down = [], [], [], []
        self.members, self.smallest, self.own = [], [], []
        self.first = -1

    def _add(self, code: int) -> int:
        for values, value in ((self.code, code), (self.low, -1), (self.high, -1), (self.down, -1), (self.members, 0), (self.smallest, None), (self.own, -1)):
            values.append(value)
        return len(self.code) - 1

    def insert(self, codes: list[int], members: int, smallest: int, row: int) -> None:
        """One sequence that is not empty; ``row`` is kept at its last node."""
        values, at, place = self.down, -1, -1
        for code in codes:
            child = self.first if place < 0 else self.down[place]
            values, at = self.down, place
            while child >= 0 and self.code[child] != code:
                values, at = (self.low, child) if code < self.code[child] else (self.high, child)
                child = values[at]
            if child < 0:
                child = self._add(code)
                if at < 0:
                    self.first = child
                else:
                    values[at] = child
            place = child
            self.members[place] += members
            if self.smallest[place] is None or smallest < self.smallest[place]:
                self.smallest[place] = smallest
        self.own[place] = row

    def nodes(self) -> list[tuple[int, int, int]]:
        """(node, parent, depth) of all, a parent before its children, siblings in order; without recursion."""
        out, stack = [], [(self.first, -1, 1, False)] if self.first >= 0 else []
        while stack:
            node, parent, depth, seen = stack.pop()
            if seen:
                out.append((node, parent, depth))
                if self.down[node] >= 0:
                    stack.append((self.down[node], node, depth + 1, False))
                continue
            if self.high[node] >= 0:
                stack.append((self.high[node], parent, depth, False))
            stack.append((node, parent, depth, True))
            if self.low[node] >= 0:
                stack.append((self.low[node], parent, depth, False))
        return out


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle of every interval before its halves."""
    level = [(0, n)]
    while level:
        below = []
        for low, high in level:
            if low < high:
                middle = (low + high) // 2
                yield middle
                below += [(low, middle), (middle + 1, high)]
        level = below


NODE = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("node", T.BinaryType()),  # only of boundary nodes
        T.StructField("parent", T.BinaryType()),  # only where the parent is a boundary node
        T.StructField("depth", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),  # only where the parent is none
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("member_words", T.LongType()),  # members times words, over the subtree
        T.StructField("node_words", T.LongType()),  # words, over the subtree
        T.StructField("words", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("first", T.ArrayType(T.BinaryType())),  # only of the root: first and last sequence of the block
        T.StructField("first_words", T.ArrayType(T.LongType())),
        T.StructField("last", T.ArrayType(T.BinaryType())),
    ]
)
NO_ENDS = hashlib.sha256(b"").hexdigest()

Sequence = tuple[list[bytes], list[int], int, int, str]


def path_keys(digests: Iterable[bytes]) -> list[bytes]:
    """Names of the nodes on a path, from the root on."""
    running = hashlib.sha256(b"")
    keys = [running.digest()[:WIDTH]]
    for digest in digests:
        running.update(digest)
        keys.append(running.digest()[:WIDTH])
    return keys


def block_nodes(rows: list[Sequence], block: int) -> Iterator[tuple]:
    """The nodes of one block of sorted distinct sequences (digests, words, members, smallest id, ends)."""
    names = sorted({digest for row in rows for digest in row[0]})
    codes = {digest: code for code, digest in enumerate(names)}
    words_of = {digest: n for row in rows for digest, n in zip(row[0], row[1])}
    tree = TernaryTree()
    for i in medians(len(rows)):
        digests, _, members, smallest, _ = rows[i]
        if digests:
            tree.insert([codes[d] for d in digests], members, smallest, i)
    walk = tree.nodes()
    children, leaves = [0] * len(tree.code), [0] * len(tree.code)
    member_words, node_words = [0] * len(tree.code), [0] * len(tree.code)
    total = [0, 0, 0, 0]
    for node, parent, _ in reversed(walk):
        words = words_of[names[tree.code[node]]]
        leaves[node] = leaves[node] or 1
        member_words[node] += words * tree.members[node]
        node_words[node] += words
        if parent < 0:
            total = [total[0] + 1, total[1] + leaves[node], total[2] + member_words[node], total[3] + node_words[node]]
        else:
            children[parent] += 1
            leaves[parent] += leaves[node]
            member_words[parent] += member_words[node]
            node_words[parent] += node_words[node]

    first, last = rows[0], rows[-1]
    edge: dict[int, bytes] = {}
    for digests in {tuple(first[0]), tuple(last[0])}:
        keys, node = path_keys(digests), tree.first
        for depth, digest in enumerate(digests):
            while tree.code[node] != codes[digest]:
                node = tree.low[node] if codes[digest] < tree.code[node] else tree.high[node]
            edge[node] = keys[depth + 1]
            node = tree.down[node]
    root = path_keys(())[0]
    ends = first[4] if not first[0] else None
    yield (
        block, root, None, 0, min(row[3] for row in rows), None, sum(row[2] for row in rows),
        total[0], total[1] or 1, total[2], total[3], 0, ends, first[0], first[1], last[0],
    )
    for node, parent, depth in walk:
        above = root if parent < 0 else edge.get(parent)
        yield (
            block, edge.get(node), above, depth, tree.smallest[node], None if above else tree.smallest[parent], tree.members[node],
            children[node], leaves[node], member_words[node], node_words[node], words_of[names[tree.code[node]]],
            rows[tree.own[node]][4] if tree.own[node] >= 0 else None, None, None, None,
        )


def shard_nodes(batches: Iterable[pa.RecordBatch], part: int, block_turns: int = BLOCK_TURNS) -> Iterator[tuple]:
    """Nodes of sorted rows (digests, words, ids), in blocks; equal neighbours are one sequence whose ids run on."""
    block, rows, turns = part << 32, [], 0
    current, ends = None, None

    def close() -> Sequence:
        return (*current, ends.hexdigest())

    for batch in batches:
        for row in batch.to_pylist():
            ids = row["ids"]
            listed = ",".join(map(str, ids)).encode()
            if current is not None and current[0] == row["digests"]:
                ends.update(b"," + listed)
                current = (current[0], current[1], current[2] + len(ids), min(current[3], ids[0]))
                continue
            if current is not None:
                rows.append(close())
                turns += len(current[0]) + 1
                if turns >= block_turns:
                    yield from block_nodes(rows, block)
                    block, rows, turns = block + 1, [], 0
            current, ends = (row["digests"], row["words"], len(ids), ids[0]), hashlib.sha256(listed)
    if current is not None:
        rows.append(close())
        yield from block_nodes(rows, block)


def _as_batches(rows: Iterator[tuple], schema: T.StructType, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() if isinstance(f.dataType, T.StringType) else pa.binary() if isinstance(f.dataType, T.BinaryType)
             else pa.list_(pa.binary() if isinstance(f.dataType.elementType, T.BinaryType) else pa.int64()) for f in schema]
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held), kinds)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held), kinds)], schema.names)


CORRECTION = T.StructType([NODE[name] for name in ("node", "n_children", "n_leaves", "node_words")])


def neighbour_corrections(last: list[bytes], first: list[bytes], words: list[int]) -> list[tuple]:
    """What the nodes shared by the last sequence of a block and the first of the next must lose: counted in both."""
    shared = 0
    while shared < min(len(last), len(first)) and last[shared] == first[shared]:
        shared += 1
    below = np.concatenate((np.cumsum(np.array(words[:shared], np.int64)[::-1])[::-1], [0])).tolist()
    extended = int(shared == len(last))
    return [(key, -int(depth < shared), -extended, -below[max(depth - 1, 0)]) for depth, key in enumerate(path_keys(first[:shared]))]


def conversation_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, turns), the empty one included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree: members but one, times the words of the last turn),
    ends_sha256 (of the ids that end here). Equal sequences, whatever their number, are
    aggregated before they meet, and their ids stream through a hash in lists of bounded
    length. A task holds one block of about ``block_turns`` turns. One conversation is
    handled whole, with 16 bytes a turn. The order of the blocks is found from one row
    per block. No conversation gives no row.
    """
    spark = conversations.sparkSession
    distinct = cut(distinct_sequences(conversations), "sequences")
    turns = distinct.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if turns > block_turns else 1, -(-turns // TASK_TURNS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _as_batches(shard_nodes(batches, TaskContext.get().partitionId(), block_turns), NODE)

    ranged = distinct.repartitionByRange(parts, "digests") if parts > 1 else distinct.coalesce(1)
    nodes = cut(ranged.sortWithinPartitions("digests", "chunk").select("digests", "words", "ids").mapInArrow(build, NODE), "trie-nodes")

    blocks = Window.orderBy("block")
    pairs = (
        nodes.where("first IS NOT NULL")
        .select("last", F.lead("first").over(blocks).alias("first"), F.lead("first_words").over(blocks).alias("words"))
        .where("first IS NOT NULL")
    )

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (c for b in batches for r in b.to_pylist() for c in neighbour_corrections(r["last"], r["first"], r["words"]))
        yield from _as_batches(rows, CORRECTION)

    edge = nodes.where("node IS NOT NULL")
    summed = edge.unionByName(pairs.mapInArrow(correct, CORRECTION), allowMissingColumns=True)
    merged = cut(
        summed.groupBy("node").agg(
            *(F.max(c).alias(c) for c in ("depth", "words", "ends_sha256")),
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "member_words", "node_words")),
        ),
        "trie-edges",
    )
    # A boundary node's parent is one as well. Inner nodes below it look it up within their block, so the root is no hot key.
    named = merged.select("node", F.col("conv_id").alias("named_conv_id"))
    lookup = edge.select("block", "node").join(named, "node").select("block", F.col("node").alias("parent"), "named_conv_id")
    inner = nodes.where("node IS NULL")
    below = inner.where("parent IS NOT NULL").join(lookup, ["block", "parent"]).withColumn("parent_conv_id", F.col("named_conv_id")).drop("named_conv_id")
    parents = edge.where("parent IS NOT NULL").select("node", "parent").distinct()
    parents = parents.join(named.withColumnRenamed("node", "parent"), "parent").select("node", F.col("named_conv_id").alias("parent_conv_id"))
    shared = merged.join(parents, "node", "left")
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "member_words", "node_words", "ends_sha256")
    return (
        inner.where("parent IS NULL").select(*out).union(below.select(*out)).union(shared.select(*out))
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("member_words") - F.col("node_words")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def share_openings(conversations: DataFrame, group: int = 20, most: int = SHARED) -> DataFrame:
    """The query's rebuilt conversations: the first turns are those of the first conversation of twenty."""
    base = F.col("conv_id") - F.col("conv_id") % group
    head = F.max(F.when(F.col("conv_id") == base, F.slice("turns", 1, most))).over(Window.partitionBy(base))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1)).cast("int")
    own = F.when(taken < F.size("turns"), F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0))))
    none = F.slice("turns", 1, 0)
    return (
        conversations.withColumn("head", F.coalesce(head, none))
        .select("conv_id", F.concat(F.slice("head", 1, taken), F.coalesce(own, none)).alias("turns"))
    )


# The definition: prefixes are grouped as lists of turns. crc32 goes bit by bit over the decimal id.
OP12_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list({'role': role, 'text': text}
    ORDER BY turn NULLS FIRST, role, substr(sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), 1, 32)) AS ts FROM c GROUP BY conv_id),
h AS (SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) % 4 AS n FROM s),
r AS (SELECT h.conv_id, list_concat(coalesce(o.ts[1:h.n], []), h.ts[h.n + 1:]) AS ts
  FROM h LEFT JOIN s o ON o.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, ts[1:d] AS path, d, d = len(ts) AS ends FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids,
    CASE WHEN d > 0 THEN (count(*) - 1) * len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM p GROUP BY path, d),
k AS (SELECT path[1:d - 1] AS above, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
l AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.above = n.path),
t AS (SELECT path[1:e] AS top, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT path, saved, n_children, unnest(range(0, d + 1)) AS e FROM l) GROUP BY 1)
SELECT l.conv_id, l.d AS depth, u.conv_id AS parent_conv_id, l.n_convs, l.n_children, t.n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(l.ids) AS ends_sha256
FROM l JOIN t ON t.top = l.path LEFT JOIN n u ON l.d > 0 AND u.path = l.path[1:l.d - 1]"""


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return conversation_trie(share_openings(sequences(table(spark, sf_dir, "conversations"))))
