import random
import re

import pytest
from llm.helpers import SF_DIR, ascii_lower, documents, read
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import components, jaccard
from tidemark.llm.components import connected_components
from tidemark.llm.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(ascii_lower(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(n_shingles, component) by row place; links over all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"n{rng.random()}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [256, 4])
def test_families_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", "  ", "one two", "ONE two", "one two three", "a b c d e", "a b c d e", "A b c d e f"]
    line = " ".join(rng.choices(vocabulary, k=14))
    for size in (40, 90):
        base = " ".join(rng.choices(vocabulary, k=size))
        texts += family(rng, base, 12, 2) + [base, base, base.upper()]
    texts += [" ".join(rng.choices(vocabulary, k=30)) + " " + line for _ in range(20)]
    texts += [" ".join(rng.choices(vocabulary, k=4000))] * 2
    rows = list(enumerate(texts))
    got = jaccard.jaccard_classes(documents(spark, texts)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (2, None), (None, "q r s t u v"), (None, "")], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS n_shingles", "2 AS component_id", "3 AS key", "'x' AS token")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(docs).collect()), key=str)
    assert got == sorted([(None, 3, 3), (3, 3, 3), (3, 3, 3), (2, 0, 2), (None, 2, None), (None, 0, None)], key=str)
    assert jaccard.jaccard_classes(documents(spark, [])).count() == 0


def test_exact_threshold():
    # 8 of 10 shingles shared is a link, 7 of 9 is none
    assert jaccard.least_overlap(9, 9) == 8
    assert (jaccard.prefix_size(10), jaccard.needed(10), jaccard.prefix_size(1), jaccard.needed(1)) == (3, 1, 1, 1)
    assert (jaccard.shared_at_least(100), jaccard.prefix_size(100), jaccard.needed(100)) == (10, 30, 8)
    for x in range(1, 60):
        for y in range(1, 60):
            need = jaccard.least_overlap(x, y)
            assert 100 * need >= 80 * (x + y - need) and 100 * (need - 1) < 80 * (x + y - need + 1)


def test_heap_and_sort_merge_agree():
    import numpy as np

    lists = [np.array([1, 4, 9]), np.array([4, 9]), np.array([9])]
    assert jaccard.merge_counts(lists) == {1: 1, 4: 2, 9: 3}
    assert jaccard.merge_counts(lists[:1]) == {1: 1, 4: 1, 9: 1}


def test_near_duplicates_leave_one(spark):
    text = "a b c d e f g h"
    docs = documents(spark, [text, text, "other words stand here now", None, "", text + " i"])
    assert sorted(r.doc_id for r in jaccard.drop_near_duplicates(docs).collect()) == [0, 2, 3, 4]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 60), (60, 99), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {60: 60, 99: 60, 100: 60}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op2_ngram_jaccard"](spark, SF_DIR).collect()]
    assert sorted(got, key=str) == brute(read("documents", "doc_id, text"))


def test_repeated_rows_are_searched_once(spark, monkeypatch):
    search, rows = jaccard._search, []

    def counted(members, *rest):
        rows.append(members.groupBy("cluster", "node").count().agg(F.max("count")).first()[0])
        return search(members, *rest)

    monkeypatch.setattr(jaccard, "_search", counted)
    text = "a b c d e f g h i j k l m n o p"
    docs = spark.createDataFrame([(1, text)] * 200 + [(2, text + " q"), (3, text), (4, "quite another text stands here")], "doc_id long, text string").repartition(7)
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_classes(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)} and rows[0] == 1


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    cut, tables = components.cut, []
    monkeypatch.setattr(components, "cut", lambda df, name: tables.append(name) or cut(df, name))
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z", "y"), ("x", "z"), ("x", "x"), (None, "q")]
    rnd = random.Random(5)
    edges += [(f"r{rnd.randrange(90):02}", f"r{rnd.randrange(90):02}") for _ in range(60)]
    parent = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    for _ in parent:  # as many rounds as the longest path may have
        for a, b in edges:
            if a in parent and b in parent:
                parent[a] = parent[b] = min(parent[a], parent[b])
    rows = spark.createDataFrame(edges, "a string, b string").repartition(9)
    assert sorted(map(tuple, connected_components(rows).collect())) == sorted(parent.items())
    assert len(tables) == 2
    # the rounds over larger tables find the same
    monkeypatch.setattr(components, "TASK_EDGES", 5)
    assert sorted(map(tuple, connected_components(rows).collect())) == sorted(parent.items())
    assert len(tables) > 6


def test_near_duplicates_move_no_texts(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 9), (2, text + " more", 8), (3, "a text that stands alone here", 7), (4, None, 6), (None, text, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int")
    monkeypatch.setattr(jaccard, "jaccard_classes", lambda d, *a: d.select(F.col("row").alias("doc_id"), F.lit(1).alias("n_shingles"), F.min("row").over(W.partitionBy(F.col("text").startswith("w0"))).alias("component_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.drop_near_duplicates(docs)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
        assert sorted(r.other for r in kept.collect()) == [6, 7, 9]
        twice = docs.union(docs)
        assert sorted(r.other for r in jaccard.drop_near_duplicates(twice).collect()) == [6, 7, 9]
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)  # as with many groups
        assert sorted(r.other for r in jaccard.drop_near_duplicates(twice).collect()) == [6, 7, 9]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
