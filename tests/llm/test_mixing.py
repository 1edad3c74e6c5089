"""The mix: shares against a step-by-step dealing out, fits against all sums, choices by their totals."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from llm.helpers import SF_DIR, documents, read

from tidemark.llm import mixing
from tidemark.llm.mixing import fit_lengths, fit_rest, mix_to_targets, op13_mixture


def all_sums(free, budget):
    reach = {0}
    for length, n in free.items():
        reach = {r + length * k for r in reach for k in range(n + 1) if r + length * k <= budget}
    return reach


def test_knapsack_reaches_the_largest_sum():
    rnd = random.Random(13)
    for _ in range(400):
        free = {rnd.randint(1, 60): rnd.randint(1, 5) for _ in range(rnd.randint(0, 6))}
        budget = rnd.randint(0, 200)
        got = fit_rest(free, budget)
        assert all(0 < n <= free[length] for length, n in got.items())
        assert sum(length * n for length, n in got.items()) == max(all_sums(free, budget))


@pytest.mark.parametrize("window", [30, 1000, 65_536])
def test_fit_stays_within_counts_and_budget(window):
    rnd = random.Random(window)
    for _ in range(200):
        counts = {rnd.randint(1, 500): rnd.randint(1, 50) for _ in range(rnd.randint(1, 30))}
        size = sum(length * n for length, n in counts.items())
        budget = rnd.randint(0, size + 10)
        taken = fit_lengths(counts, budget, window)
        total = sum(length * n for length, n in taken.items())
        assert all(0 <= taken[length] <= counts[length] for length in counts)
        assert total <= budget and (total == size or budget - total <= min(counts) + 500)


def shares(sizes, weights=(5, 2, 1), share=1.5, copies=2):
    """The excess of full sources dealt out by weight, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            got[s] += left * weight[s] / total
        left = 0
        for s in list(open_):
            if got[s] > copies * sizes[s]:
                left += got[s] - copies * sizes[s]
                got[s] = float(copies * sizes[s])
                open_.discard(s)
    return got


def check(rows, by_id):
    """rows: (doc_id, source, size, source_size, target, taken)."""
    sizes, taken = defaultdict(int), defaultdict(int)
    for doc_id, source, size, _, _, took in rows:
        sizes[source] += size
        taken[source] += took
        assert by_id is None or size == by_id[doc_id]
        assert size == 0 and took == 0 or took in (0, size, 2 * size)
    want = shares(sizes)
    for _, source, _, source_size, target, _ in rows:
        assert source_size == sizes[source]
        assert target == pytest.approx(want[source], rel=1e-9, abs=1e-9)
    return sizes, taken, want


def test_query(spark):
    texts = {i: len((t or "").encode().split()) for i, t in read("documents", "doc_id, text")}
    sources = dict(read("documents", "doc_id, source"))
    rows = [(r.doc_id, sources[r.doc_id], r["size"], r.source_size, r.target, r.taken) for r in op13_mixture(spark, SF_DIR).collect()]
    assert len(rows) == len(texts)
    sized, taken, want = check(rows, texts)
    for source in want:  # as near as any choice of its few documents comes
        goal, counts = int(want[source] + 0.5), Counter(r[2] for r in rows if r[1] == source and r[2])
        whole = goal // sized[source]
        assert taken[source] == whole * sized[source] + max(all_sums(counts, goal - whole * sized[source]))
    again = op13_mixture(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r[0], r[5]) for r in rows)


def mixed(spark, docs, **options):
    return [tuple(r) for r in mix_to_targets(docs, **options).collect()]


def test_awkward_rows(spark):
    texts = [None, "", "a b", "a b", "c " * 50_000, " \t", "d e f"] * 2
    docs = documents(spark, texts).selectExpr("doc_id", "text", "IF(doc_id % 3 = 0, NULL, CAST(doc_id % 3 AS string)) AS source", "1 AS size", "2 AS part")
    rows = mixed(spark, docs)
    assert len(rows) == 14
    check(rows, None)
    assert mixed(spark, docs.limit(0)) == []
    empty = mixed(spark, documents(spark, [None, "", " "]))
    assert [r[2:] for r in empty] == [(0, 0, 0.0, 0)] * 3
    nameless = mixed(spark, docs.withColumn("doc_id", docs.doc_id * None))
    assert len(nameless) == 14


def test_hot_length_is_put_in_order_in_parts(spark, monkeypatch):
    """Half of the rows have one source and length, some of them equal; exactly as many as planned are taken."""
    monkeypatch.setattr(mixing, "GROUP_ROWS", 50)
    rows = [(i // 2 if i < 500 else i, "a b c" if i % 2 else "x " * (i % 7 + 1), f"s{i % 4 if i % 5 else 0}") for i in range(4000)]
    docs = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
    got = mixed(spark, docs)
    assert len(got) == 4000
    _, taken, want = check(got, None)
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)  # some sources have texts of 3 words only
    assert sorted(got) == sorted(mixed(spark, docs.repartition(7)))
    other = mixed(spark, docs, seed=14)
    assert sorted(r[5] for r in other) != [] and sorted(other) != sorted(got)
