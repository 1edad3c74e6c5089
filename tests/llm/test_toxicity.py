import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.helpers import documents

from tidemark.llm import toxicity
from tidemark.llm.arrays import Finder
from tidemark.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def corpus(spark, n=240):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    texts = []
    for i in range(n):
        own = rng.choices(words, k=40)
        if i % 4 == 0:
            own[rng.randrange(40)] = rng.choice(["nasty", "vile"])
        texts.append(" ".join(own))
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n // 2)] + [(None, 1), (5000, None)], "doc_id long, label int")
    return docs, labels, n


def test_unseen_documents_and_evidence(spark):
    docs, labels, n = corpus(spark)
    index = toxicity.fit_toxicity(docs.select("doc_id", "text"), labels)
    rows = toxicity.score_toxicity(docs.selectExpr("*", "'x' AS score"), index).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in rows if r.doc_id >= n // 2)
    assert all(1 <= len(r.evidence) <= 3 for r in rows if r.predicted)
    odd = toxicity.score_toxicity(documents(spark, [None, "", "none of these", "nasty " * 5000]), index).orderBy("doc_id").collect()
    assert len({r.score for r in odd[:3]}) == 1 and odd[3].predicted == 1
    assert toxicity.score_toxicity(documents(spark, []), index).count() == 0


def test_missing_classes(spark):
    docs, labels, _ = corpus(spark, 40)
    none = toxicity.fit_toxicity(docs.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    only = toxicity.fit_toxicity(docs.select("doc_id", "text"), labels.where("label = 1"))
    assert {r.predicted for r in toxicity.score_toxicity(docs, only).collect()} == {1}


@pytest.mark.parametrize("block, head, long", [(1, 1024, 48), (3, 4, 2), (64, 0, 1), (16, 0, 20), (64, 8, 1000)])
def test_blocks_give_the_nearest_by_brute_force(monkeypatch, block, head, long):
    monkeypatch.setattr(toxicity, "HEAD_TERMS", head)
    monkeypatch.setattr(toxicity, "LONG", long)
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(150):
        number = np.sort(rng.choice(30, rng.integers(0, 6), replace=False))
        weight = rng.integers(1, 4, len(number)).astype(float)
        vectors.append((number, weight / np.linalg.norm(weight) if len(number) else weight))
    params = toxicity.ToxicityParams(block=block, neighbours=7)
    index = toxicity.Index(np.arange(30, dtype=np.uint64), np.arange(30, dtype=np.uint64), np.ones(30), params)
    index.build(list(range(150)), rng.integers(0, 2, 150), np.ones(150), vectors, 0.5)
    dense = np.zeros((len(index.ids), 30))
    for row, i in enumerate(index.ids):
        dense[row, vectors[i][0]] = vectors[i][1]
    for _ in range(100):
        number = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        query = np.zeros(30)
        query[number] = 1 / np.sqrt(len(number))
        cosine = dense @ query
        want = sorted((i for i in range(len(cosine)) if cosine[i] > 1e-12), key=lambda i: (-round(cosine[i], 9), i))[:7]
        near, got = index.nearest(number, query[number])
        assert near.tolist() == want and np.allclose(got, cosine[want])


def test_query_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(rows[d].predicted, y) for d, y in labels.items() if rows[d].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.9


def features(text):
    """Words, their first 4 to 6 letters and levels of how often each occurs, with counts."""
    words = (text or "").lower().split()
    seen = Counter(words + [f"{w[:k]}~{k}" for w in words for k in (4, 5, 6) if len(w) > k])
    return dict(seen) | {f"{t}>={level}": 1 for t, c in seen.items() for level in (2, 4, 8) if c >= level}


def test_evidence_by_brute_force_over_all_terms(spark):
    docs, labels, n = corpus(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {i: int(i % 4 == 0) for i in range(n // 2)}
    vectors = {i: features(t) for i, t in texts.items()}
    held = Counter(t for v in vectors.values() for t in v)
    by_class = [Counter(t for i, y in known.items() if y == label for t in vectors[i]) for label in (0, 1)]
    terms = sorted(set(by_class[0]) | set(by_class[1]))
    weigh = toxicity.telling(*(np.array([c[t] for t in terms]) for c in (by_class[1], by_class[0])), sum(known.values()), len(known) - sum(known.values()))
    weigh = {t: w * np.log1p(n / held[t]) for t, w in zip(terms, weigh)}
    unit = {}
    for i, v in vectors.items():
        full = {t: (1 + np.log(c)) * weigh[t] for t, c in v.items() if t in weigh}
        norm = np.sqrt(sum(w * w for w in full.values()))
        unit[i] = {t: w / norm for t, w in full.items()}
    rows = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs.select("doc_id", "text"), labels)).collect()
    for r in rows:
        want = sorted((sum(w * unit[i].get(t, 0.0) for t, w in unit[r.doc_id].items()) for i in known), reverse=True)[:3]
        assert np.allclose([e.cosine for e in r.evidence], want)


def test_rare_abuse_and_a_long_clean_document_with_one_telling_word(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("al", "en", "ir", "os", "ut", "ax", "ey", "ov")]
    plain = lambda k: " ".join(rng.choices(words, k=k))
    toxic = [f"{plain(8)} nasty {plain(8)}" for _ in range(40)] + [f"{plain(4)} zounds varlet knave {plain(4)}"] * 2
    clean = [plain(60) for _ in range(160)]
    asked = [f"{plain(4)} zounds varlet knave {plain(4)}", plain(300) + " nasty " + plain(300)]
    docs = documents(spark, toxic + clean + asked)
    labels = spark.createDataFrame([(i, int(i < len(toxic))) for i in range(len(toxic) + len(clean))], "doc_id long, label int")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs.select("doc_id", "text"), labels)).collect()}
    rare, long = rows[len(toxic + clean)], rows[len(toxic + clean) + 1]
    assert rare.predicted == 1 and all(e.toxic for e in rare.evidence[:2])
    assert long.predicted == 0 and max(e.cosine for e in long.evidence) < 0.9


def test_examples_of_repeated_rows_and_ids_are_bounded(spark):
    docs, labels, _ = corpus(spark, 40)
    many = docs.select("doc_id", "text").union(spark.createDataFrame([(0, "nasty repeated text")] * 60, "doc_id long, text string"))
    assert len(toxicity.fit_toxicity(many, labels).ids) == 21
    other = docs.select("doc_id", "text").union(spark.createDataFrame([(0, f"nasty text {i}") for i in range(60)], "doc_id long, text string"))
    index = toxicity.fit_toxicity(other, labels, toxicity.ToxicityParams(examples_per_class=8))
    assert sorted(index.toxic.tolist()).count(1) <= 8 and len(index.ids) <= 16


def test_finder():
    rng = np.random.default_rng(3)
    ordered = np.unique(np.concatenate([rng.integers(0, 1 << 63, 500).astype(np.uint64), np.arange(40, dtype=np.uint64), np.array([2**64 - 1], np.uint64)]))
    asked = np.concatenate([ordered, ordered + np.uint64(1), np.array([0, 41], np.uint64)])
    place = {v: i for i, v in enumerate(ordered.tolist())}
    assert Finder(ordered).find(asked).tolist() == [place.get(v, -1) for v in asked.tolist()]
    assert Finder(ordered[:0]).find(asked).tolist() == [-1] * len(asked)


def test_groups_of_like_examples_are_small_and_change_nothing():
    rng = np.random.default_rng(5)
    vectors, counts = [], []
    for i in range(400):  # two languages with words of their own
        number = np.sort(rng.choice(100, 30, replace=False)) + 100 * (i % 2)
        counts.append(rng.integers(1, 9, 30))
        weight = 1 + np.log(counts[-1])
        vectors.append((number, weight / np.linalg.norm(weight)))
    index = toxicity.Index(np.arange(200, dtype=np.uint64), np.arange(200, dtype=np.uint64), np.ones(200), toxicity.ToxicityParams(block=16))
    index.build(list(range(400)), rng.integers(0, 2, 400), np.ones(400), vectors, 0.5)
    index.counts = np.concatenate([counts[i] for i in index.order])
    there = pickle.loads(pickle.dumps(index))
    dense = np.zeros((400, 200))
    for row, i in enumerate(index.ids):
        dense[row, vectors[i][0]] = vectors[i][1]
    for language in (0, 1):
        number = np.sort(rng.choice(100, 30, replace=False)) + 100 * language
        cosine = dense[:, number] @ np.full(30, 1 / np.sqrt(30))
        want = sorted(range(400), key=lambda i: (-round(cosine[i], 9), i))[:15]
        near, got = there.nearest(number, np.full(30, 1 / np.sqrt(30)))
        assert near.tolist() == want and np.allclose(got, cosine[want])
    # no group has terms of the other language, and a process keeps no second copy of the vectors
    assert len(there.groups) > 1 and sum(head.size for _, _, _, head in there.groups) == 400 * 100
    assert not {"term", "first", "entry"} & set(there.__dict__) and there.counts is None
    assert pickle.loads(pickle.dumps(there)).nearest(number, np.full(30, 1 / np.sqrt(30)))[0].tolist() == want


def test_index_is_made_in_little_memory():
    import pickle
    import tracemalloc

    rng = np.random.default_rng(2)
    vocabulary = np.unique(rng.integers(0, 1 << 63, 30_000).astype(np.uint64))
    index = toxicity.Index(vocabulary, vocabulary, rng.random(len(vocabulary)) + 1, toxicity.ToxicityParams())
    vectors, counts = [], []
    for _ in range(2000):
        number = np.unique((len(vocabulary) * rng.random(400) ** 3).astype(np.int64))
        counts.append(rng.integers(1, 9, len(number)))
        vectors.append((number, index.weigh(np.zeros(len(number), np.int64), number, counts[-1], 1)))
    index.build(list(range(2000)), np.arange(2000) % 2, np.ones(2000), vectors, 0.5)
    index.counts = np.concatenate([counts[i] for i in index.order])
    held = pickle.loads(pickle.dumps(index))
    size = held.term.nbytes + held.entry.nbytes
    tracemalloc.start()
    held.invert()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak - sum(slot.nbytes + head.nbytes for _, _, slot, head in held.groups) < 2.2 * size
    own = index.order[7]
    near, cosine = held.nearest(*vectors[own])
    assert near[0] == 7 and cosine[0] > 1 - 1e-6


def counted_index(rng, examples=1500, terms=20_000):
    """An index of vectors by counts as a process gets it, and the vectors by example."""
    vocabulary = np.unique(rng.integers(0, 1 << 63, terms).astype(np.uint64))
    index = toxicity.Index(vocabulary, vocabulary, rng.random(len(vocabulary)) + 1, toxicity.ToxicityParams())
    vectors, counts = [], []
    for _ in range(examples):
        number = np.unique((len(vocabulary) * rng.random(400) ** 3).astype(np.int64))
        counts.append(rng.geometric(0.6, len(number)))
        vectors.append((number, index.weigh(np.zeros(len(number), np.int64), number, counts[-1], 1)))
    index.build(list(range(examples)), np.arange(examples) % 2, np.ones(examples), vectors, 0.5)
    index.counts = np.concatenate([counts[i] for i in index.order])
    return pickle.loads(pickle.dumps(index)), [vectors[i] for i in index.order]


def test_index_holds_few_bytes_per_entry():
    import tracemalloc

    held, vectors = counted_index(np.random.default_rng(6))
    assert np.allclose(held.entry, np.concatenate([w for _, w in vectors]))
    size = held.term.nbytes + held.entry.nbytes
    tracemalloc.start()
    held.invert()
    now = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert now - sum(slot.nbytes + head.nbytes for _, _, slot, head in held.groups) < 0.75 * size


@pytest.mark.parametrize("long", [2, 60, 5000])
def test_amounts_by_run_give_the_cosines_of_the_vectors(monkeypatch, long):
    monkeypatch.setattr(toxicity, "LONG", long)
    held, vectors = counted_index(np.random.default_rng(7), 500, 2000)
    dense = np.zeros((len(vectors), len(held.vocabulary)))
    for row, (number, weight) in enumerate(vectors):
        dense[row, number] = weight
    asked = [vectors[i] for i in range(0, 500, 9)]
    first = np.append(0, np.cumsum([len(n) for n, _ in asked]))
    got = held.nearest_rows(first, np.concatenate([n for n, _ in asked]), np.concatenate([w for _, w in asked]))
    for (number, weight), (near, cosine) in zip(asked, got, strict=True):
        want = dense[:, number] @ weight
        order = sorted(range(len(want)), key=lambda i: (-round(want[i], 9), i))[:15]
        assert near.tolist() == order and np.allclose(cosine, np.minimum(want[order], 1), atol=1e-12)


def test_runs_and_codes():
    runs = toxicity.Runs(np.array([0, 2, 2, 5]), np.array([7, 300, 1, 2, 3]), 300)
    assert runs.take(np.array([2, 1, 0, 2])).tolist() == [1, 2, 3, 7, 300, 1, 2, 3]
    assert len(runs.take(np.array([1]))) == len(runs.take(np.zeros(0, np.int64))) == 0
    distinct, code = toxicity._coded(np.array([5, 1, 5, 9]))
    assert distinct.tolist() == [1, 5, 9] and code.tolist() == [1, 0, 1, 2]
