"""Periodic runs against a search of every period."""

from __future__ import annotations

import hashlib
import random
import zlib

from llm.helpers import SF_DIR, documents, read

from tidemark.llm.runs import collapse, find_runs, op11_periodic_runs, periodic_runs, repeat_tail, strongest


def brute_runs(words, min_length=24, min_periods=3):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_periods * q):
                run = words[i : i + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1 if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    drop = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in drop]


def repetitive(rnd):
    words = []
    while len(words) < rnd.randint(0, 150):
        if words and rnd.random() < 0.5:
            words += words[-rnd.randint(1, 12) :] * rnd.randint(1, 8)
        else:
            words.append(b"%d" % rnd.randrange(rnd.choice([1, 2, 5, 90])))
    return words


def test_all_runs_of_repetitive_sequences():
    rnd = random.Random(11)
    for _ in range(800):
        words = repetitive(rnd)
        for rule in ((24, 3), (6, 2), (10, 3), (5, 4)):
            runs = find_runs(words, *rule)
            assert runs == brute_runs(words, *rule)
            assert collapse(words, runs) == brute_collapse(words, runs)


def test_overlapping_runs_and_ties():
    words = [b"a", b"b"] * 12 + [b"c"] + [b"a", b"b"] * 12
    assert find_runs(words) == [(0, 24, 2), (25, 24, 2)]
    assert strongest(find_runs(words)) == (0, 24, 2)
    assert find_runs([b"x"] * 23) == [] and find_runs([b"x"] * 24) == [(0, 24, 1)]
    nested = ([b"y"] * 24 + [b"z"]) * 3
    assert find_runs(nested) == brute_runs(nested) and (0, 75, 25) in find_runs(nested)


def test_awkward_rows(spark):
    long = " ".join(["one two  three four"] * 20_000)
    docs = documents(spark, [None, "", " \t\n", "a\x0bb " * 12, long, "a b " * 12, "a b " * 12]).selectExpr("*", "'mine' AS runs")
    rows = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [rows[i].n_words for i in range(7)] == [0, 0, 0, 24, 60_000, 24, 24]
    assert all(rows[i].runs == [] and rows[i].strongest is None and rows[i].collapsed == "" for i in range(3))
    assert rows[3].collapsed == "a b" and tuple(rows[3].strongest) == (0, 24, 2)
    assert rows[4].collapsed == "one two three four" and tuple(rows[4].strongest) == (0, 60_000, 3)
    assert rows[5].runs == rows[6].runs
    assert rows[0].lang == "en"
    assert periodic_runs(docs.limit(0)).count() == 0


def test_null_ids_change_nothing(spark):
    docs = spark.createDataFrame([(None, "a b c " * 3), (None, None)], "doc_id long, text string")
    assert [r.n_words for r in periodic_runs(docs, rewrite=repeat_tail).orderBy("n_words").collect()] == [0, 9]


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query(spark):
    rows = {r.doc_id: r for r in op11_periodic_runs(spark, SF_DIR).collect()}
    texts = read("documents", "doc_id, text")
    assert len(rows) == len(texts)
    found = 0
    for doc_id, text in texts:
        words = changed(doc_id, (text or "").encode().split())
        runs = brute_runs(words) if len(words) < 2500 else find_runs(words)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        row = rows[doc_id]
        found += len(runs)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapse(words, runs))).hexdigest()
    assert found > 5
