import hashlib
import re

import pytest
from llm.helpers import SF_DIR, ascii_lower, documents, read

from tidemark.llm import decontaminate
from tidemark.llm.registry import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts, items):
    out = []
    for text in texts:
        words = WORD.findall(ascii_lower(text))
        hit, found = set(), set()
        for item, item_text in items:
            own = WORD.findall(ascii_lower(item_text))
            if not own:
                continue
            k = min(10, len(own))
            windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
            for p in range(len(words) - k + 1):
                if tuple(words[p : p + k]) in windows:
                    found.add(str(item))
                    hit |= set(range(p, p + k))
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [None, "", " \n ", PASSAGE, PASSAGE.upper() + " x " + PASSAGE, "a " * 30 + PASSAGE[8:] + " tail", "naïve Été", "b a a a", "x" * 5000 + " " + "w " * 3000]
ITEMS = [(1, PASSAGE), (2, None), (3, ""), (4, "naïve"), (5, "A a"), (6, PASSAGE + " thirteen"), (6, PASSAGE), (7, "w " * 11)]


def rows_of(spark, texts, items, limit=10**6):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(documents(spark, texts), bench, limit=limit).orderBy("doc_id").collect()
    out = []
    for r in found:
        names = sorted({m.item_id for m in r.matches})
        hit = sum(h.end - h.start for h in r.hit_ranges)
        out.append((r.n_words, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0))
    return out


@pytest.mark.parametrize("limit", [10**6, 40])
def test_awkward_rows_in_one_and_many_blocks(spark, limit):
    assert rows_of(spark, TEXTS, ITEMS, limit) == brute(TEXTS, ITEMS)


def test_longest_match_and_place(spark):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    row = decontaminate.find_contamination(documents(spark, ["zero zero " + PASSAGE + " " + PASSAGE[:40]]), bench).first()
    assert [(m.item_id, m.word, m.length) for m in row.matches] == [("1", 2, 12)]


def test_empty_tables_and_clashing_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, ["a b"]).selectExpr("*", "7 AS matches", "8 AS n_words")
    row = decontaminate.find_contamination(docs, bench).first()
    assert row.matches == [] and row.n_words == 2
    full = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_contamination(documents(spark, []), full).count() == 0
    assert decontaminate.remove_contaminated(documents(spark, ["a b", "c", None]), full).count() == 2


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op1_benchmark_decontamination"](spark, SF_DIR).collect()}
    docs, items = read("documents", "doc_id, text"), read("benchmark", "item_id, text")
    want = brute([t for _, t in docs], items)
    for (doc_id, _), w in zip(docs, want):
        r = got[doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == w
    assert len(got) == len(docs)
