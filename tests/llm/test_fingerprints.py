import hashlib

from llm.helpers import SF_DIR, documents, read
from pyspark.sql import functions as F

from tidemark.llm import fingerprints
from tidemark.llm.registry import QUERIES


def edits(rows):
    """(n_chars, edited sha256) by place, for rows in descending order."""
    out = []
    for i, (_, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(i + 1) % len(rows)][1][:half]
        out.append((len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def check(got, docs):
    rows = sorted(((d, t or "") for d, t in docs), reverse=True)
    want = {d: w for (d, _), w in zip(rows, edits(rows))}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        text = dict(docs)[r.doc_id] or ""
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    return {r.doc_id: r for r in got}


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 2)
    texts = [None, "", "a", "äöü 日本 x", "One line here.\nTwo lines there, and more.", "One line here.\nTwo lines there, and more.", "w ords " * 9000]
    docs = documents(spark, texts).selectExpr("*", "1 AS fingerprint", "'s' AS sha", "2 AS v")
    got = check(fingerprints.compare_with_edits(docs).collect(), list(enumerate(texts)))
    assert got[0].fingerprint == got[1].fingerprint and got[5].near_next == 1.0


def test_one_row_no_row_and_repeated_rows(spark):
    one = fingerprints.compare_with_edits(documents(spark, ["abcd"])).collect()
    check(one, [(0, "abcd")])
    assert fingerprints.compare_with_edits(documents(spark, [])).count() == 0
    docs = spark.createDataFrame([(2, "xxyy"), (2, "xxyy"), (1, "abcd"), (None, "null")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.edited_sha256) for r in fingerprints.compare_with_edits(docs).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(2, sha("xxab")), (2, sha("xxab")), (1, sha("abnu")), (None, sha("nuxx"))], key=str)


def test_order_does_not_matter_and_pieces_add_up(spark):
    rows = spark.createDataFrame([("First part.\nSecond part.\nThird one.",), ("Third one.\nFirst part.\nSecond part.",), ("First part.\nSecond part.",), ("Third one.",)], "t string")
    v = [r.v for r in fingerprints.with_vector(rows, F.col("t"), "v").collect()]
    assert v[0] == v[1] != v[2]
    pair = spark.createDataFrame([(v[2], v[3], v[0])], "a array<long>, b array<long>, c array<long>")
    assert pair.select(fingerprints.add_vectors(F.col("a"), F.col("b")) == F.col("c")).first()[0]
    assert pair.select(fingerprints.subtract_vectors(F.col("c"), F.col("b")) == F.col("a")).first()[0]


def test_plan_has_no_python(spark):
    plan = fingerprints.fingerprint(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_query(spark):
    got = check(QUERIES["op8_fingerprints"](spark, SF_DIR).collect(), read("documents", "doc_id, text"))
    near = [r.near_edited for r in got.values()]
    far = [r.near_next for r in got.values()]
    assert sum(near) / len(near) > 0.4 > 0.15 > sum(far) / len(far)
