import random
import re

import corpus_pipeline
import public_tokenizers
from llm.helpers import SCHEMA, SF_DIR, documents
from sentencepiece import SentencePieceProcessor

from tidemark.llm import sentencepieces
from tidemark.llm.tables import table


def test_stages_keep_columns_and_act(spark):
    docs = table(spark, SF_DIR, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "benchmark_decontamination", "secret_scan", "sentencepieces"]
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_decisions(spark):
    stages = dict(corpus_pipeline.STAGES)
    item = table(spark, SF_DIR, "benchmark").first().text
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", "x " + item, "the token=abcdef12 is here", None, ""])
    assert sorted(r.doc_id for r in stages["ngram_jaccard"](spark, docs, SF_DIR).collect()) == [0, 2, 3, 4, 5]
    assert 2 not in [r.doc_id for r in stages["benchmark_decontamination"](spark, docs, SF_DIR).collect()]
    clean = {r.doc_id: r for r in stages["secret_scan"](spark, docs, SF_DIR).collect()}
    assert clean[3].text == "the [SECRET] is here" and clean[3].n_chars == len(clean[3].text) and clean[4].text is None
    ids = {r.doc_id: list(r.ids) for r in stages["sentencepieces"](spark, docs, SF_DIR).collect()}
    library = SentencePieceProcessor(model_file=public_tokenizers.path(sentencepieces.MODEL))
    assert ids[0] == library.encode("a b c d e f g") and ids[4] == []


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(rows) < table(spark, SF_DIR, "documents").count()
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def planted():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n=60: " ".join(rng.choices(words, k=n))
    rows = [(i, text() + (" nasty vile" * 2 if i % 4 == 0 else "")) for i in range(120)]
    near = text()
    item = text(15)
    rows += [(200, near), (150, near), (151, near + " more"), (None, near), (152, near), (152, near), (152, text())]
    rows += [(160, text(20) + " " + item + " " + text(20)), (161, "the token=abcdef12 is here " + text(10)), (162, None), (163, ""), (None, text()), (None, None)]
    return rows, item


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_chain(rows, item):
    """The stages row by row; toxic documents are those with the planted words."""
    rows = [r for r in rows if "nasty" not in (r[1] or "")]
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        rank = (doc_id is None, doc_id or 0, i)
        best[group[i]] = min(best.get(group[i], rank), rank)
    rows = [rows[i] for *_, i in best.values()]
    kept = [(i, t) for i, t in rows if f" {item} " not in f" {t} "]
    return [(i, t and re.sub("token=abcdef12", "[SECRET]", t)) for i, t in kept]


def test_run_by_brute_force(spark, tmp_path):
    rows, item = planted()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    docs.selectExpr("*", "'x' AS score", "1 AS n_shingles", "'y' AS component_id").write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF_DIR, "benchmark").limit(1).selectExpr(*[f"'{item}' AS text" if c == "text" else c for c in table(spark, SF_DIR, "benchmark").columns]).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    library = SentencePieceProcessor(model_file=public_tokenizers.path(sentencepieces.MODEL))
    want = [(i, library.encode(t or "")) for i, t in plain_chain(rows, item)]
    got = [(r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_stages_on_an_empty_table(spark):
    empty = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
