"""From raw documents to token ids: five stages, each a job over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and all but the last return the columns of
``docs``, in no order, with extra columns as they are. Rows with NULL ids or texts stay
unless a stage's rule says otherwise; an empty table gives an empty one. Texts are read
whole, and equal texts get equal decisions, whatever their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import remove_contaminated
from tidemark.llm.jaccard import drop_near_duplicates
from tidemark.llm.secrets import VOCABULARY, redact_secrets
from tidemark.llm.sentencepieces import MODEL, encode_pieces
from tidemark.llm.tables import cut, table
from tidemark.llm.toxicity import fit_toxicity, score_toxicity, training_labels


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; labels of the held-out fold are not read.

    NULL and empty texts get the share of toxic examples among those without a term; each
    repeated row is judged alike. Without labels of both classes nothing can be learned.
    """
    index = fit_toxicity(docs.select("doc_id", "text"), training_labels(spark, sf_dir))
    return score_toxicity(docs, index).where("predicted = 0").select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays, NULL ids after all others; of repeated rows one.

    NULL, empty and blank texts are near nothing and all stay.
    """
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, each repeated row as well; NULL texts and items hold no words."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text, and ``n_chars`` counts the new text; no document goes. NULL texts stay NULL."""
    import public_tokenizers

    clean = redact_secrets(docs, vocabulary=public_tokenizers.path(VOCABULARY))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def sentencepieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of each text, one row per row; NULL and empty texts have no ids."""
    import public_tokenizers

    return encode_pieces(docs, public_tokenizers.path(MODEL)).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("sentencepieces", sentencepieces),
]

# The stages learn a model, search similar texts and run a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
