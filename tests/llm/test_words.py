"""Equality of words by their hashes: no pattern of letters may make two words one."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import documents
from tokenizers import Tokenizer

from tidemark.llm.arrays import span_hashes
from tidemark.llm.registry import QUERIES
from tidemark.llm.sentencepieces import MODEL, encode_pieces
from tidemark.llm.tokens import END_ID, VOCABULARY


def pair(letters="ab", rounds=10):
    """Two words of 2**rounds letters, each the other with its letters exchanged, arranged as Thue and Morse did."""
    bits = [bin(i).count("1") % 2 for i in range(1 << rounds)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def hashes(*words):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return span_hashes(data, ends - [len(w.encode()) for w in words], ends).tolist()


@pytest.mark.parametrize("letters", ["ab", "X_", "01", "\x00\x7f"])
def test_arranged_words_differ(letters):
    for rounds in range(1, 19):
        a, b = pair(letters, rounds)
        one, two = hashes(a, b)
        assert one != two


def test_equal_words_are_equal_anywhere():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.choice([0, 1, 5, 250, 300, 5000]))) for _ in range(60)] + ["x" * 600_000, "x" * 600_001]
    both = hashes(*words, *reversed(words))
    assert both[: len(words)] == both[len(words) :][::-1]
    assert len(set(both)) == len(set(words))
    assert hashes(words[-1]) == [both[len(words) - 2 + 1]]


def test_queries(spark, tmp_path):
    """Documents and an item that differ in such words only."""
    a, b = pair()
    texts = [a, b, f"{a} x", f"{b} x"]
    folder = str(tmp_path)
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("i", a)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert {r.doc_id: r.component_id for r in QUERIES["op2_ngram_jaccard"](spark, folder).collect()} == {0: 0, 1: 1, 2: 2, 3: 3}
    assert sorted(r.doc_id for r in QUERIES["op1_benchmark_decontamination"](spark, folder).where("n_hit > 0").collect()) == [0, 2]
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = {i: library.encode(t, add_special_tokens=False).ids + [END_ID] for i, t in enumerate(texts)}
    for row in QUERIES["op3_token_files"](spark, folder).collect():
        ids = want[row.doc_id]
        assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))


def test_pieces(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    texts = [" ".join(pair()), " ".join(reversed(pair()))]
    rows = encode_pieces(documents(spark, texts), public_tokenizers.path(MODEL)).orderBy("doc_id").collect()
    assert [r.ids for r in rows] == [library.encode(t) for t in texts]
