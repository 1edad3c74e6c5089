import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from llm.helpers import SF_DIR, documents, read
from sentencepiece import SentencePieceProcessor

from tidemark.llm import sentencepieces as sp
from tidemark.llm.registry import QUERIES

PATH = public_tokenizers.path(sp.MODEL)
LIBRARY = SentencePieceProcessor(model_file=PATH)


def test_random_texts_equal_the_library():
    rng = random.Random(1)
    alphabet = list("  \n\tabcdeéñ▁日本😀the ing\x00\x7f")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [" " * k for k in range(40)] + ["a" + " " * k + "the" for k in range(40)] + ["x" * 2000, "the " * 5000]
    got = sp.encode_texts(pa.array([None] + texts), PATH).to_pylist()
    assert got == [[]] + [LIBRARY.encode(t) for t in texts]
    assert [sp.decode_ids(g, PATH) for g in got[1:]] == [t.replace("▁", " ") for t in texts]


def test_suffixes_and_pairs_that_share_a_place(monkeypatch):
    rng = np.random.default_rng(6)
    for size in (1, 5, 300):
        index = np.append(rng.integers(97, 99, size), sp._STOP).astype(np.uint8)
        raw = index.tobytes()
        assert sp._suffixes(index, 512).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    monkeypatch.setattr(sp, "PAIR_BITS", 3)
    model = sp.PieceModel(PATH)
    words = [b" the", b" thinking", " ñandú日".encode(), b" aaaaabbbb"] * 2
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    for _ in range(2):  # the second time from the few pairs that are kept
        ids, sizes = model.encode(data, ends - np.array([len(w) for w in words]), ends)
        assert ids.tolist() == [i for w in words for i in LIBRARY.encode(w.decode()[1:])] and sizes.sum() == len(ids)


def test_decoding_odd_ids():
    assert sp.decode_ids(None, PATH) == "" and sp.decode_ids([], PATH) == ""
    assert sp.decode_ids([1, 2], PATH) == ""
    assert sp.decode_ids([3 + 0xE2, 3 + 0x41], PATH) == "�A"


def test_rows(spark):
    docs = documents(spark, [None, "", "a b", "a b"]).selectExpr("*", "1 AS ids", "'q' AS decoded")
    out = sp.decode_pieces(sp.encode_pieces(docs, PATH), PATH)
    assert [(list(r.ids), r.decoded) for r in out.orderBy("doc_id").collect()] == [([], ""), ([], ""), (LIBRARY.encode("a b"), "a b"), (LIBRARY.encode("a b"), "a b")]
    assert sp.encode_pieces(documents(spark, []), PATH).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in sp.decode_pieces(nulls, PATH).collect()] == ["", ""]


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in QUERIES["op6_sentencepieces"](spark, SF_DIR).collect()}
    for doc_id, text in read("documents", "doc_id, text"):
        assert list(got[doc_id].ids) == LIBRARY.encode(text) and got[doc_id].same_text
