import zlib

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import SF_DIR, documents, read
from tokenizers import Tokenizer

from tidemark.llm import tokens, units
from tidemark.llm.registry import QUERIES
from tidemark.session import scratch_path

PATH = public_tokenizers.path(tokens.VOCABULARY)
ODD = [
    None, "", " \n\t", "it's a 'test' don't <|endoftext|>x a<|startoftext|> y", "élève,x—,y. 12ab34 x'S 'LL ,'s .'\" Kelvin ſa İI",
    "a b c,́ x́, ́a", "ΣΑΣ ς. 日本語、テスト abc123!?#$%% ''' 're're", "\x1c\x1da\x85b\x00", "z" * 3000 + " " + "word, " * 4000,
]


def want(texts):
    encoder, at, out = Tokenizer.from_file(PATH), 0, []
    for text in texts:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]
        out.append((at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [10**7, 9000])
def test_files_give_back_the_library_ids(spark, part_bytes):
    files = tokens.write_token_files(documents(spark, ODD), scratch_path(spark, "t"), PATH, part_bytes=part_bytes)
    got = [(r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_token_files(files).orderBy("doc_id").collect()]
    assert got == want(ODD)


def test_small_table_starts_anew():
    import pyarrow as pa

    from tidemark.llm.arrays import text_buffer

    small, large = tokens.TokenEncoder(PATH, limit=3), tokens.TokenEncoder(PATH)
    for texts in (["a b c d"], ["a e, f"], ["b c d e f g h"]):
        data, offsets = text_buffer(pa.array(texts))
        assert small.encode(data, offsets)[0].tolist() == large.encode(data, offsets)[0].tolist()


def test_one_frame_is_read_for_one_document_and_damage_is_seen():
    frames = [(bytes([i]) * 8, {"place": 2 * i, "ids": [10 * i, 10 * i + 1], "counts": [1, 1]}) for i in range(3)]
    data = tokens.pack_frames(frames)
    assert len(tokens.seek_table(data)) == 4
    got = list(tokens.read_documents(data, {3}))
    assert [(e["doc_id"], v.tolist()) for e, v in got] == [(11, [0x01010101])]
    first = tokens.seek_table(data)[0][0]
    broken = data[: first // 2] + bytes([data[first // 2] ^ 255]) + data[first // 2 + 1 :]
    with pytest.raises(Exception):
        list(tokens.read_documents(broken))
    assert len(list(tokens.read_documents(broken, {4, 5}))) == 2  # the other frames are not touched
    with pytest.raises(ValueError):
        tokens.seek_table(data[:-1])


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = tokens.write_token_files(documents(spark, []), scratch_path(spark, "t"), PATH)
    assert tokens.read_token_files(empty).count() == 0
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (None, None)], "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS file")
    rows = tokens.read_token_files(tokens.write_token_files(docs, scratch_path(spark, "t"), PATH)).collect()
    assert sorted(r.start for r in rows) == [0, 1, 3, 5] or sorted(r.start for r in rows) == [0, 2, 3, 5]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [None, None, 1, 1]


def test_query_equals_library(spark):
    docs = read("documents", "doc_id, text")
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_files"](spark, SF_DIR).orderBy("doc_id").collect()]
    assert got == [(d, *w) for (d, _), w in zip(docs, want([t for _, t in docs]))]


SPELLINGS = ["<|ENDOFTEXT|>", "a <|StartOfText|>b <|endoftext|> C", "X<|EndOfText|>x<|endoftext|>Y", "<|endofTEXT|>Ab ABC", "< |ENDOFTEXT|> <", "|><|", "ABC abc"]


def test_special_tokens_keep_their_spelling(spark):
    files = tokens.write_token_files(documents(spark, SPELLINGS), scratch_path(spark, "t"), PATH)
    got = [(r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_token_files(files).orderBy("doc_id").collect()]
    assert got == want(SPELLINGS)


def test_distinct_units_are_those_of_a_sort():
    values = np.random.default_rng(7).integers(0, 50, 400).astype(np.uint64)
    for part in (values, values[:1], values[:0]):
        keys, index, which = units._distinct(part)
        assert keys.tolist() == sorted(set(part.tolist())) and part[index].tolist() == keys.tolist() and keys[which].tolist() == part.tolist()
