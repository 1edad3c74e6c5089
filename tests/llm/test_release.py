import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm import sentencepieces as sp


class Table:
    """The part of a DataFrame that operators ask for; ``mapInArrow`` gives the function that a worker runs."""

    columns = ["text"]
    schema = T.StructType([T.StructField("text", T.StringType())])

    def mapInArrow(self, run, schema):
        return run


def held():
    """MB of this process."""
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def littered(kept):
    """Takes and frees 160 MB in pieces too small to go back by themselves, below one that stays."""
    parts = [np.ones(10_000) for _ in range(2_000)]
    kept.append(np.ones(10_000))
    return len(parts)


def grown(run, batch):
    before = held()
    assert sum(b.num_rows for b in run(iter([batch]))) == batch.num_rows
    return held() - before


def test_a_worker_keeps_no_free_memory(monkeypatch):
    batch, kept = pa.RecordBatch.from_pydict({"text": ["a b", None]}), []

    def build(batch):
        littered(kept)
        return [pa.nulls(batch.num_rows, pa.int32())]

    arrays.release()  # what earlier tests left
    assert grown(arrays.add_columns(Table(), build, [T.StructField("n", T.IntegerType())]), batch) < 40
    path, encode = public_tokenizers.path(sp.MODEL), sp.encode_texts
    encode(batch.column("text"), path)  # the model stays
    monkeypatch.setattr(sp, "encode_texts", lambda column, path: (littered(kept), encode(column, path))[1])
    arrays.release()
    assert grown(sp.encode_pieces(Table(), path), batch) < 40


def test_what_was_freed_before_a_task_goes_as_well():
    kept, seen = [], []

    def run(batches):
        seen.append(held())
        yield from batches

    littered(kept)
    before = held()
    list(arrays.released(run)(iter([])))
    assert before - seen[0] > 100
