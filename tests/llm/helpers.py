"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import re

import duckdb

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, start=0):
    rows = [(start + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def read(name, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet' ORDER BY 1").fetchall()
