"""Label maps of metric samples. Maps cannot be grouped or joined on; their text can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_text(labels: Column, escape: bool = False) -> Column:
    """``k="v",...`` with keys in order. Values are written as they are unless ``escape``."""

    def pair(entry: Column) -> Column:
        value = entry["value"]
        if escape:
            value = F.replace(value, F.lit("\\"), F.lit("\\\\"))
            value = F.replace(value, F.lit('"'), F.lit('\\"'))
            value = F.replace(value, F.lit("\n"), F.lit("\\n"))
        return F.concat(entry["key"], F.lit('="'), value, F.lit('"'))

    return F.concat_ws(",", F.transform(F.array_sort(F.map_entries(labels)), pair))
