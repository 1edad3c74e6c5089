"""Text outputs: metric exposition and report JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_text(exposition: DataFrame, path: str, one_file: bool = False) -> str:
    """Exposition lines as text files, in order if the files are read by name.

    ``one_file`` puts all lines through one task, for receivers that take a single body.
    """
    order = ["ord", "line_in_sample"]
    ranged = exposition.coalesce(1) if one_file else exposition.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order)
    ordered.select("line").write.mode("overwrite").text(path)
    return path


def write_dashboard_json(lines: DataFrame, path: str) -> str:
    """Report JSON as one folder per section, one object per line, in reading order."""
    ordered = lines.repartitionByRange("section", "sort_key").sortWithinPartitions("section", "sort_key")
    ordered.select("section", "json").write.mode("overwrite").partitionBy("section").text(path)
    return path
