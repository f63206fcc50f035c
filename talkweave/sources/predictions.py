"""Predictions of earlier runs: where they lie and what their names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _col
from .tables import write_table

RUN_COLUMNS = ("method", "class", "use_history", "use_past_labels", "use_context")


def run_suffix(
    class_name: str,
    use_history: bool = False,
    use_past_labels: bool = False,
    use_context: bool = False,
    extra: str | None = None,
) -> str:
    """Name part that tells a run's settings, e.g. ``_uptake_w_history_context``."""
    if use_past_labels and not use_history:
        raise ValueError("past labels need the history")
    flags = {"history": use_history, "past-labels": use_past_labels, "context": use_context}
    words = [w for w, on in flags.items() if on] + ([extra] if extra is not None else [])
    return "_".join(["", class_name.lower(), *(["w", *words] if words else [])])


def run_suffix_col(
    class_name: Column | str,
    use_history: Column | str,
    use_past_labels: Column | str,
    use_context: Column | str,
    extra: Column | str | None = None,
) -> Column:
    """:func:`run_suffix` over columns; NULL where past labels lack the history."""
    h, p, c = _col(use_history), _col(use_past_labels), _col(use_context)
    words = [F.when(h, "history"), F.when(h & p, "past-labels"), F.when(c, "context")]
    if extra is not None:
        words.append(_col(extra))
    tail = F.concat_ws("_", *words)
    any_word = F.coalesce(*[w for w in words]).isNotNull()
    name = F.concat(F.lit("_"), F.lower(_col(class_name)))
    full = F.when(any_word, F.concat(name, F.lit("_w_"), tail)).otherwise(name)
    return F.when(h | ~p, full)


def parse_run_name(name: Column | str) -> list[Column]:
    """Method, class and flags from a run's file name; NULL for a part it lacks."""
    base = F.regexp_replace(_col(name), r"\.[A-Za-z]+\z", "")
    parts = F.split(base, "_")
    return [
        F.get(parts, F.lit(0)).alias("method"),
        F.nullif(F.get(parts, F.lit(1)), F.lit("")).alias("class"),
        F.array_contains(parts, "history").alias("use_history"),
        F.array_contains(parts, "past-labels").alias("use_past_labels"),
        F.array_contains(parts, "context").alias("use_context"),
    ]


def load_predictions(preds: DataFrame, class_name: str) -> DataFrame:
    """All runs of one class, whatever the case of its name."""
    return preds.filter(F.lower("class") == class_name.lower())


def read_predictions(spark: SparkSession, path: str, class_name: str | None = None) -> DataFrame:
    """Stored long predictions; the class is a folder, so other classes are not read."""
    preds = spark.read.parquet(path)
    return preds if class_name is None else load_predictions(preds, class_name)


def write_predictions(preds: DataFrame, path: str, mode: str = "append") -> None:
    """Long predictions in folders by class and settings instead of settings in file names."""
    write_table(preds, path, RUN_COLUMNS[1:], mode=mode)


def read_runs(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """One table per run, each in a file or folder named by the run: its rows with what the name says.

    A run's name is the last part of the path that is not a writer's own part file; a ``name=`` in front of
    a folder's value is left off. Names are read from the files' metadata, so any number of runs is one scan.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", True).option("header", True)
    rows = (reader.schema(schema) if schema else reader).load(path)
    whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = F.regexp_replace(whole, r"/part-[^/]*$", "")
    return rows.select("*", *parse_run_name(F.regexp_extract(named, r"/(?:[^/=]+=)?([^/]+)$", 1)))
