"""Cleaned messages to prompts, context and scored labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import argmax_label, as_class, find_first, parse_delimited
from ..functions.text import combine_fields, retrieval_query
from ..operators import ordered, prompts, retrieval, scoring, splits
from ..operators.evaluate import classification_report
from ..operators.blocks import AUTO, Block
from ..operators.explore import first_n_per_class
from ..operators.joins import attach_context, exclude_examples
from ..session import written
from ..sources.tables import spread


def retrieve_context(
    messages: DataFrame,
    texts: DataFrame,
    key: str,
    text: str,
    order: Sequence[str],
    within: Sequence[str],
    embed: Callable[[DataFrame, str], DataFrame],
    k: int = 5,
    history: int = 6,
    recursive: bool = True,
    block: Block = AUTO,
) -> DataFrame:
    """Long context table ``(key, rank, distance, text)``: nearest passages of ``texts(doc_id,text)``.

    ``embed(df, column)`` adds an ``embedding`` column and is used once for queries and once for passages:
    both are written to the shared folder before they are measured and searched.
    """
    cut = retrieval.chunk_recursive if recursive else retrieval.chunk_fixed
    chunks = cut(spread(texts.select("doc_id", "text"), "doc_id"), "text")
    ident = F.concat_ws(":", "doc_id", "chunk_no")
    passages = written(embed(chunks.select(ident.alias("vec_id"), "chunk"), "chunk"), "passages")
    asked = ordered.history(messages, text, order, within, history, block=block)
    lines = F.transform("history", lambda h: h["text"])
    asked = asked.select(F.col(key).alias("query_id"), retrieval_query(lines, text).alias("query"))
    queries = written(embed(asked, "query").drop("query"), "queries")
    found = retrieval.top_k(queries, passages, k)
    return found.join(passages.select("vec_id", "chunk"), "vec_id").select(
        F.col("query_id").alias(key), "rank", "distance", F.col("chunk").alias("text")
    )


def coding_prompts(
    messages: DataFrame,
    codebook: DataFrame,
    class_name: str,
    label: str,
    key: str,
    order: Sequence[str],
    within: Sequence[str],
    run_keys: Sequence[str] = (),
    text: str = "message",
    fields: Sequence[str] = (),
    separator: str = ": ",
    window: int = 6,
    style: str = "user",
    use_history: bool = True,
    use_past_labels: bool = True,
    context: DataFrame | None = None,
    num_docs: int = 2,
    drop_unlabelled: bool = False,
    seed: int = 42,
    block: Block = AUTO,
) -> DataFrame:
    """``(key, prompt, label, split)``: one prompt per message and a stratified split."""
    # on the narrow rows, before history and prompts widen them; unlabelled messages are a class
    # of their own here and stay in the histories of others even if dropped below
    messages = splits.stratified_split(messages, key, label, seed=seed)
    if fields:
        messages = messages.withColumn(text, combine_fields(fields, separator))
    if use_history:
        look = ordered.label_history if use_past_labels else ordered.history
        extra = {"label": label} if use_past_labels else {}
        messages = look(
            messages, text=text, order=order, within=within, k=window, run_keys=run_keys,
            block=block, **extra,
        )
    if context is not None:
        messages = attach_context(messages, context, key, num_docs)
    blocks = prompts.codebook_block(codebook.filter(F.col("class") == class_name))
    built = prompts.build_prompts(
        messages,
        text,
        blocks.select("block").scalar(),
        blocks.select("classes").scalar(),
        style=style,
        use_history=use_history,
        use_past_labels=use_past_labels,
        context="context" if context is not None else None,
    )
    if drop_unlabelled:
        built = built.filter(F.col(label).isNotNull())
    return built.select(key, "prompt", as_class(label).alias("label"), "split")


def scored_labels(
    df: DataFrame,
    make: Callable[[], scoring.Scorer],
    classes: Sequence[str],
    text: Column | str = "prompt",
    out: str = "predicted",
) -> DataFrame:
    """Run a model over rendered prompts and read a class off its answers."""
    answered = scoring.score(df, text, make, out="response")
    return answered.withColumn(out, find_first("response", classes))


def zero_shot(
    df: DataFrame, text: Column | str, make: Callable[[], scoring.Scorer], classes: Sequence[str], out: str = "predicted"
) -> DataFrame:
    """The class that a model scoring all ``classes`` at once puts first."""
    scored = scoring.score(df, text, make, "array<double>", "__scores")
    return scored.withColumn(out, argmax_label("__scores", classes)).drop("__scores")


def few_shot(
    df: DataFrame,
    text: str,
    label: str,
    order: Sequence[str],
    make: Callable[[], scoring.Scorer],
    classes: Sequence[str],
    n: int = 2,
    between: str = "",
    out: str = "predicted",
) -> DataFrame:
    """Ask a model about every message after ``n`` labelled examples of each class.

    The examples, a few rows, become one text in front of each request and are not asked about themselves.
    Answers are read at their mark. ``between`` stands between examples and request.
    """
    examples = first_n_per_class(df, label, order, n)
    shown = prompts.fewshot_block(examples, text, label, order).select("examples").scalar()
    asked = exclude_examples(df, examples, text)
    asked = asked.withColumn("__prompt", F.concat(shown, F.lit(between), F.col(text)))
    answered = scoring.score(asked, "__prompt", make, out="response").drop("__prompt")
    return answered.withColumn(out, parse_delimited("response", classes))


def report(df: DataFrame, truth: str = "label", predicted: str = "predicted") -> DataFrame:
    return classification_report(df, truth, predicted)
