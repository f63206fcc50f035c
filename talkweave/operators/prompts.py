"""Prompt assembly as array and string expressions; no Python touches a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wording as W
from ..functions.text import _col

MESSAGES = "array<struct<role:string,content:string>>"


def turn(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _one_line(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def codebook_entry(term: str = "term", definition: str = "definition", example: str = "example") -> Column:
    """``### Class / Definition / Example ###`` lines of one term; missing parts are skipped."""
    def part(head: str, c: Column) -> Column:
        return F.concat(F.lit(f"### {head}: "), _one_line(c), F.lit(" ###\n"))

    return F.concat_ws(
        "",
        F.concat(F.lit("### Class: "), F.col(term), F.lit(" ###\n")),
        part("Definition", F.col(definition)),
        part("Example", F.col(example)),
    )


def codebook_block(codebook: DataFrame, order: str = "term") -> DataFrame:
    """(class, block, classes): the formatted entries and the term list of each class.

    A codebook is a hand-written table, so gathering a class's terms into one text is bounded.
    """
    item = F.struct(F.col(order).alias("o"), codebook_entry().alias("entry"), F.col("term").alias("term"))
    rows = codebook.groupBy("class").agg(F.array_sort(F.collect_list(item)).alias("r"))
    return rows.select(
        "class",
        F.array_join(F.transform("r", lambda x: x["entry"]), "\n").alias("block"),
        F.transform("r", lambda x: x["term"]).alias("classes"),
    )


def system_text(
    block: Column,
    classes: Column,
    use_history: bool,
    context: Column | None = None,
) -> Column:
    """Role, optional passages, codebook, class list, optional hint at the history."""
    parts = [F.lit(W.ROLE)]
    if context is not None:
        parts += [F.lit("\n" + W.CONTEXT), F.array_join(F.transform(context, lambda d: F.concat(F.lit("\n"), d)), "")]
    parts += [
        F.lit("\n" + W.CODEBOOK_OPEN),
        block,
        F.lit(W.CODEBOOK_CLOSE + W.CLASSES_OPEN),
        F.array_join(classes, ", "),
        F.lit(W.CLASSES_CLOSE + W.OTHERWISE),
    ]
    if use_history:
        parts.append(F.lit("\n" + W.HISTORY))
    return F.concat(*parts)


def build_prompts(
    df: DataFrame,
    text: str,
    block: Column,
    classes: Column,
    style: str = "system",
    use_history: bool = True,
    use_past_labels: bool = True,
    history: str = "history",
    context: str | None = None,
    out: str = "prompt",
) -> DataFrame:
    """Chat messages per row.

    ``style='system'`` opens with a system turn and replays the history as turns.
    ``style='user'`` opens with a user turn and a fixed reply; without past labels the history is
    lines of the opening instead. ``block`` and ``classes`` are usually scalar subqueries.
    """
    if style not in ("system", "user"):
        raise ValueError(f"style {style!r}")
    if use_past_labels and not use_history:
        raise ValueError("past labels need the history")
    opening = system_text(block, classes, use_history, F.col(context) if context else None)
    past = F.col(history)
    if style == "user" and use_history and not use_past_labels:
        lines = F.array_join(F.transform(past, lambda h: h["text"]), "\n")
        opening = F.concat(opening, F.lit("\n"), lines)
    head = (
        F.array(turn("system", opening))
        if style == "system"
        else F.array(turn("user", opening), turn("assistant", W.READY))
    )
    parts = [head]
    if use_history and use_past_labels:
        parts.append(
            F.flatten(
                F.transform(
                    past,
                    lambda h: F.array(
                        turn("user", h["text"]),
                        turn(
                            "assistant",
                            F.concat(F.lit(W.ANSWER), F.coalesce(h["label"], F.lit("None"))),
                        ),
                    ),
                )
            )
        )
    elif use_history and style == "system":
        parts.append(F.transform(past, lambda h: turn("user", h["text"])))
    parts.append(F.array(turn("user", F.col(text))))
    return df.withColumn(out, F.concat(*[p.cast(MESSAGES) for p in parts]))


def with_answer(prompt: Column | str, label: Column | str) -> Column:
    """Append the coded class as the assistant's turn (training rows)."""
    return F.concat(
        _col(prompt),
        F.array(turn("assistant", F.concat(F.lit(W.ANSWER), _col(label)))).cast(MESSAGES),
    )


PLAIN_TEMPLATE = {
    "begin": "",
    "roles": {"system": ("<system>", "</system>"), "user": ("<user>", "</user>"), "assistant": ("<assistant>", "</assistant>")},
    "generate": "",
}


def render_chat(
    prompt: Column | str,
    template: Mapping = PLAIN_TEMPLATE,
    eos: tuple[str, str] | None = None,
    generate: bool = False,
) -> Column:
    """Messages as one string; ``template`` gives what stands before and after each role's text.

    ``eos=(old, new)`` replaces an end mark; ``generate`` adds the opening of the answer.
    """
    def one(m: Column) -> Column:
        out = m["content"]
        for role, (before, after) in template["roles"].items():
            out = F.when(m["role"] == role, F.concat(F.lit(before), m["content"], F.lit(after))).otherwise(out)
        return out

    text = F.concat(F.lit(template["begin"]), F.array_join(F.transform(_col(prompt), one), ""))
    if generate:
        text = F.concat(text, F.lit(template["generate"]))
    return F.replace(text, F.lit(eos[0]), F.lit(eos[1])) if eos else text


def ensemble_prompt(prompt: Column | str, runs: Sequence[str]) -> Column:
    """Turn a prompt into a question about several runs' answers (one column per run)."""
    prompt = _col(prompt)
    first = F.get(prompt, F.lit(0))
    rest_of_opening = F.regexp_replace(first["content"], r"\A[^\n]*\n?", "")
    opening = F.struct(
        first["role"].alias("role"), F.concat(F.lit(W.ENSEMBLE_ROLE), rest_of_opening).alias("content")
    )
    a, b, c = W.EXPERT_LINE
    experts = [
        F.concat(F.lit(a + r + b), F.coalesce(F.col(r), F.lit("None")), F.lit(c)) for r in runs
    ]
    ask = F.concat(F.lit(W.ENSEMBLE_OPEN), *experts, F.lit(W.ENSEMBLE_CLOSE))
    return F.concat(
        F.array(opening).cast(MESSAGES),
        F.slice(prompt, F.lit(2), F.greatest(F.size(prompt) - 1, F.lit(0))),
        F.array(turn("assistant", W.ENSEMBLE_ASK), turn("user", ask)).cast(MESSAGES),
    )


def explain_prompt(prompt: Column | str, label: Column | str) -> Column:
    """The prompt with the model's answer and a request to explain it."""
    return F.concat(
        with_answer(prompt, label), F.array(turn("user", W.EXPLAIN)).cast(MESSAGES)
    )


def fewshot_block(
    examples: DataFrame, text: str, label: str, order: Sequence[str]
) -> DataFrame:
    """One text of ``message // label`` lines. Give it the few rows of ``first_n_per_class``."""
    line = F.concat(F.lit("\n\n"), F.col(text), F.lit(" // "), F.col(label))
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("line"))))
    return examples.agg(F.array_join(F.transform(rows, lambda x: x["line"]), "").alias("examples"))


def fewshot_request(text: Column | str) -> Column:
    return F.concat(F.lit(W.FEWSHOT_REQUEST), _col(text))
