"""Prompts and examples bounded to a number of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.constants import MAX_INPUT_TOKENS, MAX_SEQ_LENGTH, MESSAGES
from promptloom.functions.tokens import (
    TokenFunction,
    head_tokens,
    tail_tokens,
    token_count,
    whitespace_pieces,
    whitespace_tokens,
)


def validate_prompts(
    df: DataFrame,
    column: str = "prompt",
    max_tokens: int = MAX_INPUT_TOKENS,
    tokens: TokenFunction = whitespace_tokens,
) -> DataFrame:
    """The rows with `n_tokens` and `ok`, false where the prompt is over the limit."""
    return df.withColumn("n_tokens", token_count(F.col(column), tokens)).withColumn(
        "ok", F.col("n_tokens") <= max_tokens
    )


def require_valid_prompts(
    df: DataFrame,
    column: str = "prompt",
    max_tokens: int = MAX_INPUT_TOKENS,
    tokens: TokenFunction = whitespace_tokens,
) -> DataFrame:
    """The same rows; the job fails on the first prompt over the limit."""
    checked = validate_prompts(df, column, max_tokens, tokens)
    message = F.concat(
        F.lit("A prompt has "), F.col("n_tokens").cast("string"), F.lit(f" tokens, the limit is {max_tokens}")
    )
    passed = F.when(F.col("ok"), F.col(column)).otherwise(F.raise_error(message).cast("string"))
    return checked.withColumn(column, passed).drop("n_tokens", "ok")


def bound_examples(
    df: DataFrame,
    column: str = "text",
    max_tokens: int = MAX_SEQ_LENGTH,
    tokens: TokenFunction = whitespace_tokens,
) -> DataFrame:
    """Examples cut after their first tokens, with `was_truncated`."""
    return _bounded(df, column, F.lit(max_tokens), tokens, head_tokens).withColumnRenamed("_cut", "was_truncated")


def bound_prompts(
    df: DataFrame,
    column: str = "prompt",
    max_tokens: Column | int = MAX_SEQ_LENGTH,
    tokens: TokenFunction = whitespace_tokens,
) -> DataFrame:
    """Prompts cut before their last tokens."""
    limit = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    return _bounded(df, column, limit, tokens, tail_tokens).drop("_cut")


def bound_messages(
    df: DataFrame,
    column: str = MESSAGES,
    max_tokens: int = MAX_SEQ_LENGTH,
    tokens: TokenFunction = whitespace_tokens,
) -> DataFrame:
    """Chat examples cut to their first tokens, with `was_truncated`.

    Tokens are counted over the messages' contents in order. The message that reaches the limit
    is cut, those after it go; the layout around messages is not counted.
    """
    def taken(state: Column, message: Column) -> Column:
        content, left = message["content"], state["left"]
        found = pieces(content)
        size = F.coalesce(F.size(found), F.lit(0))
        cut = F.when(size > left, head_tokens(content, found, left)).otherwise(content)
        more = F.array(F.struct(message["role"].alias("role"), cut.alias("content")))
        return F.struct(
            F.greatest(left - size, F.lit(0)).alias("left"),
            (state["over"] | (size > left)).alias("over"),
            F.when(left > 0, F.concat(state["kept"], more)).otherwise(state["kept"]).alias("kept"),
        )

    pieces = whitespace_pieces if tokens is whitespace_tokens else tokens
    nothing = F.array().cast("array<struct<role: string, content: string>>")
    start = F.struct(F.lit(max_tokens).alias("left"), F.lit(False).alias("over"), nothing.alias("kept"))
    return (
        df.withColumn("_bound", F.aggregate(F.col(column), start, taken))
        .withColumn(column, F.col("_bound.kept"))
        .withColumn("was_truncated", F.col("_bound.over"))
        .drop("_bound")
    )


def _bounded(df: DataFrame, column: str, limit: Column, tokens: TokenFunction, side) -> DataFrame:
    """The column cut at one end, and `_cut`, whether it was. What is left of a text is as it was.

    More than n white-space tokens take more than 2n characters, so shorter texts, most of
    them at the usual limits, are passed through without being tokenised.
    """
    text, found = F.col(column), F.col("_pieces")
    white_space = tokens is whitespace_tokens
    pieces = F.when(F.length(text) > 2 * limit, whitespace_pieces(text)) if white_space else tokens(text)
    return (
        df.withColumn("_pieces", pieces)
        .withColumn("_cut", F.coalesce(F.size(found) > limit, F.lit(False)))
        .withColumn(column, F.when(F.col("_cut"), side(text, found, limit)).otherwise(text))
        .drop("_pieces")
    )
