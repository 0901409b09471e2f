"""Length in tokens, and texts cut to a number of tokens.

A token is a run of non-space characters unless the caller brings a token function: an
Arrow UDF from text to array<string>, pieces that are the text again when joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.constants import MAX_SEQ_LENGTH, TOKENIZER_LIMIT_CEILING

TokenFunction = Callable[[Column], Column]


def whitespace_tokens(text: Column) -> Column:
    """Splitting at each space and dropping the empty pieces beats matching the runs between."""
    return F.array_remove(F.split(text, r"\s"), "")


def resolved_limit(model_limit: Column) -> Column:
    """The model's own limit where it has a real one, else the default length."""
    usable = model_limit.isNotNull() & (model_limit < TOKENIZER_LIMIT_CEILING)
    return F.when(usable, model_limit).otherwise(F.lit(MAX_SEQ_LENGTH)).cast("int")


def token_count(text: Column, tokens: TokenFunction = whitespace_tokens) -> Column:
    """How many tokens a text has; a null text has none."""
    return F.coalesce(F.size(tokens(text)), F.lit(0)).cast("bigint")


def whitespace_pieces(text: Column) -> Column:
    """The tokens, each with the white space before it: joined they are the text up to its last token."""
    return F.regexp_extract_all(text, F.lit(r"\s*\S+"), F.lit(0))


def head_tokens(text: Column, pieces: Column, limit: Column) -> Column:
    """The text up to the end of its first tokens."""
    return F.array_join(F.slice(pieces, F.lit(1), limit), "")


def tail_tokens(text: Column, pieces: Column, limit: Column) -> Column:
    """The text from the start of its last tokens, with the white space at its end.

    A shorter array stays whole (a negative slice start would empty it).
    """
    last = F.slice(pieces, F.greatest(F.size(pieces) - limit + 1, F.lit(1)), F.greatest(limit, F.lit(0)))
    behind = F.substring(text, F.length(F.array_join(pieces, "")) + 1, F.length(text))
    return F.concat(F.regexp_replace(F.array_join(last, ""), r"^\s+", ""), behind)
