"""Column functions over arrays of token ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prefloom.functions.text import words

# Fixed value: the label that the loss skips.
IGNORED_LABEL = -100


def token_texts(col: Column | str) -> Column:
    """Blank-separated tokens of a text."""
    return words(col)


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def pad(ids: Column, length: Column | int, pad_id: int = 0) -> Column:
    """Right-pad to ``length``; longer arrays stay as they are."""
    missing = F.greatest(_int(length) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def attention_mask(ids: Column, length: Column | int) -> Column:
    """1 for each token, 0 for each padded position up to ``length``."""
    missing = F.greatest(_int(length) - F.size(ids), F.lit(0))
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing))


def mask_from_pad(ids: Column, pad_id: int) -> Column:
    return F.transform(ids, lambda x: (x != pad_id).cast("int"))


def masked_length(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0), lambda acc, x: acc + x)


def response_ids(full_ids: Column, prompt_len: Column, eos_id: int | None) -> Column:
    """Tokens after the prompt and before the first end token; NULL if none is left."""
    start = F.greatest(prompt_len, F.lit(0)).cast("int")
    tail = F.slice(full_ids, start + 1, F.greatest(F.size(full_ids) - start, F.lit(0)))
    if eos_id is not None:
        at = F.array_position(tail, eos_id)
        tail = F.slice(tail, F.lit(1), F.when(at > 0, at - 1).otherwise(F.size(tail)).cast("int"))
    return F.when(F.size(tail) > 0, tail)


def response_distributions(distributions: Column, full_ids: Column, prompt_len: Column, eos_id: int | None) -> Column:
    """The distributions of the response tokens: a token is drawn from the place before it, so the slice starts one earlier.

    As long as the response ids; NULL where they are, or where no place is before them.
    """
    n = F.size(response_ids(full_ids, prompt_len, eos_id))
    return F.when((prompt_len > 0) & (n > 0), F.slice(distributions, prompt_len.cast("int"), n))


def _int(value: Column | int) -> Column:
    return value.cast("int") if isinstance(value, Column) else F.lit(int(value))
