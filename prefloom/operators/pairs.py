"""From raw transcripts to valid preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefloom.functions import text as X
from prefloom.operators.ordering import ordered_head


def with_both_texts(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("chosen").isNotNull() & F.col("rejected").isNotNull())


def parse_pairs(raw: DataFrame, marker: str = X.TURN_MARKER) -> DataFrame:
    """Split both transcripts into prompt and response; the prompt is the chosen side's."""
    edged = with_both_texts(raw).withColumns(
        {"chosen": X.strip("chosen"), "rejected": X.strip("rejected")})
    return edged.select(
        *[c for c in raw.columns if c not in ("chosen", "rejected")],
        X.first_turn(F.col("chosen"), marker).alias("prompt"),
        X.after_first_turn(F.col("chosen"), marker).alias("chosen"),
        X.after_first_turn(F.col("rejected"), marker).alias("rejected"),
    )


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """Drop pairs whose responses are equal or empty."""
    c, r = F.col("chosen"), F.col("rejected")
    return pairs.where((c != r) & (c != "") & (r != ""))


def clean_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({c: X.clean_text(c) for c in ("prompt", "chosen", "rejected")})


def prepare_pairs(
    raw: DataFrame, limit: int | None = 1000, clean: bool = False, marker: str = X.TURN_MARKER
) -> DataFrame:
    """Subset, parse, filter, then clean: in this order, as each step sees the rows of the one before."""
    subset = raw if limit is None else ordered_head(raw, "pair_id", limit)
    pairs = valid_pairs(parse_pairs(subset, marker))
    return clean_pairs(pairs) if clean else pairs


def with_prompt(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    return df.where(F.col(prompt).isNotNull())


def pair_texts(pairs: DataFrame, include_prompt: bool = True, sep: str = " ") -> DataFrame:
    """The two texts to score: with the prompt in front, or the responses alone."""
    chosen, rejected = X.default_text("chosen"), X.default_text("rejected")
    if include_prompt:
        chosen, rejected = X.compose("prompt", chosen, sep), X.compose("prompt", rejected, sep)
    return pairs.withColumns({"chosen_text": chosen, "rejected_text": rejected})


def clean_replies(df: DataFrame, pick: str, prompt: str = "prompt", reply: str = "reply") -> DataFrame:
    """Raw generated text to the final reply: cut artifacts, replace broken ones."""
    cleaned = df.withColumn("cleaned", X.clean_reply(reply, X.generation_prompt(prompt)))
    flagged = cleaned.withColumn("broken", X.is_broken("cleaned"))
    return flagged.withColumn("response", X.with_fallback("cleaned", F.col("broken"), F.col(pick)))
