"""Corpus preparation: clean, drop empty, tokenise (entry A of the study)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.functions import text as T


def keep_where(value: Column, pred) -> Column:
    """Generator column: one row with ``value`` if ``pred(value)`` holds, else
    none.  Used instead of a Filter on a computed column: Catalyst pushes a
    Filter below the Project that computes the column by inlining the
    expression into the condition, so an expensive expression (the cleaner)
    would run once per reference plus once in the Project.  Here it runs once."""
    return F.explode(F.filter(F.array(value), pred))


def clean_corpus(raw: DataFrame, text_col: str = "text", compat: bool = True,
                 drop_empty: bool = True) -> DataFrame:
    """T9 over a text column, then P7 (drop null / blank / NA-literal texts)."""
    cleaned = T.clean_text(text_col, compat=compat)
    if drop_empty:
        cleaned = keep_where(cleaned, lambda t: ~T.is_empty_text(t))
    return raw.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in raw.columns])


def explode_tokens(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("row_id", "target"),
                   term_col: str = "term") -> DataFrame:
    """One row per token of an already cleaned (single-space separated) text."""
    return df.select(*keep, F.explode(F.split(F.col(text_col), " ")).alias(term_col))


def explode_positions(df: DataFrame, tokens_col: str, keep: tuple[str, ...] = ("row_id",),
                      pos_col: str = "pos", term_col: str = "term") -> DataFrame:
    """``posexplode`` of a token array: ``(keep..., pos, term)``."""
    return df.select(*keep, F.posexplode(F.col(tokens_col)).alias(pos_col, term_col))
