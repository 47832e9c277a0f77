"""Character trigrams of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import after


def fold_letters(text: Column) -> Column:
    """Lower case, with every run of characters other than letters as one ``_``."""
    return F.regexp_replace(F.concat(F.lit("_"), F.lower(text), F.lit("_")), r"\P{L}++", "_")


def ngrams(text: Column, n: int = 3) -> Column:
    """All n-grams of the folded text.

    Cutting the text at n offsets keeps the work linear in its length, where taking one
    substring per position would rescan the text for each of them.
    """
    folded = fold_letters(text)
    cuts = [
        F.regexp_extract_all(after(folded, i), F.lit(f".{{{n}}}"), F.lit(0))
        for i in range(n)
    ]
    return F.flatten(F.array(*cuts))
