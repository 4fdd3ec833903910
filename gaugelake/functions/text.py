"""Trigram similarity of short names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(c: Column) -> Column:
    """Distinct trigrams: lower case, words of letters and digits, each padded '  word '."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two trigram arrays; 0 if both are empty."""
    total = F.size(F.array_union(a, b))
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(total, F.lit(0)), F.lit(0.0))
