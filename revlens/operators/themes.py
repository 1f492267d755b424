"""Rule-based themes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.vocab import NO_THEME, THEME_RULES


def themes_of_text(text: Column | str, rules: Mapping[str, str] = THEME_RULES, default: str = NO_THEME) -> Column:
    """The sorted themes whose substring occurs in a text in any case, else the default theme.

    The rules travel as literals, so matching stays inside the row.
    """
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    hits: dict[str, Column] = {}
    for part, theme in rules.items():
        found = F.contains(lowered, F.lit(part))
        hits[theme] = hits[theme] | found if theme in hits else found
    # Sorted and distinct by construction; an empty string marks a theme that is not there.
    marked = F.array(*[F.when(hits[theme], theme).otherwise("") for theme in sorted(hits)])
    themes = F.array_remove(marked, "")
    return F.when(F.size(themes) > 0, themes).otherwise(F.array(F.lit(default)))


def assign_themes(keywords: Column | str, rules: Mapping[str, str] = THEME_RULES, default: str = NO_THEME) -> Column:
    """The themes of a keyword list. The line break keeps a rule from matching across two keywords."""
    words = F.col(keywords) if isinstance(keywords, str) else keywords
    return themes_of_text(F.array_join(words, "\n"), rules, default)


def add_themes(df: DataFrame, keywords: str = "keywords", out: str = "themes") -> DataFrame:
    return df.withColumn(out, assign_themes(keywords))
