"""Base forms by suffix rules, for words that no list has.

A rule is a pattern whose first group is the stem, and the ending that the base form has in place of the suffix. The first
rule that fits decides; words that only look inflected are kept. Patterns hold no look-arounds or back references, so that
any SQL engine reads them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]

# Words that end like an inflected form and are none.
KEPT: frozenset[str] = frozenset(
    """
    always anything asked bed bias bored bus canvas ceiling christmas chaos embed evening everything gas hundred interesting lens
    morning news nothing perhaps plus sacred series something species status thing unless various wedding yes
    """.split()
)

RULES: tuple[Rule, ...] = (
    (r"^(.*(?:ss|us|is))$", ""),
    (r"^([a-z]*(?:ss|x|ch|sh|zz))es$", ""),
    (r"^([a-z]{2,})ies$", "y"),
    (r"^([a-z]{2,}[^su])s$", ""),
    (r"^([a-z]{2,})ied$", "y"),
    (r"^([a-z]{2,})ie(?:r|st)$", "y"),
    # a doubled consonant after a vowel was doubled by the suffix
    *((rf"^([a-z]*[aeiouy]{c}){c}(?:ing|ed)$", "") for c in "bdgmnprt"),
    # stems that lost their last e
    (r"^([a-z]*[aeiouy][a-z]*(?:[bcdfghklmnprstvwz]at|iz|[aeiourl]v|[aeiou]c|nc|rc|dg|rg|bl|pl|tl|[aeiou]g|[aeiou]us|u))(?:ing|ed)$", "e"),
    (r"^((?:[a-z]*[bcdfgklmnprstvwz])?[aiou][klmsz])(?:ing|ed)$", "e"),
    (r"^([a-z]*[aeiouy][a-z]*[a-z])ing$", ""),
    (r"^([a-z]*[aeiouy][a-z]*[^e])ed$", ""),
)


# For each rule the endings of which a word has one if the rule's pattern fits.
ENDS: tuple[tuple[str, ...], ...] = (
    ("ss", "us", "is"),
    ("es",),
    ("ies",),
    ("s",),
    ("ied",),
    ("ier", "iest"),
    *((f"{c}{c}ing", f"{c}{c}ed") for c in "bdgmnprt"),
    ("ing", "ed"),
    ("ing", "ed"),
    ("ing",),
    ("ed",),
)


def _ends(word: Column, ends: Iterable[str]) -> Column:
    return reduce(Column.__or__, [word.endswith(end) for end in sorted(ends)])


def base_form(word: Column, rules: Sequence[Rule] = RULES, kept: frozenset[str] = KEPT, ends: Sequence[Sequence[str]] | None = None) -> Column:
    """The word's base form by the first rule that fits; a word that none fits, or that is kept, stays. Null stays null.

    A pattern is tried only on words with one of the rule's `ends`, which most words do not have; other rules than the
    given ones may come without.
    """
    ends = ENDS if ends is None and rules is RULES else ends

    def with_rule(rest: Column, i: int) -> Column:
        pattern, ending = rules[i]
        fits = word.rlike(pattern) if ends is None else _ends(word, ends[i]) & word.rlike(pattern)
        return F.when(fits, F.concat(F.regexp_extract(word, pattern, 1), F.lit(ending))).otherwise(rest)

    found = F.when(word.isin(sorted(kept)), word).otherwise(reduce(with_rule, reversed(range(len(rules))), word))
    if ends is None:
        return found
    every = {end for some in ends for end in some}
    return F.when(_ends(word, {end for end in every if not any(end != other and end.endswith(other) for other in every)}), found).otherwise(word)
