"""Row-local text expressions: Column in, Column out, no Python on the executors."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from revlens.functions.vocab import EMOJI_WORDS, LEMMAS, STOP_WORDS

# Word characters and white space spelled out by Unicode class: the Java shorthands are either
# ASCII-only or keep joiners and variation selectors.
NON_WORD = r"[^\p{L}\p{N}_\p{IsWhite_Space}]"
SPACES = r"[\p{IsWhite_Space}]+"
# The runs that are no single blank: most white space of a text is one and needs no replacement.
ODD_SPACES = r"[\p{IsWhite_Space}&&[^ ]][\p{IsWhite_Space}]*| [\p{IsWhite_Space}]+"
NON_SPACE = r"[^\p{IsWhite_Space}]"
EDGE_SPACES = r"^[\p{IsWhite_Space}]+|[\p{IsWhite_Space}]+$"
TOKEN = r"[\p{L}\p{N}_]{2,}"
EMOJI_BLOCKS = ((0x1F000, 0x1FAFF), (0x2600, 0x27BF), (0x2B00, 0x2BFF))
EMOJI = (
    r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}"
    r"\x{FE0F}\x{200D}\x{20E3}\x{E0020}-\x{E007F}]"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space; `F.trim` removes spaces only."""
    return F.regexp_replace(_col(c), EDGE_SPACES, "")


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), ODD_SPACES, " "))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-white-space text."""
    return ~F.coalesce(_col(c).rlike(NON_SPACE), F.lit(False))


def strip_punctuation(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), NON_WORD, "")


def head_chars(c: Column | str, n: int = 512) -> Column:
    """The first `n` characters: the input size of the sentiment scorer."""
    return F.substring(_col(c), 1, n)


def words(c: Column | str) -> Column:
    """Lower-cased words of two or more characters, in text order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN), F.lit(0))


def joined_words(c: Column | str) -> Column:
    """The words in one text with single spaces, to be written once and read by `split_words` in later passes."""
    return F.array_join(words(c), " ")


def joined_words_of_normal(c: Column | str) -> Column:
    """`joined_words` of a text that `normalise` made: its parts hold word characters only, so that their length tells."""
    return F.array_join(F.filter(F.split(_col(c), " "), lambda part: F.length(part) >= 2), " ")


def split_words(c: Column | str) -> Column:
    """The words of `joined_words`, NULL where there are none: no pattern is matched again."""
    return F.split(F.nullif(_col(c), F.lit("")), " ")


def each(values: Column) -> Column:
    """One row per array element and a NULL row for an empty array; filter on `IS NOT NULL` after it.

    A plain `explode` of a computed array makes Spark add a filter on the array's size, which
    computes the array a second time for every row.
    """
    return F.explode_outer(values)


def replace_emoji(c: Column | str, emoji_words: Mapping[str, str] | None = None) -> Column:
    """Put the word for each known emoji, drop the others, squeeze white space.

    Texts without any emoji only get their white space squeezed. The others are cut into emoji and
    the runs between them, so that one pass over the text serves the whole dictionary.
    """
    emoji_words = EMOJI_WORDS if emoji_words is None else emoji_words
    text = _col(c)
    if not _independent(emoji_words):
        for emoji, word in emoji_words.items():
            text = F.replace(text, F.lit(emoji), F.lit(word))
        return squeeze(F.regexp_replace(text, EMOJI, ""))
    known = "|".join(sorted(map(re.escape, emoji_words), key=len, reverse=True))
    pieces = F.regexp_extract_all(text, F.lit(f"{known}|{EMOJI}|{EMOJI.replace('[', '[^', 1)}+"), F.lit(0))
    table = F.create_map(*[F.lit(part) for pair in emoji_words.items() for part in pair])
    replaced = F.transform(
        pieces,
        lambda piece: F.when(piece.isin(list(emoji_words)), F.element_at(table, piece))
        .when(piece.rlike("^" + EMOJI), "")
        .otherwise(piece),
    )
    return squeeze(F.when(text.rlike(EMOJI), F.array_join(replaced, "")).otherwise(text))


def _independent(emoji_words: Mapping[str, str]) -> bool:
    """Whether replacing all entries at once equals replacing them one after the other.

    True when every key starts with an emoji and no character occurs in two keys, or in a key and a
    replacement.
    """
    used: set[str] = set("".join(emoji_words.values()))
    for key in emoji_words:
        if not key or used & set(key) or not any(low <= ord(key[0]) <= high for low, high in EMOJI_BLOCKS):
            return False
        used |= set(key)
    return bool(emoji_words)


def normalise(
    c: Column | str,
    stop_words: Sequence[str] = STOP_WORDS,
    lemmas: Mapping[str, str] = LEMMAS,
    otherwise: Callable[[Column], Column] = lambda word: word,
) -> Column:
    """Lower-case, strip punctuation, drop stop words, map words to their base form.

    Works inside the row: no token leaves its review, so nothing is shuffled. The membership
    tests become hash-set lookups, and only words known to have a base form consult the map; `otherwise`, for
    instance `lemmas.base_form`, gives the base form of all others.
    """
    tokens = F.split(strip_punctuation(F.lower(F.coalesce(_col(c), F.lit("")))), SPACES)
    kept = F.filter(tokens, lambda word: (word != "") & ~word.isin(list(stop_words)))
    if lemmas:
        table = F.create_map(*[F.lit(part) for pair in lemmas.items() for part in pair])
        kept = F.transform(
            kept,
            lambda word: F.when(word.isin(list(lemmas)), F.element_at(table, word)).otherwise(otherwise(word)),
        )
    else:
        kept = F.transform(kept, lambda word: otherwise(word))
    return F.array_join(kept, " ")


def percent_text(c: Column | str) -> Column:
    return F.format_string("%.2f%%", _col(c))
