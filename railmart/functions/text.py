"""Name cleaning, folding and matching."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmart import constants as C


# outer white space, as Unicode and the separators of ASCII have it; names without any are not looked at twice
WHITE_ENDS = r"^[\p{IsWhite_Space}\x1c-\x1f]+|[\p{IsWhite_Space}\x1c-\x1f]+$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def clean_station(name: Column) -> Column:
    """Drop one trailing '(XX)' or '[XX]' code and squeeze white space.

    Most names have neither, so the patterns are made to fail early on those: the code is only
    looked for behind a closing bracket, and single spaces are left as they are.
    """
    without_code = F.when(
        name.rlike(r"[)\]]\s*$"), F.regexp_replace(name, r"\s*[(\[][A-Z0-9]{2,5}[)\]]\s*$", "")
    ).otherwise(name)
    return F.trim(F.regexp_replace(without_code, r"\s{2,}|[\t\n\x0B\f\r]", " "))


def is_numeric_name(name: Column) -> Column:
    """Digits only; the first character is looked at before the pattern is."""
    return F.substring(name, 1, 1).between("0", "9") & name.rlike(r"^\d+$")


def _stripped(char: str) -> str:
    """Full decomposition without non-spacing marks."""
    return "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")


BLANKS = ("-_", "  ")  # read as spaces
MARKED = "\u0300"  # combining marks and all scripts beyond Latin letters start here


@lru_cache
def _fold_table() -> tuple[str, str, dict[str, str]]:
    """(from, to) for translate: accented letters to their base letter, the BLANKS, combining marks to nothing; and
    the few characters that decompose to several, which translate cannot say.

    Built by rule from all Unicode decompositions, Hangul syllables aside, which follow arithmetic.
    """
    letters, bases, marks, longer = [*BLANKS[0]], [*BLANKS[1]], [], {}
    for point in [*range(0x80, HANGUL[0]), *range(HANGUL[1] + 1, 0xD800), *range(0xE000, 0x110000)]:
        char = chr(point)
        base = _stripped(char)
        if unicodedata.category(char) == "Mn" and not base:
            marks.append(char)
        elif len(base) == 1 and base != char:
            letters.append(char)
            bases.append(base)
        elif len(base) > 1:
            longer[char] = base
    return "".join(letters + marks), "".join(bases), longer


@lru_cache
def _latin_fold_table() -> tuple[str, str]:
    """The part of the table below MARKED: no marks, nothing that decomposes to several characters."""
    source, target, longer = _fold_table()
    assert min(longer) >= MARKED
    pairs = [(c, t) for c, t in zip(source, target) if c < MARKED]
    return "".join(c for c, _ in pairs), "".join(t for _, t in pairs)


def _spans(chars: list[str], gap: int = 0x200) -> str:
    """A character class of few ranges that holds all of `chars`, and what lies in narrow gaps between them."""
    points, ranges = sorted(map(ord, chars)), []
    for point in points:
        if ranges and point - ranges[-1][1] <= gap:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


# Hangul syllables: 19 leading consonants times 21 vowels times 28 endings, one of them empty
HANGUL = (0xAC00, 0xD7A3)
LEADS, VOWELS, ENDS = (
    "".join(chr(first + i) for i in range(n)) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))
)


def _letters_of_syllables(text: Column) -> Column:
    def letters(char: Column) -> Column:
        place = F.ascii(char) - HANGUL[0]
        end = place % 28
        return F.when(
            char.between(chr(HANGUL[0]), chr(HANGUL[1])),
            F.concat(
                F.substr(F.lit(LEADS), F.floor(place / 588).cast("int") + 1, F.lit(1)),
                F.substr(F.lit(VOWELS), F.floor(place % 588 / 28).cast("int") + 1, F.lit(1)),
                F.when(end == 0, F.lit("")).otherwise(F.substr(F.lit(ENDS), end, F.lit(1))),
            ),
        ).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), letters), "")


def _fold_any_script(text: Column) -> Column:
    source, target, longer = _fold_table()
    whole = text
    for char, base in longer.items():
        whole = F.replace(whole, F.lit(char), F.lit(base))
    text = F.when(text.rlike(_spans([*longer])), whole).otherwise(text)
    text = F.when(text.rlike(f"[{chr(HANGUL[0])}-{chr(HANGUL[1])}]"), _letters_of_syllables(text)).otherwise(text)
    return F.translate(text, source, target)


def _without_white_ends(text: Column) -> Column:
    """Outer white space goes; the pattern only runs on a text whose first or last character is white."""
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return F.when(ends.rlike(WHITE_ENDS), F.regexp_replace(text, WHITE_ENDS, "")).otherwise(text)


def fold_name(name: Column) -> Column:
    """Upper-case key without accents; '-' and '_' are spaces; outer white space goes; NULL becomes the empty text.

    A text of Latin letters alone, told by one range test, takes one small table; the classes that need more
    (several letters for one, Hangul) are only looked for in the others.
    """
    text = F.coalesce(name, F.lit(""))
    plain = F.when(text.rlike(f"[{MARKED}-\\x{{10FFFF}}]"), _fold_any_script(text)).otherwise(
        F.translate(text, *_latin_fold_table())
    )
    return _without_white_ends(F.upper(plain))


def strip_name_prefix(folded: Column) -> Column:
    """Remove the first listed prefix that fits; prefixes are disjoint, so one pattern does it."""
    return F.regexp_replace(folded, "^(" + "|".join(C.NAME_PREFIXES) + ")", "")


def token_prefixes(folded: Column) -> Column:
    """All leading token runs, longest first: 'A B C' -> ['A B C', 'A B', 'A']."""
    tokens = F.filter(F.split(folded, r"[\p{IsWhite_Space}\x1c-\x1f]+"), lambda t: t != "")
    lengths = F.when(F.size(tokens) > 0, F.sequence(F.size(tokens), F.lit(1), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(lengths, lambda n: F.array_join(F.slice(tokens, F.lit(1), n), " "))


def prefix_candidates(folded: Column) -> Column:
    """Lookup keys in order of preference: whole name, its token runs, then the same without prefix."""
    bare = strip_name_prefix(folded)
    return F.array_distinct(
        F.concat(F.array(folded), token_prefixes(folded), F.array(bare), token_prefixes(bare))
    )


def file_safe(name: Column) -> Column:
    """Folder name: forbidden characters out, spaces to '_', 40 characters at most."""
    allowed = F.translate(name, '\\/*?:"<>|', "")
    return F.substring(F.trim(F.translate(allowed, " ", "_")), 1, 40)


def contains_ignore_case(text: Column, part: str, literal: bool = False) -> Column:
    """Case-blind substring test. `%` and `_` in `part` are wildcards unless `literal`."""
    if literal:
        return F.contains(F.lower(text), F.lower(F.lit(part)))
    return text.ilike(f"%{part}%")


def matches(text: Column, pattern: str) -> Column:
    """Regex test that is false on NULL."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


