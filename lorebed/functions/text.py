"""Text functions with Python's notion of white space and case."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's white space, written out for Java's regular expressions, whose own class of all of Unicode is several times slower.
SPACE = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: The same behind a range that visible ASCII characters fail at once.
_QUICK = r"[\x00- \x7f-\uffff&&" + SPACE + "]"
_ODD_SPACE = r"[\x00-\x1f\x7f-\uffff&&" + SPACE + "]"


def strip(c: Column) -> Column:
    """As str.strip(); null stays null."""
    return F.btrim(c, F.lit(_SPACES))


def collapse(c: Column) -> Column:
    """Runs of white space become one space; a single space, which most are, isn't touched."""
    return F.regexp_replace(c, f"{_QUICK}{{2,}}+|{_ODD_SPACE}", " ")


@cache
def _folding() -> tuple[str, str, dict[str, str], str]:
    """From all of Unicode: characters that fold to one other and what they fold to, those that fold to several, and a class of ranges beyond Latin-1 that hold
    every letter whose folded or lower form isn't itself."""
    cased = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF and (c.casefold() != c or c.lower() != c)]
    one = [c for c in cased if len(c.casefold()) == 1]
    many = {c: c.casefold() for c in cased if len(c.casefold()) > 1}
    ranges: list[list[int]] = []
    for at in (ord(c) for c in cased if ord(c) > 0xFF):
        # Letters near to cased ones may be cased in a younger version of Unicode; to fold them slowly does no harm.
        if ranges and at - ranges[-1][1] <= 256:
            ranges[-1][1] = at
        else:
            ranges.append([at, at])
    odd = "".join(f"\\x{{{a:x}}}-\\x{{{b + 256 * (b > 0xFFFF):x}}}" for a, b in ranges)
    return "".join(one), "".join(c.casefold() for c in one), many, f"[\\x{{100}}-\\x{{{sys.maxunicode:x}}}&&[{odd}]]"


def casefold(c: Column) -> Column:
    """str.casefold(), natively. Texts of ASCII and Latin-1 alone are lowered, and ``ß`` and ``µ`` replaced; others are folded character by character."""
    one, to, many, odd = _folding()
    western = F.replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), F.lit("µ"), F.lit("μ"))
    translated = F.translate(c, one, to)
    # One literal, as hundreds of them take seconds to plan: each letter with what it folds to behind it.
    pairs = F.split(F.lit("\n".join(a + b for a, b in many.items())), "\n")
    every = F.aggregate(pairs, translated, lambda text, p: F.replace(text, F.substring(p, 1, 1), F.substr(p, F.lit(2))))
    full = F.when(translated.rlike(f"[\\x{{80}}-\\x{{{sys.maxunicode:x}}}&&[{''.join(many)}]]"), every).otherwise(translated)
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).when(c.rlike(odd), full).otherwise(western)


def fold_spaces(c: Column) -> Column:
    """White space collapsed and stripped, case folded; null is empty."""
    return casefold(F.trim(collapse(F.coalesce(c, F.lit("")))))


def content_hash(c: Column) -> Column:
    """The sha1 of the folded text: equal for texts that differ in case and white space only."""
    return F.sha1(fold_spaces(c))


def page_id(number: Column) -> Column:
    """page_000042; longer numbers keep all digits."""
    return F.format_string("page_%06d", number)


def slug(c: Column, length: int = 60) -> Column:
    """Lower case, other runs than a-z0-9 as one dash, cut without a dash at either end."""
    dashed = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(dashed, 1, length), "-+$", "")


def truthy(c: Column) -> Column:
    """A flag cell: true for ``true`` in any case with white space around it."""
    return F.coalesce(F.lower(strip(c)) == "true", F.lit(False))


def env_flag(c: Column) -> Column:
    return F.lower(strip(c)).isin("1", "true", "yes", "on")


def or_default(c: Column, default: str) -> Column:
    """The value, or the default for null and the empty text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def word_count(c: Column) -> Column:
    folded = F.trim(collapse(F.coalesce(c, F.lit(""))))
    return F.when(folded == "", 0).otherwise(F.size(F.split(folded, " ")))


def prefix(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)
