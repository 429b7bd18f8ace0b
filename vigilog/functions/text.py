"""Text helpers on Columns.

``recast`` runs a regular expression once per row and keeps all of its groups,
where a ``regexp_extract`` per group would run it once per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a line is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Regex classes for the same characters; FLAGS makes them Unicode-aware and
# lets "." match everything but a line feed. Members of a class are tried in order, and
# the Unicode property behind \s is slow, so what most characters are comes first.
FLAGS = "(?Ud)"
S = r"[ \s\x1c-\x1f]"
NS = r"[!-~[^\s\x1c-\x1f]]"

# Counts as white space, so no group built from NS, \w or \d can contain it.
_SEP = "\x1f"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space (``trim`` alone removes only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def recast(text: Column, pattern: str, order: tuple[int, ...], *, tag: str = "", anchored: bool = False) -> Column:
    """``text`` rewritten to separator, tag and groups if ``pattern`` matches, else unchanged.

    The leftmost match counts, or with ``anchored`` only one at the start. Group
    number 0 in ``order`` stands for an empty field. Only the last field may hold
    arbitrary characters; the others must not be able to match white space.

    A text already rewritten matches no further pattern, so calls can be nested:
    the innermost pattern that matches wins and each runs once. ``text`` must not
    begin with white space, which makes the leading separator a reliable mark.
    """
    lead = "" if anchored else "(?s:.*?)"
    whole = f"{FLAGS}^(?!{_SEP}){lead}{pattern}(?s:.*)\\z"
    fields = "".join(_SEP + (f"${g}" if g else "") for g in order)
    return F.regexp_replace(text, whole, _SEP + tag + fields)


def is_recast(text: Column) -> Column:
    return text.startswith(_SEP)


def fields_of(text: Column, count: int) -> Column:
    """``['', tag, field, …]`` of a rewritten text; NULL if it was left unchanged."""
    return F.when(is_recast(text), F.split(text, _SEP, count + 2))


def joined(*parts: str) -> str:
    """Fixed fields of a rewritten text."""
    return _SEP.join(parts)


def tagged(*parts: Column) -> Column:
    """A text in the rewritten form, NULL if a part is: tag and fields."""
    return F.concat(*[c for part in parts for c in (F.lit(_SEP), part)])


def blank_to_dash(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("-"))


def any_of(text: Column, needles: tuple[str, ...]) -> Column:
    """True when ``text`` contains one of the needles."""
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return found
