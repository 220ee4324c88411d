"""Text helpers: phone masking and keyword matching over analysed tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mask keeps the first 4 characters and appends 7 asterisks.
PHONE_KEEP = 4
PHONE_MASK = "*******"

# Token rule: every Han character is its own token; other runs of letters and
# digits form one token. Text is lower-cased first.
TOKEN_PATTERN = r"(\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_phone(tel: Column | str) -> Column:
    """First 4 characters followed by 7 asterisks; null stays null."""
    t = _col(tel)
    return F.concat(F.substring(t, 1, PHONE_KEEP), F.lit(PHONE_MASK))


def search_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), 1)


def match_all(text: Column | str, keyword: str | None) -> Column:
    """True when every keyword token occurs in ``text``.

    An empty or missing keyword means "no text filter" (always true).
    """
    if keyword is None or not keyword.strip():
        return F.lit(True)
    q = search_tokens(F.lit(keyword))
    return (F.size(q) > 0) & (F.size(F.array_except(q, search_tokens(text))) == 0)


def match_any(text: Column | str, keyword: str | None) -> Column:
    """True when at least one keyword token occurs in ``text``."""
    if keyword is None or not keyword.strip():
        return F.lit(True)
    return F.arrays_overlap(search_tokens(text), search_tokens(F.lit(keyword)))
