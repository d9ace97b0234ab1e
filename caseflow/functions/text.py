"""Text predicates and rewrites, as Column functions."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The characters Python counts as white space, which Java's and RE2's \s do not cover.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# The same set as a negated class both Java and RE2 read.
NON_SPACE = (
    r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

# Keywords that mark a message as urgent or escalating.
URGENT = ("urgent", "asap", "immediately", "now", "help")
ESCALATION = ("escalate", "manager", "complaint", "unacceptable")


def strip_links_and_tags(text: Column) -> Column:
    """Remove links, then mentions, then hashtags, ignoring case. Blanks around them stay.

    A plain substring test of the text comes first, since it is much cheaper than a pattern that finds
    nothing, and removing words brings in no new lead.
    """
    cleaned = text
    for lead, present in (
            ("http", F.lower(text).contains("http")), ("@", text.contains("@")),
            ("#", text.contains("#"))):
        removed = F.regexp_replace(cleaned, f"(?i){lead}{NON_SPACE}+", "")
        cleaned = F.when(present, removed).otherwise(cleaned)
    return cleaned


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def contains_any(text: Column, words) -> Column:
    """True when the lower-cased text holds one of the words as a substring; NULL text is false."""
    lowered = F.lower(text)
    return F.coalesce(reduce(or_, [lowered.contains(word) for word in words]), F.lit(False))


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", F.round(value, 1))
