"""Text expressions. All stay inside the JVM; none is a Python UDF."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions import presets

WORD_PATTERN = "^[a-z]{4,}$"


def split_words(text: Column) -> Column:
    """Lower-cased tokens of a text, cut at runs of whitespace."""
    return F.split(F.lower(F.trim(text)), r"\s+")


def strip(text: Column) -> Column:
    """Drop whitespace of any kind at both ends (`trim` drops blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def contains_ci(text: Column, keyword: str) -> Column:
    return F.lower(text).contains(keyword.lower())


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    return reduce(or_, (contains_ci(text, k) for k in keywords), F.lit(False))


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """How many of the keywords occur in the text; each counts once."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(add, (lowered.contains(k.lower()).cast("int") for k in keywords), F.lit(0))


def combined(title: Column, body: Column, sep: str = " ", skip: str = "blank") -> Column:
    """Title and body in one text.

    `skip` says when the separator and body are left out: "blank" (body empty or
    whitespace), "empty" (body empty), "never".
    """
    head, tail = F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))
    joined = F.concat(head, F.lit(sep), tail)
    if skip == "never":
        return joined
    if skip == "empty":
        return F.when(tail != "", joined).otherwise(head)
    if skip == "blank":
        return F.when(strip(tail) != "", joined).otherwise(head)
    raise ValueError(f"unknown skip rule {skip!r}")


def first_line(text: Column) -> Column:
    return F.coalesce(F.substring_index(text, "\n", 1), F.lit(""))


def title_tag(title: Column, expand: bool = False) -> Column:
    """First `[Letters]` group of the title, 'Unknown' if there is none."""
    tag = F.regexp_extract(F.coalesce(title, F.lit("")), r"\[([A-Za-z]+)\]", 1)
    if not expand:
        return F.when(tag == "", "Unknown").otherwise(tag)
    named = F.when(tag == "", "Unknown")
    for short, name in presets.TAG_NAMES.items():
        named = named.when(tag == short, name)
    return named.otherwise(tag)


def is_quality(
    text: Column,
    min_len: int = 30,
    patterns: Sequence[str] = tuple(presets.SPAM_PATTERNS),
) -> Column:
    """Long enough without `[...]` groups, and free of spam phrases; never null."""
    body = F.regexp_replace(text, r"(?d)\[.*?\]", "")
    long_enough = has_length(body, min_len)
    # Plain phrases are looked up in the lowered text, which is far cheaper than a
    # case-blind regex. Flag d: only \n ends a line, so a dot spans anything else.
    plain = [p for p in patterns if re.fullmatch(r"[\w ]+", p)]
    spam = contains_any(text, plain)
    for pattern in patterns:
        if pattern not in plain:
            spam = spam | text.rlike(f"(?iud){pattern}")
    return F.coalesce(long_enough & ~spam, F.lit(False))


def has_length(text: Column, n: int) -> Column:
    """Whether the text is `n` characters or longer without whitespace at its ends.

    Stops at the first end that is far enough instead of building the stripped text.
    """
    if n <= 0:
        return text.isNotNull()
    if n == 1:
        return text.rlike(r"(?U)\S")
    return text.rlike(rf"(?Us)\S.{{{n - 2}}}.*?\S")


def parsed_label(reply: Column, strict: bool = False, missing: int = -1) -> Column:
    """Class named in a labeller's reply: first digit 0-2, else class words, else 2.

    The strict form gives -2 when no digit is found. A null reply gives `missing`.
    """
    digit = F.regexp_extract(reply, "[012]", 0)
    label = F.when(reply.isNull(), missing).when(digit != "", digit.try_cast("int"))
    if strict:
        return label.otherwise(-2)
    for cls, words in presets.REPLY_WORDS.items():
        label = label.when(contains_any(reply, words), cls)
    return label.otherwise(2)


def prompt(text: Column, template: str, n: int, placeholder: str = "{text}") -> Column:
    """Template with the placeholder replaced by the first `n` characters of the text."""
    before, _, after = template.partition(placeholder)
    return F.concat(F.lit(before), F.substring(F.coalesce(text, F.lit("")), 1, n), F.lit(after))


def permalink(group: Column, key: Column, base: str = "https://www.reddit.com") -> Column:
    return F.concat(F.lit(f"{base}/"), group, F.lit("/comments/"), key.cast("string"))
