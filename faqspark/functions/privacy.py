"""Masking of personal data, before any model or index sees a text."""

from __future__ import annotations

from functools import reduce
from hashlib import sha256
from operator import or_

from pyspark.sql import Column, functions as F

from faqspark.functions.arrays import let

# Patterns and masks, applied in this order.
FILE_URL = r"<?https?://files\.[^ \n>]+>?"
MASKS = [
    (r"<@U[A-Z0-9]+(\|[^>]*)?>", "[USER]"),
    (r"<#C[A-Z0-9]+(\|[^>]*)?>", "[CHANNEL]"),
    (r"<?https?://[^ \n>]+>?", "[URL]"),
    (r"<?(mailto:)?[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(\|[^>]*>)?", "[EMAIL]"),
    (r"(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "[PHONE]"),
]
FENCE = "```"
# What a text must contain for any of the patterns to match.
MARKS = ["@", "<#C", "://"]
DIGITS = "[0-9]{3}[ .-][0-9]{4}"


def strip_file_urls(text: Column) -> Column:
    """Remove links to private files altogether."""
    return F.regexp_replace(text, FILE_URL, "")


def _mask(text: Column) -> Column:
    """The patterns one after the other, for texts that can match one at all."""
    suspect = reduce(or_, [text.contains(mark) for mark in MARKS], text.rlike(DIGITS))
    out = strip_file_urls(text)
    for pattern, mask in MASKS:
        out = F.regexp_replace(out, pattern, mask)
    return F.when(suspect, out).otherwise(text)


def scrub_pii(text: Column, scrub_code: bool = False) -> Column:
    """Mask personal data; closed code fences stay as written unless ``scrub_code``.

    A trailing fence that is never closed is masked too. Texts without any fence take the
    branch that is plain generated code.
    """
    if scrub_code:
        return _mask(text)
    fenced = let(
        F.split(text, FENCE),
        lambda parts: F.array_join(
            F.transform(
                parts,
                lambda part, i: F.when(
                    (i % 2 == 0) | (i == F.size(parts) - 1), _mask(part)
                ).otherwise(part),
            ),
            FENCE,
        ),
    )
    return F.when(text.contains(FENCE), fenced).otherwise(_mask(text))


def user_hash(user: Column, salt: str) -> Column:
    """``u:`` + HMAC-SHA256 of the user id under a secret salt; null stays null.

    The two key pads depend on the salt alone, so they are literals in the plan; set
    ``spark.sql.redaction.string.regex`` on a cluster whose plans are logged.
    """
    key = salt.encode("utf-8")
    if len(key) > 64:
        key = sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner = bytearray(b ^ 0x36 for b in key)
    outer = bytearray(b ^ 0x5C for b in key)
    digest = F.sha2(F.concat(F.lit(inner), F.encode(user, "UTF-8")), 256)
    return F.concat(F.lit("u:"), F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256))
