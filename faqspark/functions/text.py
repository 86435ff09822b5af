"""Text functions: stripping, tokens, ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the characters a text strip removes (all Unicode white space).
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all white space at both ends (``trim`` alone removes blanks only)."""
    return F.btrim(text, F.lit(WHITE))


def flatten_paragraph(elements: Column) -> Column:
    """Concatenated text runs of a paragraph, stripped; other element kinds are skipped."""
    runs = F.transform(elements, lambda e: e["textRun"]["content"])
    return strip(F.coalesce(F.array_join(runs, ""), F.lit("")))


# Scripts written without blanks: every character is a token of its own. None of them is below the first; to ask for a range is cheaper.
SINGLE, HIGH = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]", r"[\x{2E80}-\x{10FFFF}]"


def tokens(text: Column) -> Column:
    """Lower-case words and numbers of any script, accents included."""
    low = F.lower(text)
    found = (F.octet_length(low) > F.char_length(low)) & low.rlike(HIGH) & low.rlike(SINGLE)
    spaced = F.when(found, F.regexp_replace(low, f"({SINGLE})", " $1 ")).otherwise(low)
    return F.filter(F.split(spaced, r"[^\p{L}\p{M}\p{N}]+"), lambda t: t != "")


def token_codes(text: Column) -> Column:
    """One 36-bit number per token: the first 9 hex digits of its MD5, the same in any engine."""
    return F.transform(
        tokens(text), lambda t: F.conv(F.substring(F.md5(t), 1, 9), 16, 10).cast("bigint")
    )


def token_set(text: Column) -> Column:
    """The distinct tokens of a text as sorted 64-bit hashes."""
    return F.sort_array(F.array_distinct(F.transform(tokens(text), lambda t: F.xxhash64(t))))


def embed_text(question: Column, answer: Column) -> Column:
    return F.concat_ws("\n", question, answer)


def point_id(course_id: Column, text: Column, id_hex: int = 8) -> Column:
    """Course plus the first hex digits of the content hash; equal content, equal id."""
    return F.concat_ws(
        "_", F.coalesce(course_id, F.lit("unknown")), F.substring(F.sha2(text, 256), 1, id_hex)
    )


def thread_id(course_id: Column, thread_ts: Column) -> Column:
    return F.concat_ws(":", course_id, thread_ts)
