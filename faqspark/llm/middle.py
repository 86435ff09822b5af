"""Fill-in-the-middle rewriting, by one regular expression of counted units per row.

``regexp_count`` gives a text's number n of units. Two numbers drawn from a hash of the row's id cut it after a and
after b units, a <= b. The row's own pattern, a possessive group of a units, one of b - a units and the
rest, matches the whole text once, and the replacement writes its three groups in the order of the form. Possessive
quantifiers keep no backtracking state, so a text may have any number of units.

A text that holds a sentinel stays plain. So in any other output each sentinel stands once where it was
written, also where text next to it ends or begins with part of one: no proper part of ``<P>`` both ends and begins it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faqspark.llm.store import free_name

#: Units: lines with their line break; code points; or words with the blanks after them, blanks in front being one too.
LINE = r"(?:[^\n]*+\n|[^\n]++)"
CHARACTER = r"(?s:.)"
WORD = r"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+|[\x20\x09-\x0D]++)"
#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The struct's name, with the first number that makes it free.
STRUCT = "fim"


def draws(row_id: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from a hash of the id; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(count)]


def pattern(a: Column, b: Column, unit: str) -> Column:
    """Matches a whole text: a units, b - a units and the rest are its groups."""
    counted = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"\A"), counted(a), counted(b - a), F.lit(r"((?s:.*+))\z"))


def _checked(sentinels: Sequence[str]) -> tuple[str, str, str]:
    """Sentinels that cannot be mistaken for each other or overlap themselves or each other."""
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for x in sentinels:
        for y in sentinels:
            if (x != y and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y) + (x != y)))):
                raise ValueError(f"sentinels {x!r} and {y!r} overlap")
    return tuple(sentinels)


def cut(docs: DataFrame, *, row_id: str = "doc_id", unit: str = LINE, sentinels: Sequence[str] = SENTINELS,
        percent: int = 100, spm_percent: int = 50, seed: int = 7) -> DataFrame:
    """``docs`` with one more column, a struct named like ``STRUCT``: units, form and output of each row's text.

    ``percent`` of the texts are rewritten, ``spm_percent`` of them with the suffix first. Null texts count as empty;
    empty texts and those that hold a sentinel stay plain. Rows of equal id and text are cut alike; without an id the
    draws are those of an empty one. Any other columns pass through.
    """
    mark = _checked(sentinels)
    h1, h2, h3, h4 = draws(F.col(row_id), seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    held = F.lit(False)
    for m in mark:
        held |= F.contains(text, F.lit(m))
    form = F.when((text == "") | held | (h3 % 100 >= percent), PLAIN).when(h4 % 100 < spm_percent, SPM).otherwise(PSM)
    name = free_name(docs, STRUCT)
    counted = docs.withColumn(name, F.struct(F.regexp_count(text, F.lit(unit)).cast("long").alias("units"), form.alias("form"), text.alias("text")))
    n, kind, whole = (F.col(f"{name}.{c}") for c in ("units", "form", "text"))
    first, second = h1 % (n + 1), h2 % (n + 1)
    p, s, m = (x.replace("\\", "\\\\").replace("$", "\\$") for x in mark)
    order = F.when(kind == SPM, f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    output = F.when(kind == PLAIN, whole).otherwise(F.regexp_replace(whole, pattern(F.least(first, second), F.greatest(first, second), unit), order))
    return counted.withColumn(name, F.struct(n.alias("units"), kind.alias("form"), output.alias("output")))


def parts(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Struct of prefix, middle and suffix, read back from an output; of a plain one the text is the suffix."""
    mark = _checked(sentinels)
    after = lambda text, x: F.substring_index(text, x, -1)
    before = lambda text, x: F.substring_index(text, x, 1)
    p, s, m = mark
    middle = after(output, m)
    prefix = F.when(form == SPM, before(after(output, p), m)).otherwise(before(after(output, p), s))
    suffix = F.when(form == SPM, before(after(output, s), p)).otherwise(before(after(output, s), m))
    plain = form == PLAIN
    return F.struct(
        F.when(plain, "").otherwise(prefix).alias("prefix"), F.when(plain, "").otherwise(middle).alias("middle"),
        F.when(plain, output).otherwise(suffix).alias("suffix"))


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text an output was made from."""
    back = parts(output, form, sentinels)
    return F.concat(back["prefix"], back["middle"], back["suffix"])


def fill_in_middle(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` rewritten for infilling, and ``n_chars`` counted anew where there is such a column.

    Null texts stay null. See ``cut`` for the options and for ties, repeated rows and clashing names.
    """
    made, name = cut(docs, **options), free_name(docs, STRUCT)
    output = F.when(F.col("text").isNotNull(), F.col(f"{name}.output"))
    out = {"text": output}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length(output).cast(docs.schema["n_chars"].dataType)
    return made.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def middle_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, units, form, code points of prefix and middle, digests of output and restored text.

    Lengths are null for a plain form. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "text")
    made, name = cut(rows, **options), free_name(rows, STRUCT)
    form, output = F.col(f"{name}.form"), F.col(f"{name}.output")
    mark = options.get("sentinels", SENTINELS)
    back = made.withColumn("back", parts(output, form, mark))
    chars = lambda part: F.when(form != PLAIN, F.length(F.col(f"back.{part}")).cast("long"))
    return back.select(
        "doc_id", F.col(f"{name}.units").alias("n"), form.alias("form"), chars("prefix").alias("prefix_chars"),
        chars("middle").alias("middle_chars"), F.sha2(output, 256).alias("output_sha256"),
        F.sha2(F.concat("back.prefix", "back.middle", "back.suffix"), 256).alias("restored_sha256"))
