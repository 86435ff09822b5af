"""Dense and sparse vectors by feature hashing.

Both are computed inside the row that holds the text: no exchange, whatever the corpus size.
They are the default models; ``operators.embedding`` has the seam for a trained one.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faqspark.functions.arrays import let, run_lengths, run_starts

TERM_BITS = 20
DENSE_DIM = 64


def term_index(code: Column) -> Column:
    """Sparse dimension of a token: its first 8 hex digits modulo 2^20."""
    return F.shiftright(code, 4).bitwiseAND(F.lit((1 << TERM_BITS) - 1)).cast("int")


def sparse_vector(codes: Column) -> Column:
    """Sorted term indices with weights ``ln(1 + tf)``; the idf belongs to the query side.

    Sorting the indices puts equal ones together, so the run lengths are the term counts.
    """
    empty = F.struct(
        F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values")
    )
    filled = let(
        F.sort_array(F.transform(codes, term_index)),
        lambda ordered: let(
            run_starts(ordered),
            lambda starts: F.struct(
                F.transform(starts, lambda i: F.get(ordered, i)).alias("indices"),
                F.transform(
                    run_lengths(starts, F.size(ordered)), lambda tf: F.log(tf.cast("double") + 1)
                ).alias("values"),
            ),
        ),
    )
    return F.when(F.size(codes) > 0, filled).otherwise(empty)


def dense_vector(codes: Column, dim: int = DENSE_DIM) -> Column:
    """Signed feature hashing to ``dim`` buckets, scaled to unit length (zero if no token).

    Every (bucket, sign) value is added to the sorted list once, so run ``k`` always belongs
    to value ``k`` and its length minus one is the count. The bucket is the first 8 hex digits
    modulo ``dim``, the sign the parity of the ninth.
    """
    if dim & (dim - 1):
        raise ValueError("dim must be a power of two")
    signed = F.transform(
        codes,
        lambda c: (
            F.shiftright(c, 4).bitwiseAND(F.lit(dim - 1)) * 2
            + c.bitwiseAND(F.lit(1))
        ).cast("int"),
    )
    counts = let(
        F.sort_array(F.concat(signed, F.sequence(F.lit(0), F.lit(2 * dim - 1)))),
        lambda ordered: let(
            run_starts(ordered), lambda starts: run_lengths(starts, F.size(ordered))
        ),
    )
    raw = let(
        counts,
        lambda n: F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda b: (F.get(n, b * 2) - F.get(n, b * 2 + 1)).cast("double"),
        ),
    )
    return let(
        raw,
        lambda v: let(
            F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)),
            lambda norm: F.transform(
                v, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)).cast("float")
            ),
        ),
    )
