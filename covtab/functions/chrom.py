"""Chromosome-name expressions.

Three different rank rules exist on purpose: the validator's row-order rank
(P6), the chromosome-count ordering (P7) and the inspector's sort key (P8).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of X (and Y for the inspector), rank of everything else.
RANK_X = 23
RANK_Y = 24
RANK_OTHER = 1000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    """String -> int, NULL when not an integer."""
    return _c(c).try_cast("int")


def normalize_chrom(c: Column | str) -> Column:
    """Remove every occurrence of 'chr' (case-sensitive, not only a prefix)."""
    return F.replace(_c(c), F.lit("chr"), F.lit(""))


def order_rank(c: Column | str) -> Column:
    """Rank used by the row-order check. 1..22 -> itself, 'X' -> 23,
    anything else (other integers, Y, M, contigs, NULL) -> 1000."""
    c = _c(c)
    n = try_int(c)
    return (F.when(n.between(1, 22), n)
             .when(c == "X", F.lit(RANK_X))
             .otherwise(F.lit(RANK_OTHER)))


def count_rank(c: Column | str) -> Column:
    """Rank used to order per-chromosome counts. Any integer -> itself,
    'X' -> 23, else 1000 (ties broken by name by the caller)."""
    c = _c(c)
    n = try_int(c)
    return (F.when(n.isNotNull(), n)
             .when(c == "X", F.lit(RANK_X))
             .otherwise(F.lit(RANK_OTHER)))


def inspect_rank(c: Column | str) -> Column:
    """Inspector sort rank. Strip one leading 'chr'; integer -> itself,
    X -> 23, Y -> 24, else 1000. Sort by (rank, full name)."""
    clean = F.regexp_replace(_c(c), "^chr", "")
    n = try_int(clean)
    return (F.when(n.isNotNull(), n)
             .when(clean == "X", F.lit(RANK_X))
             .when(clean == "Y", F.lit(RANK_Y))
             .otherwise(F.lit(RANK_OTHER)))
