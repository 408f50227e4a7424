"""Deterministic hash expressions (JVM-side, identical on every re-execution).

Random draws are replaced by md5 ranks: an executor that is lost and recomputed
produces exactly the same sample, folds and scores, and the SQL oracle can
recompute them bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyhash(key, seed: int = 42) -> Column:
    """Hex md5 of ``'<seed>:<key>'``: the sort key of every pseudo-random rank."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))


def hex_prefix(h: Column, nchars: int) -> Column:
    """Order-preserving prefix of a hex hash: sorts exactly like the hash it cuts."""
    return F.substring(h, 1, nchars)


def hash_unit(key, salt: str = "", levels: int = 100) -> Column:
    """A score in [0, 1) with ``levels`` distinct values (ties on purpose).

    ``pmod(int(first 8 hex digits of md5(salt||key)), levels) / levels``.
    """
    h = F.md5(F.concat(F.lit(salt), _col(key).cast("string")))
    n = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return F.pmod(n, F.lit(levels)).cast("double") / F.lit(float(levels))


def hash_bucket(text, nbits: int) -> Column:
    """Fold a string to ``[0, nbits)``: ``int(first 8 hex digits of md5) mod nbits``.

    When ``nbits`` is a power of two (at most 2^32) the residue depends only on
    the low bits of that 32-bit number, i.e. on the last ``ceil(log2(nbits)/4)``
    of the 8 hex digits, so only those are parsed (same value, cheaper).
    """
    h = F.md5(_col(text))
    if 0 < nbits <= 1 << 32 and nbits & (nbits - 1) == 0:
        k = max(1, -(-(nbits.bit_length() - 1) // 4))
        digits = F.substring(h, 9 - k, k)
    else:
        digits = F.substring(h, 1, 8)
    n = F.conv(digits, 16, 10).cast("bigint")
    return F.pmod(n, F.lit(nbits)).cast("int")
