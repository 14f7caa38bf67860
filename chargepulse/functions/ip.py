"""Dotted IPv4 <-> number (FN1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One octet 0..255, leading zeros allowed (up to three digits).
_OCTET = r"(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_DOTTED = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ip_from_octets(parts, raw) -> Column:
    """Octet array of ``raw`` (``split(raw, "[.]")``) -> BIGINT, NULL unless
    ``raw`` is four decimal octets in 0..255.  Validation is one regex on
    ``raw`` and each octet is referenced once, so the expression stays small
    even when the optimizer inlines it into pushed-down filters."""
    p = _c(parts)
    octs = [F.get(p, i).cast("bigint") for i in range(4)]
    val = (F.shiftleft(octs[0], 24).bitwiseOR(F.shiftleft(octs[1], 16))
           .bitwiseOR(F.shiftleft(octs[2], 8)).bitwiseOR(octs[3]))
    return F.when(_c(raw).rlike(_DOTTED), val)


def ip_to_long(col, strict: bool = True) -> Column:
    """``a.b.c.d`` -> ``a<<24 | b<<16 | c<<8 | d`` as BIGINT.

    ``strict`` (default) returns NULL unless there are exactly four decimal
    octets in 0..255.  With ``strict=False`` any count of numeric parts is
    folded left (``acc << 8 | part``), as the original row closure did; a
    non-numeric part still gives NULL instead of failing the batch.
    For wide inputs prefer :func:`with_ip_num`, which splits once.
    """
    c = _c(col)
    parts = F.split(c, r"\.")
    if strict:
        return ip_from_octets(parts, c)
    # Lenient fold over a variable number of parts (higher-order function;
    # only used when the input is known to be irregular).
    return F.aggregate(
        F.transform(parts, lambda x: x.try_cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda acc, x: F.shiftleft(acc, 8).bitwiseOR(x),
    )


def with_ip_num(df, ip_col: str, out_col: str = "ip_num"):
    """Add ``out_col`` = strict :func:`ip_to_long` of ``ip_col``, splitting the
    address once in its own projection (keeps generated code small)."""
    tmp = f"_{out_col}_octets"
    return (df.withColumn(tmp, F.split(F.col(ip_col), r"\."))
            .withColumn(out_col, ip_from_octets(tmp, ip_col)).drop(tmp))


def long_to_ip(col) -> Column:
    """BIGINT -> dotted quad (inverse of :func:`ip_to_long`)."""
    c = _c(col)
    return F.concat_ws(
        ".",
        *[F.shiftright(c, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)],
    )
