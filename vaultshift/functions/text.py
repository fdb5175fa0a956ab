"""Column expressions shared by the rules.

Every helper returns a ``pyspark.sql.Column`` built from built-in functions only, so each rule stays
inside whole-stage codegen and no Python worker is started.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultshift import constants as K

# Python's str.strip() removes 29 whitespace code points; Spark's trim() removes only the space.
# The set is derived from str.isspace, and btrim removes any of its characters at both ends.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def col_of(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Unicode-aware strip with the same whitespace set as Python's ``str.strip``."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def is_blank(c: str | Column, stripped: Column | None = None) -> Column:
    """Null, or after strip + lower one of the blank tokens (``nan``, ``none``, ``nat``, empty).
    ``stripped`` is an already computed ``py_strip(c)`` (a staged column), when there is one."""
    c = col_of(c)
    s = py_strip(c) if stripped is None else stripped
    return c.isNull() | F.lower(s).isin(*K.BLANK_TOKENS)


def norm_cell(c: str | Column, stripped: Column | None = None) -> Column:
    """Blank cells become ``''``; every other cell is stripped."""
    s = py_strip(c) if stripped is None else stripped
    return F.when(is_blank(c, s), F.lit("")).otherwise(s)


def is_empty_after_strip(c: str | Column) -> Column:
    """Null, or only whitespace (no blank-token handling: ``nan`` is text here)."""
    c = col_of(c)
    return c.isNull() | (py_strip(c) == "")


def full_match(c: Column, pattern: str) -> Column:
    """Anchored regex match that is False (never null) on a null input. A final ``$`` tolerates one
    line feed at the very end and no other line terminator, unlike the JVM's own ``$``."""
    if pattern.endswith("$"):
        pattern = pattern[:-1] + r"\n?\z"
    return F.coalesce(c.rlike(pattern), F.lit(False))


def clean_for_csv(c: str | Column) -> Column:
    """Text written to report files: null and the cell ``nan`` become ``''``, one ``.0`` suffix goes."""
    c = col_of(c).cast("string")
    base = F.when(c == "nan", F.lit("")).otherwise(F.coalesce(c, F.lit("")))
    return F.regexp_replace(base, r"\.0$", "")


def strip_fractional_seconds(c: str | Column, stripped: Column | None = None) -> Column:
    """``…T12:00:00.123Z`` → ``…T12:00:00Z`` when the stripped cell has exactly that shape."""
    c = col_of(c)
    s = py_strip(c) if stripped is None else stripped
    return F.when(
        ~is_blank(c, s) & full_match(s, K.ISO_Z_FRACTIONAL_PATTERN),
        F.regexp_replace(s, r"\.[0-9]+Z$", "Z"),
    ).otherwise(c)


# Python's whitespace as a regex class, for collapsing inner runs: ASCII whitespace, the four separators
# 0x1C-0x1F, NEL and the Unicode separators Z*.
_WS = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]"

# A number Python's float() reads (no inf/nan): sign, digits, point, exponent; single underscores may
# stand between digits.
_DIGITS = "[0-9](_?[0-9])*"
_FLOAT_TEXT = rf"^[+-]?({_DIGITS}([.]({_DIGITS})?)?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?\z"
_LIMB = 1_000_000_000
_LONG_END = float(1 << 63)


def _div(x: Column) -> Column:
    return F.call_function("div", x, F.lit(_LIMB).cast("long"))


def _times(limbs: Column, factor: Column) -> Column:
    """Little-endian limbs (base 10**9) times a factor below 2**29."""
    step = F.aggregate(
        limbs, F.struct(F.lit(0).cast("long").alias("c"), F.array().cast("array<bigint>").alias("o")),
        lambda a, x: F.struct(_div(x * factor + a["c"]).alias("c"),
                              F.concat(a["o"], F.array((x * factor + a["c"]) % _LIMB)).alias("o")),
        lambda a: F.when(a["c"] > 0, F.concat(a["o"], F.array(a["c"]))).otherwise(a["o"]))
    return step


def _big_digits(d: Column) -> Column:
    """All digits of a whole double of 2**63 or more: mantissa times a power of two, in limbs."""
    e = (F.floor(F.log2(d)) - 55).cast("int")
    m = (d / F.pow(F.lit(2.0), e)).cast("long")
    limbs = F.array(m % _LIMB, _div(m))
    big = F.aggregate(F.sequence(F.lit(1), F.lit(36)), limbs,
                      lambda a, i: F.when(i * 28 <= e, _times(a, F.lit(1 << 28).cast("long"))).otherwise(a))
    big = _times(big, F.pow(F.lit(2.0), F.pmod(e, F.lit(28))).cast("long"))
    text = F.aggregate(big, F.lit(""), lambda a, x: F.concat(F.lpad(x.cast("string"), 9, "0"), a))
    return F.regexp_replace(text, "^0+", "")


def normalize_quantity(c: str | Column, stripped: Column | None = None) -> Column:
    """Whole non-negative numbers become plain digits (``2.0``→``2``, ``1e3``→``1000``, ``+2``→``2``),
    all digits of the double the text stands for, whatever its size.

    Anything else (negative, fractional, junk, blank, null, beyond the doubles) is returned unchanged
    so the quantity rule can reject it. The regex gate keeps inputs Spark would parse but Python would
    not (``2d``, ``2f``) out of the numeric branch.
    """
    c = col_of(c)
    s = py_strip(c) if stripped is None else stripped
    d = F.when(s.rlike(_FLOAT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
    whole = d.isNotNull() & (d >= 0) & (d == F.rint(d)) & (d < float("inf"))
    return (
        F.when(c.isNull(), c)
        .when(F.lower(s).isin(*K.BLANK_TOKENS), c)
        .when(s.rlike(r"^[0-9]+\z"), s)
        .when(whole & (d < _LONG_END), d.cast("long").cast("string"))
        .when(whole, _big_digits(d))
        .otherwise(c)
    )


STRIPPED_PREFIX = "_strip__"


def stripped_name(c: str) -> str:
    return STRIPPED_PREFIX + c


def with_stripped(df, columns):
    """Stage ``py_strip`` of ``columns`` as helper columns (``_strip__<name>``), so that rules using a
    stripped value many times reference one computed column instead of repeating the expression:
    each generated method stays small enough for the JVM to compile."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({stripped_name(c): py_strip(c) for c in cols})


def stripped(c: str) -> Column:
    return F.col(stripped_name(c))


def subscriber_null_normalise(c: str | Column) -> Column:
    """Subscriber export: only ``_`` is null, a blank cell stays ``''``."""
    c = col_of(c)
    return F.when(c == K.SUBSCRIBER_NULL_TOKEN, F.lit(None).cast("string")).otherwise(
        F.coalesce(c, F.lit(""))
    )


def mapping_null_normalise(c: str | Column) -> Column:
    """Vault mapping: the standard NA tokens (blank, ``NA``, ``null``, ``nan``, …) are null."""
    c = col_of(c)
    return F.when(c.isin(*K.MAPPING_NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


#: Token widths of anonymised emails: the least one whose tokens outnumber the row ids of its class is taken.
TOKEN_WIDTHS = (5, 7, 9, 11, 13)
TOKEN_ROUNDS = 4


def permuted_token(number: Column, seed: str) -> Column:
    """A token of ``[0-9a-z]`` for a non-negative whole number, different for different numbers.

    Numbers below 36**5 get five characters, larger ones 7, 9, 11 or 13. Within a width the token is a keyed
    permutation of the number: an alternating Feistel network over its upper and lower base-36 digits, whose
    round function is a part of an md5 digest. Equal numbers and seeds give equal tokens on every run."""
    n = number.cast("long")

    def by_width(of):
        out = F.lit(of(TOKEN_WIDTHS[-1]))
        for w in reversed(TOKEN_WIDTHS[:-1]):
            out = F.when(n < 36**w, F.lit(of(w))).otherwise(out)
        return out

    upper, lower = by_width(lambda w: 36 ** (w // 2 + 1)).cast("long"), by_width(lambda w: 36 ** (w // 2)).cast("long")
    width = by_width(lambda w: w)
    lo = n % lower
    hi = F.call_function("div", n - lo, lower)
    for k in range(TOKEN_ROUNDS):
        side = lo if k % 2 == 0 else hi
        digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{k}"), width.cast("string"), side.cast("string")).cast("binary"))
        drawn = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
        if k % 2 == 0:
            hi = (hi + drawn) % upper
        else:
            lo = (lo + drawn) % lower
    digits = lambda c, w: F.lpad(F.lower(F.conv(c.cast("string"), 10, 36)), w, F.lit("0"))
    half = F.floor(width / 2).cast("int")
    return F.concat(digits(hi, half + 1), digits(lo, half))
