"""Column expressions for dirty text: trimming, null markers, number parsing.

Everything here is a pure ``Column -> Column`` expression (JVM-side,
whole-stage codegen); no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that means "missing" after trimming (exact, case-sensitive).
NULL_MARKERS = [
    "", " ", "NA", "N/A", "na", "n/a", "NULL", "null", "None", "none",
    "?", "-", "--", "#N/A", "#NULL!", "NaN", "nan", ".", "S/I", "s/i",
    "sin dato", "Sin Dato", "SIN DATO", "desconocido", "Desconocido",
]

# The default missing-value strings of pandas' CSV reader
# (matched exactly on the raw field, no trimming).
LOAD_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Currency signs, the sol prefix and currency codes removed
# before parsing a number.
CURRENCY_CHARS = "$€¥£"
LETTER_RE = "[A-Za-z]"
SOL_PREFIX = "(?i)S/\\.?"
CURRENCY_CODES = "(?i)USD|PEN|EUR|GBP"

# Python float() syntax without underscores, inf and nan.
NUMBER_RE = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
THOUSANDS_RE = "^[^,]*,[0-9]{3}$"


# Python's whitespace (what str.strip() removes), built from Python's own definition.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (not only spaces), like str.strip()."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_marker(c: Column, markers: list[str] | None = None) -> Column:
    """NULL when the value is one of the markers, else the value."""
    m = NULL_MARKERS if markers is None else markers
    return F.when(~c.isin(m), c)


def null_if_load_token(c: Column) -> Column:
    return F.when(~c.isin(LOAD_NA_TOKENS), c)


def clean_text(c: Column) -> Column:
    """Trim, then turn null markers into NULL."""
    return null_if_marker(strip(c))


EU_DECIMAL_RE = "\\..*,[^.]*$"


def number_core(c: Column) -> Column:
    """First half of the parser: trimmed text without percent sign, currency and codes.

    Cheap character operations do most of the work; the two case-insensitive
    patterns run only on text that can contain them.
    """
    s0 = strip(c.cast("string"))
    s1 = F.when(s0.endswith("%"), strip(s0.substr(F.lit(1), F.length(s0) - 1))).otherwise(s0)
    s2 = F.translate(s1, CURRENCY_CHARS, "")
    s3 = F.when(s2.contains("/"), F.regexp_replace(s2, SOL_PREFIX, "")).otherwise(s2)
    s4 = F.when(s3.rlike(LETTER_RE), F.regexp_replace(s3, CURRENCY_CODES, "")).otherwise(s3)
    return strip(s4)


def number_finish(s: Column) -> Column:
    """Second half: decide the decimal mark, drop the others, read the float.

    The decimal mark is a comma when the last separator is a comma after a
    dot, or when commas stand alone and are not "one comma + three digits"
    (a thousands mark).  Otherwise commas are thousands marks and go away.
    """
    has_c = s.contains(",")
    has_p = s.contains(".")
    comma_decimal = (F.when(has_c & has_p, s.rlike(EU_DECIMAL_RE))
                     .when(has_c, ~s.rlike(THOUSANDS_RE)).otherwise(F.lit(False)))
    norm = (F.when(comma_decimal, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when(has_c, F.replace(s, F.lit(","), F.lit(""))).otherwise(s))
    return (F.when((s == "") | (s == "-"), F.lit(None).cast("double"))
            .when(norm.rlike(NUMBER_RE), norm.try_cast("double")))


def parse_number(c: Column) -> Column:
    """Text to double, NULL when the text is no number.

    Rules: a trailing ``%`` is dropped (25% -> 25); currency signs, the
    ``S/`` prefix and currency codes go away anywhere; with both ``,`` and
    ``.`` the last one is the decimal mark; with only commas, exactly one
    comma followed by three digits is a thousands mark, otherwise a decimal
    comma; a lone dot is always decimal.  For many columns at once use
    :func:`quarry.operators.clean.parsed` (it stages the two halves).
    """
    return number_finish(number_core(c))
