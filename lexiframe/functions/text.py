"""String expressions with Python semantics, built from native functions."""

from pyspark.sql import Column, functions as F

# The characters that Python's str.strip() removes.
STRIP_CLASS = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Fixed value: the ideographic space.
WIDE_SPACE = "\u3000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_split(c, delimiter: str) -> Column:
    """Split on a literal delimiter and keep every empty field.

    A pattern of one plain character is split without the regex engine.
    """
    plain = len(delimiter) == 1 and (delimiter.isalnum() or delimiter in " ,:;\t\n")
    return F.split(_col(c), delimiter if plain else rf"\Q{delimiter}\E", -1)


def strip(c) -> Column:
    return F.regexp_replace(_col(c), f"^{STRIP_CLASS}+|{STRIP_CLASS}+$", "")


def blank_or_spaced(word: Column) -> Column:
    """True for tokens that are empty or hold a plain or ideographic space."""
    return (word == "") | F.contains(word, F.lit(" ")) | F.contains(word, F.lit(WIDE_SPACE))


def python_float(c) -> Column:
    """A double as Python's repr() shows it.

    Both sides print the shortest digits (Java two at least with an exponent, which shows in
    the very smallest numbers only); they differ in when an exponent is used (Python:
    below 1e-4 and from 1e16) and in how it is written.
    """
    shown = _col(c).cast("double").cast("string")
    sign = F.when(shown.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_extract(shown, r"^-?([0-9.]+)E", 1)
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "(?<=.)0+$", "")
    power = F.regexp_extract(shown, r"E(-?[0-9]+)$", 1).cast("int")
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    rest = F.substring(digits, power + 2, F.length(digits))
    rest = F.when(rest == "", "0").otherwise(rest)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    point = F.concat(F.substring(digits, 1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.length(digits)))).otherwise(""))
    size = F.abs(power).cast("string")
    size = F.when(F.length(size) < 2, F.lpad(size, 2, "0")).otherwise(size)
    far = F.concat(point, F.lit("e"), F.when(power < 0, "-").otherwise("+"), size)
    number = F.when((power >= 0) & (power < 16), F.concat(whole, F.lit("."), rest)).when((power < 0) & (power >= -4), small).otherwise(far)
    return (
        F.when(shown == "NaN", "nan")
        .when(shown.endswith("Infinity"), F.concat(sign, F.lit("inf")))
        .when(F.contains(shown, F.lit("E")), F.concat(sign, number))
        .otherwise(shown)
    )


def _escape_char(ch: Column) -> Column:
    code = F.lower(F.hex(F.ascii(ch)))
    return (
        F.when(~ch.rlike(r"[\p{C}\p{Z}&&[^ ]]"), ch)
        .when(F.length(code) <= 2, F.concat(F.lit(r"\x"), F.lpad(code, 2, "0")))
        .when(F.length(code) <= 4, F.concat(F.lit(r"\u"), F.lpad(code, 4, "0")))
        .otherwise(F.concat(F.lit(r"\U"), F.lpad(code, 8, "0")))
    )


def python_str(c) -> Column:
    """The text as Python's repr() shows it, quotes included."""
    c = _col(c)
    body = c
    for raw, shown in (("\\", r"\\"), ("\n", r"\n"), ("\r", r"\r"), ("\t", r"\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    body = F.when(
        body.rlike(r"[\p{C}\p{Z}&&[^ ]]"),
        F.array_join(F.transform(F.split(body, ""), _escape_char), ""),
    ).otherwise(body)
    single = F.contains(c, F.lit("'"))
    double = F.contains(c, F.lit('"'))
    return (
        F.when(single & ~double, F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit(r"\'")), F.lit("'")))
    )
