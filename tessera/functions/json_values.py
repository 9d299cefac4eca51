"""Typed access to semi-structured JSON values.

Values are parsed once per line into a VARIANT; every typed getter is gated on
the JSON type of the value, so conversions follow the JSON data model rather
than SQL casts (a JSON `true` is not the integer 1, `{"x":1}` is not a string).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that read as a decimal float literal (optional sign, digits with
# single underscores between them, optional fraction and exponent).  Anything
# else (hex, `12f`, `1.2.3`) does not convert.
_DIGITS = r"[0-9](_?[0-9])*"
FLOAT_TEXT = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
# Unicode-aware whitespace, stripped from both ends of numeric text.
_EDGE_SPACE = r"^(?U)\s+|(?U)\s+$"


def bound(value: Column, fn) -> Column:
    """`fn(value)` with `value` evaluated once, and the expression of `fn` kept out of the generated code."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def parse_json_line(line: Column) -> Column:
    """Parse one text line as JSON; NULL unless the whole line is one JSON value in valid UTF-8.

    The parser stops after the first value and takes damaged bytes for U+FFFD.
    So the line is parsed as the first element of an array that the line's own
    hash closes: text after the value either breaks the array or moves the hash.
    """
    return whole_value(line, both_values(line))


def both_values(line: Column) -> Column:
    """The line and its own hash, parsed as an array; NULL if that is no JSON."""
    mark = F.xxhash64(line).cast("string")
    return F.try_parse_json(F.when(F.is_valid_utf8(line), F.concat(F.lit("["), line, F.lit(","), mark, F.lit("]"))))


def whole_value(line: Column, both: Column) -> Column:
    """The line's value out of `both_values(line)`; NULL unless it is all there was."""
    whole = F.try_variant_get(both, "$[1]", "string") == F.xxhash64(line).cast("string")
    return F.when(whole, F.try_variant_get(both, "$[0]", "variant"))


def variant_at(v: Column, path: str) -> Column:
    """B1 `get_nested`: the sub-value at a `$.a.b` path; NULL when any step is not an object."""
    return F.try_variant_get(v, path, "variant")


def json_type(v: Column) -> Column:
    """JSON type name of a variant value: STRING, BIGINT, DECIMAL(p,s), DOUBLE,
    BOOLEAN, OBJECT<...>, ARRAY<...>, VOID (JSON null); NULL when absent."""
    return F.schema_of_variant(v)


def _is_number(t: Column) -> Column:
    return t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")


def variant_to_int(v: Column, sql_type: str = "bigint", t: Column | None = None) -> Column:
    """B3 `to_int`: integers as-is, fractional numbers truncated toward zero,
    numeric text parsed as a float then truncated; booleans, objects, arrays,
    blanks and unparseable text are NULL.  Out-of-range values are NULL.

    `t` may carry a precomputed `json_type(v)` so the type is derived once."""
    t = json_type(v) if t is None else t
    text = F.regexp_replace(F.try_variant_get(v, "$", "string"), _EDGE_SPACE, "")
    from_text = F.when(
        text.rlike(FLOAT_TEXT),
        F.regexp_replace(text, "_", "").try_cast("double").try_cast(sql_type),
    )
    return (
        F.when(t == "STRING", from_text)
        .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(v, "$", sql_type))
        .when(_is_number(t), F.try_variant_get(v, "$", "double").try_cast(sql_type))
    )


def python_float_text(d: Column) -> Column:
    """Text of a finite double as Python's `repr` writes it (see `python_float_text_expr`).

    Evaluated inside a one-element `transform` so that its large expression
    stays out of the generated code of the hot Silver projection; only JSON
    floats in text columns reach it."""
    return F.element_at(F.transform(F.array(d), python_float_text_expr), 1)


def python_float_text_expr(d: Column) -> Column:
    """Text of a finite double as Python's `repr` writes it.

    Python writes the shortest digit string that reads back as the same
    double, in fixed notation for decimal exponents -4..15 and as `d.ddde±XX`
    outside them.  The digits are the first of the 17 candidate precisions
    (`%.0e` … `%.16e`) that round-trips; then the decimal point or exponent is
    placed the way Python does.  (Only float values in text columns take this
    path, so the candidate list is not on a hot path.)
    """
    cands = F.array(*[F.format_string(f"%.{p}e", d) for p in range(17)])
    best = F.element_at(F.filter(cands, lambda s: s.cast("double") == d), 1)
    sci = r"^(-?)([0-9])(?:\.([0-9]+))?e([+-][0-9]+)$"
    sign = F.regexp_extract(best, sci, 1)
    lead = F.regexp_extract(best, sci, 2)
    digits = F.concat(lead, F.regexp_extract(best, sci, 3))
    exp = F.regexp_extract(best, sci, 4).cast("int")
    n = F.length(digits)

    def zeros(k: Column) -> Column:
        return F.repeat(F.lit("0"), k)

    fixed = (
        F.when(exp < 0, F.concat(F.lit("0."), zeros(-exp - 1), digits))
        .when(n <= exp + 1, F.concat(digits, zeros(exp + 1 - n), F.lit(".0")))
        .otherwise(F.concat(F.substr(digits, F.lit(1), exp + 1), F.lit("."), F.substr(digits, exp + 2)))
    )
    exp_text = F.abs(exp).cast("string")
    scientific = F.concat(
        lead,
        F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")),
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exp) < 10, F.concat(F.lit("0"), exp_text)).otherwise(exp_text),
    )
    return F.concat(sign, F.when((exp >= -4) & (exp <= 15), fixed).otherwise(scientific))


def is_float_type(t: Column) -> Column:
    """JSON type of a number written with a fraction or exponent (a float in Python).

    Integer tokens that fit in 64 bits are BIGINT, so DECIMAL(p,0) with p ≤ 18
    can only come from a token like `1000.0` (the parser drops the zero
    fraction).  DECIMAL(p≥19,0) is taken as a wide integer."""
    precision = F.substring_index(F.substring_index(t, ",", 1), "(", -1).cast("int")
    decimal_is_float = ~t.endswith(",0)") | (precision <= 18)
    return F.when(t.startswith("DECIMAL("), decimal_is_float).otherwise(t.isin("DOUBLE", "FLOAT"))


def maybe_float_type(t: Column) -> Column:
    """JSON types that a float may have; an integer of more than 64 bits has them too."""
    return F.coalesce(t.startswith("DECIMAL(") | t.isin("DOUBLE", "FLOAT"), F.lit(False))


def variant_to_str(
    v: Column, t: Column | None = None, python_floats: bool = True, is_float: Column | None = None
) -> Column:
    """B4 `to_str`: strings as-is, numbers as text, booleans as `True`/`False`;
    objects, arrays and JSON null are NULL.

    Floats are written as Python's `repr` writes them; with
    `python_floats=False` they keep Spark's text (for a later, separate fix-up
    of the few values that need it, see `python_float_text`)."""
    t = json_type(v) if t is None else t
    as_double = F.try_variant_get(v, "$", "double")
    return (
        F.when(t == "STRING", F.try_variant_get(v, "$", "string"))
        .when(t == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
        .when(
            is_float_type(t) if is_float is None else is_float,
            python_float_text(as_double) if python_floats else as_double.cast("string"),
        )
        # integers (BIGINT, or DECIMAL(p≥19,0) when wider than 64 bits) keep their digits
        .when(_is_number(t), F.try_variant_get(v, "$", "string"))
    )


# Marker for the separator rewrite; JSON text cannot contain it unescaped.
_MARK = "\u0001"
# Possessive quantifiers: a string literal is consumed without backtracking.
_STRING_OR_SEPARATOR = r'("(?:[^"\\]++|\\.)*+")|([,:])'


def python_json_text(compact: Column) -> Column:
    """Compact JSON text → the text Python's `json.dumps(obj, ensure_ascii=False)`
    writes: `", "` and `": "` separators outside string literals.

    Every string literal and separator is tagged with a marker in one pass
    (literals are consumed whole, so commas/colons inside them are untouched),
    then tagged separators get their space and the remaining markers go."""
    tagged = F.regexp_replace(compact, _STRING_OR_SEPARATOR, "$1$2" + _MARK)
    spaced = F.regexp_replace(F.regexp_replace(tagged, "([,:])" + _MARK, "$1 "), _MARK, "")
    # Control characters: Python writes `\u001f`, Spark's writer `\u001F`.
    # Without escaped backslashes in the text every `\` starts an escape, so
    # the hex digits can be lower-cased safely; other rows pass through.
    lowered = spaced
    for h in "ABCDEF":
        lowered = F.regexp_replace(lowered, r"\\u00([01])" + h, r"\\u00$1" + h.lower())
    needs = spaced.contains("\\u00") & ~spaced.contains("\\\\")
    return F.when(needs, lowered).otherwise(spaced)
