"""String expressions with the JVM-language semantics the reference relies on.

``java_split`` is ``String.split(regex)``: Spark's ``split`` keeps trailing
empty tokens, Java drops them (and an input made only of separators gives an
empty array). ``java_trim`` strips every char <= U+0020 at both ends, where
Spark's ``trim`` strips only spaces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import MISSING_INT


def _empty_string_array() -> Column:
    return F.array().cast("array<string>")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A single character class, optionally repeated: "\W+", "[^\w']", "\s+", " ".
_CLASS_PATTERN = re.compile(r"^(\[(?:\\.|[^\]\\])+\]|\\[WwSsDd]|[^\\.^$|?*+()\[\]{}])\+?$")
# One punctuation character with optional spaces around it: "\s*,\s*", "\s*\|\s*".
_SPACED_SEPARATOR = re.compile(r"^\\s\*(\\[^A-Za-z0-9\s]|[^\\.^$|?*+()\[\]{}A-Za-z0-9_\s])\\s\*$")


def _strip_unit(pattern: str) -> str | None:
    """The regex whose trailing run is exactly what Java drops as trailing
    empty tokens, for the pattern shapes where that holds; else None."""
    m = _CLASS_PATTERN.match(pattern)
    if m:
        return m.group(1)
    if _SPACED_SEPARATOR.match(pattern):
        return pattern
    return None


def java_split(c, pattern: str, drop_empty: bool = False) -> Column:
    r"""Split like ``java.lang.String.split(pattern)``.

    Leading empty tokens stay, trailing ones go; ``""`` splits to ``[""]``.
    ``drop_empty`` removes every empty token (not what the reference does).

    When the pattern is one character class (``\W+``, ``[^\w']``, ``" "``)
    or one punctuation character with optional spaces (``\s*,\s*``),
    trailing empty tokens are exactly the trailing run of separator matches,
    so the run is cut with a regex before splitting; this keeps the
    expression inside generated code. Other patterns (``::``, where ``a:::``
    shows the difference) trim the array instead (higher-order functions,
    evaluated without codegen).
    """
    s = as_col(c)
    unit = _strip_unit(pattern)
    if unit is not None:
        return _split_class(s, pattern, unit, drop_empty)
    return _split_general(s, pattern, drop_empty)


def _split_class(s: Column, pattern: str, unit: str, drop_empty: bool) -> Column:
    body = F.regexp_replace(s, f"(?:{unit})+\\z", "")
    out = (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(body == F.lit(""), _empty_string_array())
            .otherwise(F.split(body, pattern, -1)))
    if drop_empty:
        out = F.array_remove(out, "")
    return out


def _split_general(s: Column, pattern: str, drop_empty: bool) -> Column:
    parts = F.split(s, pattern, -1)
    # 1-based position, counted from the end, of the last non-empty token
    last = F.array_position(F.reverse(F.transform(parts, lambda x: x != F.lit(""))), True)
    out = (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(last == 0, _empty_string_array())
            .otherwise(F.slice(parts, 1, F.size(parts) - last + 1)))
    if drop_empty:
        out = F.filter(out, lambda x: x != F.lit(""))
    return out


# The characters String.trim removes: U+0000 through U+0020.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def explode_split(df, text: Column, pattern: str, keep=(), alias: str = "word",
                  drop_empty: bool = False, whole: bool = False):
    """One row per token of ``java_split(text, pattern)``, plus ``keep`` columns;
    ``whole``: one row per text, with the array of its tokens.

    The text and, for character-class patterns, its body without trailing
    separators are projected once; the explode then runs on an expression of
    those columns. Exploding a bare array column instead would let Catalyst
    infer a ``size(array) > 0`` filter and push it, with the whole text
    expression copied into it, below any repartition into the scan.
    """
    keep = [F.col(k) if isinstance(k, str) else k for k in keep]
    staged = df.select(*keep, text.alias("_s"))
    unit = _strip_unit(pattern)
    kept = [c for c in staged.columns if c != "_s"]
    rows = (lambda toks: F.explode(F.array(toks))) if whole else F.explode
    if unit is None:
        return staged.select(*kept, rows(java_split(F.col("_s"), pattern, drop_empty)).alias(alias))
    staged = staged.select(*kept, "_s",
                           F.regexp_replace("_s", f"(?:{unit})+\\z", "").alias("_b"))
    toks = (F.when(F.col("_s") == F.lit(""), F.array(F.lit("")))
             .when(F.col("_b") == F.lit(""), _empty_string_array())
             .otherwise(F.split(F.col("_b"), pattern, -1)))
    if drop_empty:
        toks = F.array_remove(toks, "")
    return staged.select(*kept, rows(toks).alias(alias))


def java_trim(c) -> Column:
    """``String.trim``: remove chars U+0000..U+0020 from both ends (a
    character-set trim, no regex)."""
    return F.trim(as_col(c), F.lit(_JAVA_TRIM_CHARS))


# What a string that casts to INT looks like, overflow aside. A failed TRY_CAST raises
# and catches an exception, which takes 40 times as long as a cast.
_INT_SHAPE = r"\A[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"


def to_int(c, default: int | None = MISSING_INT) -> Column:
    """String to INT; blank, ``NA`` or unparsable -> ``default`` (None = SQL null)."""
    s = java_trim(c)
    return F.coalesce(F.when(s.rlike(_INT_SHAPE), s.try_cast("int")), F.lit(default).cast("int"))


def to_double(c, default: float | None = None) -> Column:
    return F.coalesce(java_trim(c).try_cast("double"), F.lit(default).cast("double"))


def split_lines(c) -> Column:
    """Lines of a text the way a Hadoop text reader cuts them: on \\n, \\r\\n
    or \\r, with no extra empty line after a final terminator."""
    s = as_col(c)
    body = F.regexp_replace(s, r"(\r\n|\n|\r)\z", "")
    return F.when(s == "", _empty_string_array()).otherwise(F.split(body, r"\r\n|\n|\r", -1))


def tuple_string(*cols) -> Column:
    """``(a,b,...)``, the text form of a tuple."""
    return F.concat(F.lit("("), F.concat_ws(",", *[as_col(c).cast("string") for c in cols]), F.lit(")"))


def contains_any(c, keywords, lowercase: bool = True) -> Column:
    """True when the text contains any keyword (OR of ``contains``)."""
    s = F.lower(as_col(c)) if lowercase else as_col(c)
    cond = F.lit(False)
    for k in keywords:
        cond = cond | s.contains(k.lower() if lowercase else k)
    return cond


def normalize_quotes(c) -> Column:
    """Map the typographic apostrophe U+2019 to ASCII '."""
    return F.translate(as_col(c), "’", "'")
