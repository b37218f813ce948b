"""Column expressions shared by the operators. All are built-in Spark SQL (JVM, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the character classes and patterns the reference's text rules use
# Python str.strip() whitespace = \t \n \x0b \x0c \r \x1c-\x1f \x85 and the Unicode separators (Z*).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
STRIP_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"
TITLE_SPACE_PATTERN = r"[ -]+"
TITLE_DROP_PATTERN = r"[^a-z0-9_]"
# tokens: maximal runs of at least two word characters (letters, digits, underscore)
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
TOKEN_GAP_PATTERN = r"[^\p{L}\p{N}_]+"
LABEL_SEPARATOR = ","
# portable train/test split: first 8 hex digits of md5("<row_id>:<seed>") against fraction * 2^32
SPLIT_SPACE = 4294967296


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of every Unicode kind."""
    return F.regexp_replace(c, STRIP_PATTERN, "")


def clean_title(c: Column, lowercase: bool = False) -> Column:
    """strip -> runs of space/hyphen to '_' -> drop everything outside [a-z0-9_].

    Without ``lowercase`` capitals are deleted, exactly as the reference does.
    """
    s = strip_ws(c.cast("string"))
    if lowercase:
        s = F.lower(s)
    s = F.regexp_replace(s, TITLE_SPACE_PATTERN, "_")
    return F.regexp_replace(s, TITLE_DROP_PATTERN, "")


def parse_labels(c: Column) -> Column:
    """'b, a ,a' -> ['a','b']: null -> '', split on commas, strip, drop blanks, distinct, sorted."""
    pieces = F.split(F.coalesce(c, F.lit("")), LABEL_SEPARATOR, -1)
    stripped = F.transform(pieces, strip_ws)
    return F.array_sort(F.array_distinct(F.filter(stripped, lambda x: x != F.lit(""))))


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (the library's zero_division=0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def split_hash(row_id: Column, seed: int = 42) -> Column:
    """Stable 32-bit hash of the row key, identical in DuckDB (see ``sql_split_hash``)."""
    h = F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def is_test(row_id: Column, test_size: float = 0.2, seed: int = 42) -> Column:
    return split_hash(row_id, seed) < F.lit(int(test_size * SPLIT_SPACE))


def fold_of(row_id: Column, k: int = 5, seed: int = 42) -> Column:
    """Fold id 0..k-1 from the same portable hash."""
    return F.pmod(split_hash(row_id, seed), F.lit(k)).cast("int")


def f1_from_counts(tp: Column, fp: Column, fn: Column) -> Column:
    """2tp / (2tp + fp + fn) from integers so every engine gets the same double."""
    return safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)


def truncate_text(c: Column, n: int = 100) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)
