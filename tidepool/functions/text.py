"""Short-text column functions (PRJ11-PRJ15).

Splitting, filtering and lengths follow Java ``String`` rules where they differ
from Spark's defaults, so counts equal the reference's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's stop-word list) ----------------
STOP_WORDS = ("a", "the", "to", "an", "you", "me", "i", "and", "my", "i'm", "")
# -----------------------------------------------------------------------------

# Java String.trim() strips every char <= U+0020; Spark's trim only strips spaces.
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    return F.btrim(_col(c), F.lit(JAVA_TRIM_CHARS))


def split_words(text) -> Column:
    """``text.split(" ")`` as an array: trailing empty tokens dropped, inner ones kept."""
    return F.split(F.rtrim(_col(text)), " ")


def tokenize(df: DataFrame, text: str = "text", out: str = "word", keep=()) -> DataFrame:
    """PRJ11: one row per space-separated token (flatMap of split)."""
    return df.select(*[F.col(k) for k in keep], F.explode(split_words(text)).alias(out))


def is_hashtag(word) -> Column:
    """PRJ12: case-sensitive ``startsWith("#")``; a bare ``#`` counts."""
    return _col(word).startswith("#")


def is_stop_word(word) -> Column:
    """PRJ13: lower-cased, Java-trimmed token in the stop list (the empty token included)."""
    return java_trim(F.lower(_col(word))).isin(*STOP_WORDS)


def hashtags(df: DataFrame, text: str = "text", out: str = "tag", keep=()) -> DataFrame:
    return tokenize(df, text, out, keep).where(is_hashtag(out))


def content_words(df: DataFrame, text: str = "text", out: str = "word", keep=()) -> DataFrame:
    """Tokens that are not stop words; the original case is what gets counted."""
    return tokenize(df, text, out, keep).where(~is_stop_word(out))


def utf16_length(text) -> Column:
    """PRJ15: ``String.length`` (UTF-16 code units); astral chars count twice."""
    return (F.octet_length(F.encode(_col(text), "UTF-16BE")) / 2).cast("bigint")
