"""Clinical-note text expressions (cleaning, tokenising, joining, counting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icdspark.functions._util import as_col

# The note cleaner's six replacements (Java regex syntax, replace-all, in this order): tags of
# de-identified text, punctuation runs, line breaks, number-only words, one-character words, white space runs.
CLEANER_RULES: tuple[tuple[str, str], ...] = (
    (r"\[\*\*.*\*\*\]", "  "),
    (r'[ " \[ \] ( ) * \- : ; \ / { }  @ # $ % ^ & + ` ~ ? > < , !  = . _  | ]+', "  "),
    (r"[\n,\r]+", " "),
    (r"\W\d+\W", "  "),
    (r"\s[A-Z,a-z,0-9]\s", "  "),
    (r"\s{2,}", " "),
)


def clean_note(text) -> Column:
    """c01: apply the six cleaner replacements in order (null stays null)."""
    out = as_col(text)
    for pattern, replacement in CLEANER_RULES:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(replacement))
    return out


def tokenize(text) -> Column:
    """c05: lower-case and split on single whitespace characters.

    Same result as ``ml.feature.Tokenizer`` (Java ``String.split``): a leading
    separator yields a leading ``''`` token, trailing empty tokens are dropped,
    an all-whitespace text gives no token and an empty text gives ``['']``.
    """
    lowered = F.lower(as_col(text))
    stripped = F.rtrim(lowered, F.lit(JAVA_WHITESPACE))
    return (
        F.when(lowered == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, r"\s"))
    )


# Fixed value: Java's \s class (the tokeniser's separators).
JAVA_WHITESPACE = " \t\n\x0b\f\r"


def tokenized_text(text) -> Column:
    """c05 + c06 fused: the tokens of ``tokenize(text)`` joined by one space.

    Equal to ``join_tokens(tokenize(text))`` without building the array:
    trailing separators vanish, every remaining separator becomes one space.
    """
    stripped = F.rtrim(F.lower(as_col(text)), F.lit(JAVA_WHITESPACE))
    return F.translate(stripped, JAVA_WHITESPACE, " " * len(JAVA_WHITESPACE))


def join_tokens(tokens, sep: str = " ") -> Column:
    """c06: null-safe join of a token array (null array -> null, not '')."""
    tokens = as_col(tokens)
    return F.when(tokens.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(tokens, sep))


def join_vector(vector, sep: str = " ") -> Column:
    """c07: render an ``array<double>`` vector as space-joined numbers."""
    vector = as_col(vector)
    return F.when(vector.isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(vector.cast("array<string>"), sep)
    )


def token_count(tokens) -> Column:
    """c08: number of tokens in a token array."""
    return F.size(as_col(tokens))


def split_on_space(text) -> Column:
    """c10: split on one space; empty pieces are kept."""
    return F.split(as_col(text), " ")


def text_length(text) -> Column:
    """c09: length in tokens as ``size(split(text, ' '))`` ('' counts 1)."""
    return F.size(split_on_space(text))


# Fixed value: the characters Python's ``str.split()`` treats as whitespace.
PY_WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def split_whitespace(text) -> Column:
    """c11: split on whitespace runs with no empty pieces (Python ``str.split()``)."""
    return F.filter(F.split(as_col(text), PY_WHITESPACE), lambda t: t != F.lit(""))
