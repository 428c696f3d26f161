"""ICD-9 code normalisation (placing the decimal point)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icdspark.functions._util import as_col

# Diagnosis codes take the dot after 3 characters, or after 4 for
# external-cause codes starting with "E"; procedure codes after 2 characters.
DIAG_DOT = 3
DIAG_E_DOT = 4
PROC_DOT = 2
E_PREFIX = "E"


def strip_leading_zeros(code) -> Column:
    """Drop leading zeros but keep one character ('0000' -> '0', '' -> '')."""
    return F.regexp_replace(as_col(code), r"^0+(?!$)", "")


def _literal_whitespace_replace(code: Column) -> Column:
    # The loader's whitespace step is a literal (non-regex) replacement of the
    # three characters "\s+"; real whitespace is therefore kept.
    return F.replace(code, F.lit("\\s+"), F.lit(""))


def _dot(code: Column, n: int) -> Column:
    return F.concat(F.substring(code, 1, n), F.lit("."), F.substring(code, n + 1, 1 << 30))


def _dot_diag(code: Column) -> Column:
    return (
        F.when(code.startswith(E_PREFIX) & (F.length(code) > DIAG_E_DOT), _dot(code, DIAG_E_DOT))
        .when(~code.startswith(E_PREFIX) & (F.length(code) > DIAG_DOT), _dot(code, DIAG_DOT))
        .otherwise(code)
    )


def dot_diagnosis(code, strip_zeros: bool = True) -> Column:
    """c02: loader rule for diagnosis codes ('4019' -> '401.9', 'E8790' -> 'E879.0').

    ``strip_zeros=True`` keeps the loader's leading-zero stripping ('0389' -> '389');
    ``False`` gives the canonical dotted code.
    """
    code = _literal_whitespace_replace(as_col(code))
    if strip_zeros:
        code = strip_leading_zeros(code)
    return _dot_diag(code)


def dot_procedure(code, strip_zeros: bool = True) -> Column:
    """c03: loader rule for procedure codes: always a dot after 2 ('66' -> '66.')."""
    code = _literal_whitespace_replace(as_col(code))
    if strip_zeros:
        code = strip_leading_zeros(code)
    return _dot(code, PROC_DOT)


def reformat_code(code, is_diag: bool) -> Column:
    """c04: description-file rule: remove every dot, no zero stripping, then dot."""
    code = F.replace(as_col(code), F.lit("."), F.lit(""))
    return _dot_diag(code) if is_diag else _dot(code, PROC_DOT)
