"""Column type inference over text columns, in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names that mean a timestamp whatever their text, cell texts that mean
# "no value", number patterns, and the type names with their Spark types.
TIME_NAMES = ("Date", "Datetime")
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
INTEGER_PATTERN = r"^\s*+[+-]?[0-9]++\s*+$"
FLOAT_PATTERN = r"^\s*+[+-]?(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?\s*+$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"
UNSIGNED_MAX = "18446744073709551615"
TYPES = {
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "VARCHAR(255)": T.StringType(),
}


# What a cell can be, one bit each.
_BLANK, _POSITIVE, _NEGATIVE, _UNSIGNED, _FRACTION, _TEXT = 1, 2, 4, 8, 16, 32


def infer_types(text: DataFrame, null_texts: Sequence[str] = NULL_TEXTS) -> DataFrame:
    """``(position, column, type)`` of all-text columns.

    INTEGER needs an integer in every row; blanks turn it into FLOAT, as does having no value at
    all; then come the time names; everything else is VARCHAR(255). Each column is folded to the set
    of cell kinds it holds, eight bytes per task, so the pass is a scan and nothing else.
    """
    kinds = [f"bit_or({_kind(name, null_texts)}) AS k{i}" for i, name in enumerate(text.columns)]
    verdicts = [
        f"named_struct('position', {i}, 'column', {_quoted(name)}, 'type', {_verdict(f'k{i}', name)})"
        for i, name in enumerate(text.columns)
    ]
    return text.agg(*[F.expr(kind) for kind in kinds]).selectExpr(f"inline(array({', '.join(verdicts)}))")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(name: str, null_texts: Sequence[str]) -> str:
    cell = "`" + name.replace("`", "``") + "`"
    blanks = _listed(null_texts)
    # The patterns come first: a cast that fails costs far more than a pattern that does not match.
    signed = f"CASE WHEN try_cast({cell} AS BIGINT) < 0 THEN {_NEGATIVE} WHEN try_cast({cell} AS BIGINT) >= 0 THEN {_POSITIVE} END"
    return f"""CASE
        WHEN {cell} IS NULL OR {cell} IN ({blanks}) THEN {_BLANK}
        WHEN {cell} RLIKE r'{INTEGER_PATTERN}' THEN coalesce(
            {signed}, if(try_cast({cell} AS DECIMAL(38, 0)) BETWEEN 0 AND {UNSIGNED_MAX}, {_UNSIGNED}, {_TEXT}))
        WHEN {cell} RLIKE r'{FLOAT_PATTERN}' AND abs(try_cast({cell} AS DOUBLE)) < double('infinity') THEN {_FRACTION}
        WHEN {cell} RLIKE r'{INFINITY_PATTERN}' THEN {_FRACTION}
        ELSE {_TEXT} END"""


def _verdict(kinds: str, name: str) -> str:
    def only(*allowed: int) -> str:
        return f"({kinds} & {63 - sum(allowed)}) = 0"

    other = "TIMESTAMP" if name in TIME_NAMES else "VARCHAR(255)"
    return f"""CASE
        WHEN {only(_POSITIVE, _NEGATIVE)} OR {only(_POSITIVE, _UNSIGNED)} THEN 'INTEGER'
        WHEN {only(_BLANK, _POSITIVE, _NEGATIVE, _FRACTION)} THEN 'FLOAT'
        ELSE '{other}' END"""


def _listed(texts: Sequence[str]) -> str:
    return ", ".join(_quoted(t) for t in texts)


def typed_cell(name: str, kind: T.DataType, null_texts: Sequence[str] = NULL_TEXTS) -> tuple[Column, Column]:
    """The value of a text cell under a type, and whether the cell does not fit it.

    The rule of the inference: blanks around a value do not count, the null texts are no value, numbers
    are what its patterns call so. Text stays as it is, so a symbol may well be called NA.
    """
    if isinstance(kind, T.StringType):
        return F.col(f"`{name}`"), F.lit(False)
    cell = "trim(`" + name.replace("`", "``") + "`)"
    blank = f"({cell} IS NULL OR {cell} IN ({_listed(null_texts)}))"
    value = f"try_cast({cell} AS {kind.simpleString()})"
    if isinstance(kind, T.IntegralType):
        value = f"CASE WHEN {cell} RLIKE r'{INTEGER_PATTERN}' THEN {value} END"
    elif isinstance(kind, T.FractionalType):
        value = f"CASE WHEN {cell} RLIKE r'{FLOAT_PATTERN}' OR {cell} RLIKE r'{INFINITY_PATTERN}' THEN {value} END"
    typed = F.expr(f"CASE WHEN NOT {blank} THEN {value} END")
    return typed, F.expr(f"NOT {blank}") & typed.isNull()


def inferred_struct(inferred: DataFrame, text_columns: Sequence[str] = ()) -> T.StructType:
    """Spark schema of an inference result; reads one row per column. ``text_columns``, by name in any
    case, are text whatever they hold."""
    rows = inferred.orderBy("position").collect()
    text = {name.lower() for name in text_columns}
    return T.StructType(
        [T.StructField(r["column"], T.StringType() if r["column"].lower() in text else TYPES[r["type"]]) for r in rows]
    )
