"""Text expressions shared by the operators.

All patterns are written so that Java regex (Spark) and RE2 (the DuckDB
oracle) read them the same way: explicit character classes, no lookaround.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Whitespace as Python's str.isspace() defines it: \t \n \x0b \x0c \r,
# \x1c-\x1f, \x85 and the Unicode separators (category Z).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
# Python's string.punctuation, in its natural order:
#   !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Line ends recognised by the longest-line filter.
LINE_END = r"\r\n|\n|\r"
# ----------------------------------------------------------------------------


def _class_escape(chars: str) -> str:
    return "".join("\\" + c if c in "\\[]^-" else c for c in chars)


# characters dropped by the exact-dedup normalization: whitespace, decimal digits
# and ASCII punctuation
NON_CHARACTER_CLASS = "[" + WS_CLASS[1:-1] + r"\p{Nd}" + _class_escape(ASCII_PUNCTUATION) + "]"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col_(c), rf"\A{WS_CLASS}+|{WS_CLASS}+\z", "")


def code_points(c: str | Column) -> Column:
    """The characters (code points) of a string as an array."""
    return F.regexp_extract_all(col_(c), F.lit(r"(?s)(.)"), 1)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    A computed array referenced inside another lambda (``transform`` over
    positions, say) would otherwise be recomputed for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def materialize_column(df, name: str, c: Column):
    """Add ``c`` as column ``name`` through a one-row ``explode``.

    The Generate node is a boundary Catalyst does not merge across, so a
    Python UDF reading ``name`` gets a plain column as input and is always
    planned as its own Arrow stage (a deep higher-order expression inlined
    into a UDF argument is otherwise left unevaluable by the planner).
    """
    return df.select("*", F.explode(F.array(c)).alias(name))


def slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[pa.Array]:
    """An Arrow batch of texts in order, in slices of about ``size`` bytes or one text."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy()
    lo, done = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(ends.searchsorted(done + size, "right")))
        yield texts.slice(lo, hi - lo)
        lo, done = hi, int(ends[hi - 1])


def text_slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """The slices as lists (null: empty): only one is in Python at a time."""
    for part in slices(texts, size):
        yield ["" if t is None else t for t in part.to_pylist()]
