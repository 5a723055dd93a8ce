"""Names: the file name of a path, and names put together from columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def basename_col(path: Column | str) -> Column:
    """The last element of a path; slashes at the end do not count."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def template_parts(
    template: str, open_marker: str = "{", close_marker: str = "}"
) -> tuple[list[tuple[str, str]], str]:
    """``[(text before, column), ...]`` and the text after the last column.

    A column name is what stands between a close marker and the nearest open marker before it.
    """
    opening, closing = re.escape(open_marker), re.escape(close_marker)
    marked = re.compile(f"{opening}([^{opening}{closing}]*){closing}")
    pieces = marked.split(template)
    texts, columns = pieces[0::2], pieces[1::2]
    if not columns or open_marker in texts[-1] or any(close_marker in text for text in texts):
        raise ValueError(
            f"expected something like ${open_marker}col1{close_marker}_"
            f"${open_marker}col2{close_marker}.jpg, got {template!r}"
        )
    return list(zip(texts, columns)), texts[-1]


def template_columns(
    template: str, open_marker: str = "{", close_marker: str = "}"
) -> list[str]:
    """The column names a template refers to, in order."""
    return [column for _, column in template_parts(template, open_marker, close_marker)[0]]


def derive_name(
    df: DataFrame,
    template: str,
    out: str,
    open_marker: str = "{",
    close_marker: str = "}",
) -> DataFrame:
    """``df`` with a column ``out`` that fills the template from the row's columns.

    ``${a}`` and ``{a}`` both stand for column ``a``. A NULL in any of them makes the name NULL.
    """
    parts, rest = template_parts(template, open_marker, close_marker)
    pieces = []
    for text, column in parts:
        if column not in df.columns:
            raise ValueError(f"{template!r} refers to {column!r}, which is not a column")
        pieces.append(F.lit(text.removesuffix("$")))
        pieces.append(df[column].cast("string"))
    return df.withColumn(out, F.concat(*pieces, F.lit(rest)))
