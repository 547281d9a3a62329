"""Paging through a sorted result without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, order_by: Sequence[Column | str], page_number: int = 1, page_size: int = 10) -> DataFrame:
    """Rows ``(page_number - 1) * page_size + 1`` … ``page_number * page_size``
    of ``df`` sorted by ``order_by``.

    ``orderBy().offset().limit()`` plans as a single TakeOrderedAndProject: each
    partition keeps its best ``offset + limit`` rows, so no partition sends all
    its rows anywhere and there is no single-partition window. Make
    ``order_by`` total (end with a unique key) for stable pages.
    """
    if page_number < 1 or page_size < 1:
        raise ValueError("page_number and page_size must be positive")
    return df.orderBy(*order_by).offset((page_number - 1) * page_size).limit(page_size)


def page_after(df: DataFrame, value: str, key: str, after: tuple | None = None, page_size: int = 10) -> DataFrame:
    """Keyset paging: the ``page_size`` rows that follow the row with
    (``value``, ``key``) = ``after`` when sorted by ``value`` descending (null
    last), then ``key`` ascending. Every task keeps ``page_size`` rows however
    far the page is; ``key`` must be unique and not null."""
    if page_size < 1:
        raise ValueError("page_size must be positive")
    if after is not None:
        last, name = after
        v, k = F.col(value), F.col(key)
        if last is None:
            df = df.where(v.isNull() & (k > F.lit(name)))
        else:
            df = df.where((v < F.lit(last)) | ((v == F.lit(last)) & (k > F.lit(name))) | v.isNull())
    return df.orderBy(F.desc_nulls_last(value), F.asc(key)).limit(page_size)


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``rows``: the number of rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
