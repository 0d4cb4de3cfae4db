"""Seek paging: a page is found by the place of the row it follows, not by a count of rows (LIM1, LIM3).

A cursor is the place of a row in the list's order: its sort value (or null) and its tie-breaking
ids. It becomes a predicate over the sort column that is pushed into the scan, so page 1000 reads
what lies behind page 999, and every task keeps one page of rows. Order is as for the
offset form: ascending with nulls last or descending with nulls first, ids ascending. Going back,
the rows before the cursor are taken in reversed order and put right again.
"""

from __future__ import annotations

import base64
import binascii
import json
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class BadCursor(ValueError):
    """A cursor that no page of this list gave out (the dashboard answers 400)."""


@dataclass(frozen=True)
class Order:
    """The order of a list: a sort column, its direction, and unique ids that break ties."""

    column: str
    ascending: bool
    ids: tuple[str, ...] = ("id",)

    def columns(self, backward: bool = False) -> list[Column]:
        c = F.col(self.column)
        main = c.asc_nulls_last() if self.ascending != backward else c.desc_nulls_first()
        return [main] + [F.col(i).desc() if backward else F.col(i).asc() for i in self.ids]

    def cursor(self) -> Column:
        """Each row's cursor: base64 of a JSON list of the sort value and the ids, as text."""
        return F.base64(F.to_json(F.array(*[F.col(c).cast("string") for c in (self.column, *self.ids)]), {"ignoreNullFields": "false"})
                        .cast("binary"))

    def decode(self, cursor: str) -> list[str | None]:
        try:
            place = json.loads(base64.b64decode("".join(cursor.split()), validate=True))
        except (binascii.Error, ValueError) as e:
            raise BadCursor(cursor) from e
        if not isinstance(place, list) or len(place) != 1 + len(self.ids) or not all(isinstance(x, str) for x in place[1:]):
            raise BadCursor(cursor)
        return place

    def beyond(self, df: DataFrame, cursor: str, backward: bool = False) -> Column:
        """True for the rows behind the cursor (or before it)."""
        value, *ids = self.decode(cursor)
        c = F.col(self.column)

        def literal(name: str, text: str) -> Column:
            return F.lit(text).cast(df.schema[name].dataType)

        def further(x: Column, y: Column) -> Column:
            return (x < y) if backward else (x > y)

        pairs = [(F.col(n), literal(n, t)) for n, t in zip(self.ids, ids)]
        tied = reduce(lambda rest, p: further(*p) | ((p[0] == p[1]) & rest), reversed(pairs[:-1]), further(*pairs[-1]))
        nulls_ahead = self.ascending != backward  # nulls lie on the far side of every value
        if value is None:
            here = c.isNull() & tied
            return here if nulls_ahead else here | c.isNotNull()
        v = literal(self.column, value)
        past = (c > v) if self.ascending != backward else (c < v)
        inside = past | ((c == v) & tied)
        return inside | c.isNull() if nulls_ahead else inside


def seek(df: DataFrame, order: Order, size: int, cursor: str | None = None, backward: bool = False) -> DataFrame:
    """One page with a column `cursor`: the first rows (the last ones, backward), or those next to the cursor's row."""
    if cursor:
        df = df.where(order.beyond(df, cursor, backward))
    page = df.orderBy(*order.columns(backward)).limit(size)
    page = page.orderBy(*order.columns()) if backward else page
    return page.withColumn("cursor", order.cursor())
