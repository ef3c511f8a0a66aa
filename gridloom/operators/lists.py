"""Records repeated once per value of one column, folded into a list, and named unions of releases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.common import materialise, with_ordinal


def collapse_multivalue(
    df: DataFrame,
    column: str,
    order: str | None = None,
    group_id: str | None = "identifier",
    split_every: int | None = None,
) -> DataFrame:
    """One row per combination of all other columns, with the values of ``column`` as ``<column>_list``.

    NULL values are kept. ``order`` names the column that orders the list and is not itself part of the
    group; without it the list is sorted by value. A list is one cell of the result: where a group can
    outgrow that, ``split_every`` starts a further row, told apart by ``list_part``, each time the
    (numeric) order passes a multiple of it, so that no task holds the whole group.
    ``group_id`` numbers the rows in the order of their keys. Folded rows are stored first, and only their keys are put
    in order, without the lists; ``group_id=None`` leaves both out.
    """
    keys = [c for c in df.columns if c not in (column, order)]
    if split_every:
        if order is None:
            raise ValueError("split_every needs an order column")
        df = df.withColumn("list_part", F.floor(F.col(order) / F.lit(split_every)))
        keys.append("list_part")
    rank = F.col(order) if order else F.col(column)
    items = F.sort_array(F.collect_list(F.struct(rank.alias("rank"), F.col(column).alias("value"))))
    values = F.transform(items, lambda item: item["value"])
    folded = df.groupBy(*keys).agg(values.alias(f"{column}_list"))
    if not group_id:
        return folded
    stored = materialise(folded.withColumn("_row", F.monotonically_increasing_id()), "folded")
    numbered = with_ordinal(stored.select(*keys, "_row"), keys, group_id)
    return stored.join(numbered.select("_row", group_id), "_row").drop("_row")


def list_to_text(values: Column, separator: str = ", ") -> Column:
    """List as joined text; a NULL entry shows as ``NA``."""
    return F.array_join(values.cast("array<string>"), separator, "NA")


@dataclass(frozen=True)
class TaggedFrame:
    """A release to be stacked: its tag, rows to keep, and columns to convert first."""

    tag: str
    frame: DataFrame
    keep: Column | None = None
    casts: dict[str, Column] = field(default_factory=dict)


def tagged_union_cutoff(frames: Sequence[TaggedFrame], tag_column: str = "file") -> DataFrame:
    """Stack releases by column name, each tagged and cut off by its own condition.

    A leading row to drop is a condition on the row number like any other.
    """
    ready = [
        (f.frame if f.keep is None else f.frame.where(f.keep)).withColumns({**f.casts, tag_column: F.lit(f.tag)})
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ready)
