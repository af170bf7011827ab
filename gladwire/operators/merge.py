"""Insert-or-update of a batch into a table.

Everything rests on ``collapse``: of several versions of a row the kept columns
come from the first, all other columns, nulls included, from the last. The
versions may be repeats inside a batch or the same key in older and newer parts
of a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.session import written


def collapse(
    versions: DataFrame,
    keys: str | Sequence[str],
    order: str,
    kept: Sequence[str] = (),
    last: Column | None = None,
) -> DataFrame:
    """One row per key: ``kept`` columns of the first version, the others of the last.

    Both picks combine on the map side, so a key with very many versions costs
    one row per task in the shuffle. ``order`` is unique within a key; ``last``,
    unique as well, orders the versions for the columns that are not kept.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in versions.columns if c not in keys and c != order]
    first = [c for c in others if c in kept]
    final = [c for c in others if c not in kept]
    picks: list[Column] = []
    if first:
        picks.append(F.min_by(F.struct(*first), order).alias("_first"))
    if final:
        picks.append(F.max_by(F.struct(*final), F.col(order) if last is None else last).alias("_last"))
    one = versions.groupBy(*keys).agg(*picks) if picks else versions.select(*keys).distinct()
    parts = (["_first.*"] if first else []) + (["_last.*"] if final else [])
    return one.select(*keys, *parts).select(*[c for c in versions.columns if c != order])


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str = "url",
    order: str = "seq",
    kept: Sequence[str] = ("id", "created_at", "source_id"),
    overwrite: Sequence[str] | None = None,
) -> DataFrame:
    """The target after the batch: new keys inserted, known ones overwritten.

    ``kept`` columns of a known row stay. A target column that is neither kept
    nor in ``overwrite`` (default: all columns of the batch) stays as well.
    """
    one = collapse(batch, key, order, kept)
    written = [c for c in (overwrite or one.columns) if c in one.columns]
    new = one.select(F.col(key), F.struct(*[c for c in one.columns if c != key]).alias("_new"))
    old = target.select(F.col(key), F.struct(*[c for c in target.columns if c != key]).alias("_old"))
    joined = old.join(new, key, "full_outer")
    columns = []
    for c in target.columns:
        if c == key:
            columns.append(F.col(key))
            continue
        kind = target.schema[c].dataType
        fresh = F.col(f"_new.{c}") if c in one.columns else F.lit(None)
        if c in kept or c not in written:
            inserted = fresh if (c in kept or c in written) else F.lit(None)
            value = F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(inserted)
        else:
            value = F.when(F.col("_new").isNotNull(), fresh).otherwise(F.col(f"_old.{c}"))
        columns.append(value.cast(kind).alias(c))
    return joined.select(*columns)


def _without(rows: DataFrame, taken: DataFrame, unique: Sequence[str]) -> DataFrame:
    """Rows that share no unique value with the taken ones; nulls clash with nothing."""
    for column in unique:
        rows = rows.join(taken.select(column).distinct(), column, "left_anti")
    return rows


def _first_per_value(rows: DataFrame, column: str, order: str) -> DataFrame:
    """The ``order`` of the first row of each value, and of all rows without a value."""
    firsts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias(order))
    return firsts.select(order).unionByName(rows.filter(F.col(column).isNull()).select(order))


def insert_or_ignore(
    target: DataFrame, batch: DataFrame, unique: Sequence[str], order: str = "seq"
) -> DataFrame:
    """The target and the batch rows that clash with no row of it on any unique column.

    Rows of one batch that clash among themselves are taken in ``order``, and a
    row loses only to rows that got in. With one unique column the first row of
    each value gets in. With several, rows that are first for all their values
    get in, rows that clash with those are out, and the rest goes another
    round, until none is left; its rows are written in between.
    """
    fresh = _without(batch, target, unique)
    if len(unique) == 1:
        named = fresh.filter(F.col(unique[0]).isNotNull())
        nameless = fresh.filter(F.col(unique[0]).isNull()).drop(order)
        rows = collapse(named, unique[0], order, kept=named.columns).unionByName(nameless)
    else:
        rows = _admit_in_rounds(fresh, unique, order).drop(order)
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def _admit_in_rounds(fresh: DataFrame, unique: Sequence[str], order: str) -> DataFrame:
    rest, admitted = written(fresh, "rest"), fresh.limit(0)
    while not rest.isEmpty():
        firsts = rest
        for column in unique:
            firsts = firsts.join(_first_per_value(rest, column, order), order, "left_semi")
        winners = written(firsts, "winners")
        admitted = admitted.unionByName(winners)
        undecided = rest.join(winners.select(order), order, "left_anti")
        rest = written(_without(undecided, winners, unique), "rest")
    return admitted


def replace_by_key(cache: DataFrame, entries: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Insert entries, or replace the rows of their keys whole; the last entry wins."""
    return upsert(cache, entries, key, order, kept=())
