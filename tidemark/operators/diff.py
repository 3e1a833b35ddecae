"""Added and deleted rows and edited cells between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_list, as_text, col, cols, row_digest, same_key
from tidemark.operators.merge import keep_known, keep_unknown
from tidemark.operators.shape import common_names


def rows_added(new: DataFrame, old: DataFrame, keys: str | list[str]) -> DataFrame:
    return keep_unknown(new, old, keys)


def rows_deleted(new: DataFrame, old: DataFrame, keys: str | list[str]) -> DataFrame:
    return keep_unknown(old, new, keys)


def _align(new: DataFrame, old: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides over ``names``, as text where their types differ."""
    sides: tuple[list, list] = ([], [])
    for n in names:
        a, b = new.schema[n].dataType, old.schema[n].dataType
        same = a.simpleString() == b.simpleString()
        sides[0].append(col(n) if same else as_text(n, a).alias(n))
        sides[1].append(col(n) if same else as_text(n, b).alias(n))
    return new.select(*sides[0]), old.select(*sides[1])


def changed_keys(new: DataFrame, old: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that were added, deleted or edited, with that word as ``status``.

    Only keys and row fingerprints are shuffled, never whole rows, and both
    versions meet in one aggregation. A key that occurs twice in a version has the
    status ``repeated``, as edits are then not defined.
    """
    keys = as_list(keys)
    names = common_names(new, old)
    values = [n for n in names if n not in keys]
    new, old = _align(new, old, names)
    tagged = new.select(*cols(keys), F.lit(1).alias("__new"), row_digest(new, values).alias("__row")).unionByName(
        old.select(*cols(keys), F.lit(0).alias("__new"), row_digest(old, values).alias("__row"))
    )
    met = tagged.groupBy(*cols(keys)).agg(
        F.sum("__new").alias("__n_new"),
        F.sum(1 - F.col("__new")).alias("__n_old"),
        F.min("__row.h1").alias("__min1"),
        F.max("__row.h1").alias("__max1"),
        F.min("__row.h2").alias("__min2"),
        F.max("__row.h2").alias("__max2"),
    )
    repeated = (F.col("__n_new") > 1) | (F.col("__n_old") > 1)
    same = (F.col("__min1") == F.col("__max1")) & (F.col("__min2") == F.col("__max2"))
    status = (
        F.when(repeated, F.lit("repeated"))
        .when(F.col("__n_old") == 0, F.lit("added"))
        .when(F.col("__n_new") == 0, F.lit("deleted"))
        .when(~same, F.lit("edited"))
    )
    return met.select(*cols(keys), status.alias("status")).filter("status IS NOT NULL")


def cells_edited(
    new: DataFrame, old: DataFrame, keys: str | list[str], changed: DataFrame | None = None
) -> DataFrame:
    """One row per changed cell of a key in both versions: keys, name, new, old.

    Cells are compared as stored and shown as text. ``changed`` takes the result
    of ``changed_keys`` when it is already at hand; whole rows are read only for
    the keys it lists as edited.
    """
    keys = as_list(keys)
    names = common_names(new, old)
    values = [n for n in names if n not in keys]
    if changed is None:
        # Used for one side of one join only, so it is worked out once.
        changed = changed_keys(new, old, keys)
    edited = changed.filter("status = 'edited'")
    new, old = _align(new, old, names)
    # The listed keys are distinct, and rows that are left on one side pick those of the other.
    left = keep_known(new, edited, keys, keys_are_distinct=True)
    right = old.toDF(*[f"__old_{i}" for i in range(len(names))])
    place = {n: f"__old_{i}" for i, n in enumerate(names)}
    both = left.join(right, same_key(cols(keys), [F.col(place[k]) for k in keys]))
    cells = []
    for n in values:
        data_type = new.schema[n].dataType
        cells.append(
            F.struct(
                F.lit(n).alias("name"),
                as_text(n, data_type).alias("new"),
                as_text(place[n], data_type).alias("old"),
            )
        )
    if not cells:
        empty = [F.lit("").alias(x) for x in ("name", "new", "old")]
        return both.select(*cols(keys), *empty).filter(F.lit(False))
    differing = F.filter(F.array(*cells), lambda c: ~c["new"].eqNullSafe(c["old"]))
    return both.select(*cols(keys), F.inline(differing))


def change_counts(
    added: DataFrame, edited: DataFrame, deleted: DataFrame, keys: str | list[str]
) -> DataFrame:
    """Numbers of added rows, edited keys and deleted rows."""
    keys = as_list(keys)
    parts = [
        added.agg(F.count(F.lit(1)).alias("n_added")),
        edited.select(*cols(keys)).distinct().agg(F.count(F.lit(1)).alias("n_edited")),
        deleted.agg(F.count(F.lit(1)).alias("n_deleted")),
    ]
    total = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return total.agg(*[F.sum(n).alias(n) for n in ("n_added", "n_edited", "n_deleted")])


def count_changed(changed: DataFrame) -> DataFrame:
    """The same numbers from the result of ``changed_keys``."""
    return changed.agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(f"n_{s}") for s in ("added", "edited", "deleted")]
    )


