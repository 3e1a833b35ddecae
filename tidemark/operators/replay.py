"""A table as it was before a number of recorded changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_list, col, cols, same_key
from tidemark.operators.merge import keep_unknown
from tidemark.operators.shape import union_by_name

RUN = "__run"


def _read_text(text: Column, data_type: T.DataType) -> Column:
    """A cell of a change record, which is text, in the type of its column."""
    if isinstance(data_type, T.StructType | T.ArrayType | T.MapType):
        return F.from_json(text, data_type)
    return text.try_cast(data_type)


def undo_changes(current: DataFrame, added: DataFrame, deleted: DataFrame, edited: DataFrame, keys: str | list[str], schema: T.StructType) -> DataFrame:
    """``current`` without the changes of runs whose records are ``added``, ``deleted`` and ``edited``, over ``schema``.

    The records carry their run's place in time as ``__run``. All runs are undone together, however many there are:
    of each key only the first time it came or went matters, and of each cell the first edit before that.

    - A key that first came in was not there.
    - A key that first went out was there with the row that went, less the edits before.
    - Any other key was there with its current row, less its edits.

    Keys have to be distinct in every version between. Null keys are keys like any other. Columns of ``schema`` that
    no row has are null; text that does not fit its type becomes null.
    """
    keys = as_list(keys)
    moves = added.select(*cols(keys), RUN, F.lit(True).alias("__came")).unionByName(deleted.select(*cols(keys), RUN, F.lit(False).alias("__came")))
    first = moves.groupBy(*cols(keys)).agg(F.min_by("__came", RUN).alias("__came"), F.min(RUN).alias("__until"))
    marks = first.select(*[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], "__came", "__until")
    met = same_key(cols(keys), [F.col(f"__key_{i}") for i in range(len(keys))])

    back = deleted.join(marks, met & (F.col(RUN) == F.col("__until")) & ~F.col("__came"), "left_semi").drop(RUN)
    there = union_by_name(keep_unknown(current, first, keys), back)

    before = edited.join(marks, met, "left").filter(F.col("__until").isNull() | (F.col(RUN) < F.col("__until")))
    cells = before.groupBy(*cols(keys), "name").agg(F.min_by(F.struct("old"), RUN).alias("cell"))
    # One entry for each edited column of a key.
    patches = cells.groupBy(*cols(keys)).agg(F.map_from_entries(F.collect_list(F.struct("name", "cell.old"))).alias("__old"))
    patches = patches.select(*[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], "__old")
    patched = there.join(patches, met, "left")
    made = []
    for field in schema.fields:
        if field.name not in there.columns:
            value = F.lit(None).cast(field.dataType)
        else:
            held = there.schema[field.name].dataType
            value = col(field.name)
            if held.simpleString() != field.dataType.simpleString():
                value = _read_text(value, field.dataType) if isinstance(held, T.StringType) else value.try_cast(field.dataType)
        if field.name not in keys:
            edit = F.map_contains_key("__old", F.lit(field.name))
            value = F.when(edit, _read_text(F.col("__old")[F.lit(field.name)], field.dataType)).otherwise(value)
        made.append(value.alias(field.name))
    return patched.select(*made)
