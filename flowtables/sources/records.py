"""Text records to typed columns: JSON lines, delimited lines, queue messages, change records.

All functions take a frame with a text column, bounded or streaming, and never infer a type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.text import ColumnLike, _col, all_fields, has_fields, trim_control
from flowtables.schemas import CLICK_JSON, CLICK_NAMES, USER_CHANGE


def json_columns(df: DataFrame, schema: T.StructType, text: str = "value",
                 names: Sequence[str] | None = None) -> DataFrame:
    """JSON text as columns. `schema` has the names of the JSON (which are case-sensitive), `names` the new ones."""
    out = df.select(F.from_json(text, schema).alias("__j"))
    return out.select(*[F.col(f"__j.`{f}`").alias(n)
                        for f, n in zip(schema.names, names or schema.names, strict=True)])


def click_log(df: DataFrame, text: str = "value") -> DataFrame:
    """Click records, one JSON object per line."""
    return json_columns(df, CLICK_JSON, text, CLICK_NAMES)


def _typed(schema: T.StructType, strip: bool) -> list[Column]:
    out = []
    for i, f in enumerate(schema.fields):
        part = F.try_element_at(F.col("__f"), F.lit(i + 1))
        if strip or not isinstance(f.dataType, T.StringType):
            part = trim_control(part)
        out.append(part.try_cast(f.dataType).alias(f.name))
    return out


def parse_delimited(df: DataFrame, schema: T.StructType, text: str = "value", sep: str = ",",
                    strip: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Delimited records with as many fields as the schema; others are left out.

    A field that is no value of its type becomes NULL; `rejected` lists such records. `keep` names further
    columns of the input to carry along.
    """
    right = df.where(has_fields(text, len(schema.fields), sep))
    return right.select(*keep, all_fields(text, sep).alias("__f")).select(*keep, *_typed(schema, strip))


def rejected(df: DataFrame, schema: T.StructType, text: str = "value", sep: str = ",") -> DataFrame:
    """Records with the wrong number of fields or a field that is no value of its type, with the `reason`.

    A NULL record has no fields, so it is listed too.
    """
    right = F.coalesce(has_fields(text, len(schema.fields), sep), F.lit(False))
    checked = df.select(F.col(text), right.alias("__n"), all_fields(text, sep).alias("__f"))
    bad = F.lit(False)
    for i, (f, typed) in enumerate(zip(schema.fields, _typed(schema, False), strict=True)):
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (F.try_element_at(F.col("__f"), F.lit(i + 1)).isNotNull() & typed.isNull())
    reason = F.when(~F.col("__n"), "field count").when(bad, "field value")
    return checked.select(F.col(text), reason.alias("reason")).where(F.col("reason").isNotNull())


def message_csv(df: DataFrame, schema: T.StructType, sep: str = ",", comment: str | None = None,
                value: ColumnLike = "value") -> DataFrame:
    """Queue messages whose value is one CSV record; unreadable fields become NULL, comment lines are left out.

    A NULL message gives a row of NULLs, with and without `comment`.
    """
    text = _col(value).cast("string")
    if comment:
        df = df.where(~F.coalesce(F.startswith(text, F.lit(comment)), F.lit(False)))
    options = {"sep": sep, "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.select(F.from_csv(text, ddl, options).alias("__r")).select("__r.*")


def change_records(df: DataFrame, schema: T.StructType = USER_CHANGE, text: str = "value") -> DataFrame:
    """Change-log JSON (`op`, `before`, `after`, `ts_ms`): a full snapshot first (`op` r), then c, u and d."""
    return json_columns(df, schema, text)
