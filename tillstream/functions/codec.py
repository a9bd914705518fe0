"""JSON text to records and back.

Numbers reach us quoted or bare depending on the change-log tool, and ``from_json`` into a
numeric field yields NULL for a quoted one. So records are read as text once and cast field
by field; a field that does not cast is NULL, a line that is no JSON object is marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_text(value: Column, shape: str) -> Column:
    """Struct of the given DDL shape, with the raw line kept in ``_corrupt`` when malformed."""
    return F.from_json(value, f"{shape}, {CORRUPT} string",
                       {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})


def parse_envelope(messages: DataFrame, shape: str, value: str = "value") -> DataFrame:
    """Add the members named in ``shape``, and ``malformed``, true for text that is no object.

    The members come out of a generator, so the text is parsed once however often later
    filters and projections use them; as a plain expression it would be repeated in each.
    """
    parsed = messages.select("*", F.inline(F.array(parse_text(F.col(value), shape))))
    # Blank text yields no corrupt record, as there is nothing in it to keep.
    blank = F.coalesce(F.trim(value) == "", F.lit(True))
    return parsed.withColumn("malformed", blank | F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def as_type(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(TIME_FORMAT))
    return text.try_cast(kind)


def parse_typed(messages: DataFrame, schema: T.StructType, value: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per message; ``keep`` names message columns to carry along."""
    shape = ", ".join(f"`{f.name}` string" for f in schema.fields)
    rows = messages.select(*keep, F.inline(F.array(F.from_json(F.col(value), shape))))
    return rows.select(*keep, *[as_type(F.col(f.name), f.dataType).alias(f.name)
                                for f in schema.fields])


def parse_marked(messages: DataFrame, schema: T.StructType, required: tuple[str, ...] = (),
                 value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """As ``parse_typed``, with the raw ``value`` and ``malformed``: true for text that is no
    object, and for records without one of the ``required`` fields."""
    shape = ", ".join(f"`{f.name}` string" for f in schema.fields)
    marked = parse_envelope(messages.select(*keep, value), shape, value)
    typed = [as_type(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    rows = marked.select(*keep, F.col(value).alias("value"), "malformed", *typed)
    bad = F.col("malformed")
    for name in required:
        bad = bad | F.col(name).isNull()
    return rows.withColumn("malformed", bad)


def encode(rows: DataFrame, *columns: str) -> Column:
    """JSON text of the named columns (all by default); NULL fields are left out."""
    return F.to_json(F.struct(*(columns or rows.columns)))
