"""Column expressions shared by the operators. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots and back-quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(frame: DataFrame, name: str) -> str:
    """``name``, or ``name`` and as many underscores as make it unlike every column of ``frame``, whatever their case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def source_path() -> Column:
    """Path of the file a row was read from, as it is listed; Spark hands it out with some characters escaped."""
    path = F.col("_metadata.file_path")
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def is_plain_scan(frame: DataFrame, field: str = "file_path") -> bool:
    """Whether the rows come straight from files, so that they still know which (or that ``field`` of their origin)."""
    try:
        frame.select(f"_metadata.{field}")
    except AnalysisException:
        return False
    return True


def typed_null(data_type: T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def offset_key(key: Column, offset: int = 10**14) -> Column:
    """A numeric surrogate of a key, moved out of the range of other key spaces. Bad keys become null."""
    return key.try_cast("bigint") + F.lit(offset).cast("bigint")


def round_money(amount: Column, money_type: T.DataType | None = None) -> Column:
    """Two digits right of the decimal point, half up; exact decimals when ``money_type`` is given."""
    return F.round(amount, 2) if money_type is None else amount.try_cast(money_type)


def null_to_code(code: Column, value: str = "9") -> Column:
    return F.coalesce(code.cast("string"), F.lit(value))


def not_blank(key: Column, data_type: T.DataType) -> Column:
    """Neither null nor empty. Written as two plain comparisons so that both reach the file scan."""
    if isinstance(data_type, T.StringType):
        return key.isNotNull() & (key != F.lit(""))
    return key.isNotNull()


def cell_text(value: Column, data_type: T.DataType) -> Column:
    """Text of one preview cell before it is cut."""
    if isinstance(data_type, T.BinaryType):
        body = F.trim(F.regexp_replace(F.hex(value), "(..)", "$1 "))
        text = F.concat(F.lit("["), body, F.lit("]"))
    elif isinstance(data_type, T.ArrayType):
        items = F.transform(value, lambda item: cell_text(item, data_type.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def cut_text(text: Column, width: int) -> Column:
    """``text`` cut to ``width`` characters, ending in ``...`` when there is room for it; 0 means never cut."""
    if width <= 0:
        return text
    kept = F.substring(text, 1, width) if width < 4 else F.concat(F.substring(text, 1, width - 3), F.lit("..."))
    return F.when(F.length(text) > width, kept).otherwise(text)
