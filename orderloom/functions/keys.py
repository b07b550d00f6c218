"""Key columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key namespaces. Stored keys depend on them.
CUSTOMER_NAMESPACE = "dummyjson_customer"
PRODUCT_NAMESPACE = "dummyjson_product"

# First byte of a packed key: whether the bytes after it stand for hex digits or are the text.
_HEX, _TEXT = b"\x01", b"\x00"


def surrogate_key(namespace: str, source_id: Column) -> Column:
    """Hex md5 of `<namespace>_<id>`; NULL ids stay NULL."""
    return F.md5(F.concat(F.lit(f"{namespace}_"), source_id.cast("string")))


def text_key(value: Column) -> Column:
    return F.md5(value)


def packed(df: DataFrame, *names: str) -> DataFrame:
    """Text keys as bytes, those in hex at half their length, for the way through an exchange.

    Equal texts have equal bytes and other texts others; `unpacked` gives any text back.
    """
    kinds = dict(df.dtypes)
    return df.withColumns({n: _packed(F.col(n)) for n in names if kinds.get(n) == "string"})


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({n: _unpacked(F.col(n)) for n in names if kinds.get(n) == "binary"})


def _packed(text: Column) -> Column:
    is_hex = text.rlike("^([0-9a-f]{2})+\\z")
    return F.when(is_hex, F.concat(F.lit(_HEX), F.unhex(text))).otherwise(F.concat(F.lit(_TEXT), text.cast("binary")))


def _unpacked(value: Column) -> Column:
    rest = F.substring(value, 2, 2**31 - 1)
    return F.when(F.substring(value, 1, 1) == F.lit(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
