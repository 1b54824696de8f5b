"""Scalar rules of the chain schema as Catalyst expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

ZERO_ADDRESS = "0x" + "0" * 40
UUID_TEXT = "^bae-[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def to_int(c: Column) -> Column:
    """BIGINT from 0x-hex or plain decimal text; NULL for anything else or beyond 64 bits.

    Octal, binary, signed hex and digit separators count as malformed. conv() only ever sees 63-bit input, as it raises
    on more under ANSI rules.
    """
    digits = F.regexp_extract(c, "^0[xX]0*([0-9a-fA-F]*)$", 1)
    fits = (F.length(digits) < 16) | ((F.length(digits) == 16) & (F.substring(digits, 1, 1) < "8"))
    safe = F.when(fits, F.when(digits == "", "0").otherwise(digits))
    hexed = F.when(c.rlike("^0[xX][0-9a-fA-F]+$"), F.conv(safe, 16, 10).cast("long"))
    return F.coalesce(hexed, F.when(c.rlike("^[+-]?(0|[1-9][0-9]*)$"), c.try_cast("long")))


def to_hex(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(c.cast("long"))))


def normalize_hex(c: Column) -> Column:
    """'' stays; 0X becomes 0x; a missing prefix is added."""
    return F.when(c == "", "").when(c.rlike("^0[xX]"), F.concat(F.lit("0x"), F.substring(c, 3, 1 << 30))).otherwise(F.concat(F.lit("0x"), c))


def strip_hex(c: Column) -> Column:
    return F.regexp_replace(c, "^0[xX]", "")


def block_number(c: Column, kind: str) -> Column:
    """Height from a numeric column; a column of text is malformed, whatever its digits say."""
    return c.try_cast("long") if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal") else F.lit(None).cast("long")


def gas_price(kind: Column, price: Column, fee_cap: Column) -> Column:
    return F.when(kind == "2", fee_cap).otherwise(price)


def fee_field(kind: Column, value: Column) -> Column:
    """Fee fields exist for type 2 only."""
    return F.when(kind == "2", F.coalesce(value, F.lit(""))).otherwise("")


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def sender(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", ZERO_ADDRESS).otherwise(c)


def contract_address(c: Column) -> Column:
    return F.when(F.lower(c) == ZERO_ADDRESS, "").otherwise(blank(c))


def decimal_view(c: Column) -> Column:
    """DECIMAL(38,0) for analytics; NULL beyond 38 digits, where the text column stays exact."""
    return c.try_cast("decimal(38,0)")


def doc_id_pack(c: Column) -> Column:
    """16 bytes of a bae-<uuid> id, NULL where it is malformed."""
    return F.when(c.rlike(UUID_TEXT), F.unhex(F.replace(F.substring(c, 5, 36), F.lit("-"), F.lit(""))))


def doc_id_unpack(c: Column) -> Column:
    h = F.lower(F.hex(c))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.octet_length(c) == 16, F.concat(F.lit("bae-"), F.concat_ws("-", *parts)))


def doc_ids_pack(ids: Column) -> Column:
    """All ids of an array as one binary value, NULL if any is malformed."""
    packed = F.transform(ids, doc_id_pack)
    return F.when(~F.exists(packed, lambda x: x.isNull()), F.aggregate(packed, F.lit("").cast("binary"), lambda a, x: F.concat(a, x)))


def doc_ids_unpack(packed: Column) -> Column:
    n = F.octet_length(packed).cast("int")
    at = F.sequence(F.lit(0), F.floor(n / 16).cast("int") - 1)
    return F.when(n == 0, F.array().cast("array<string>")).when(n % 16 == 0, F.transform(at, lambda i: doc_id_unpack(F.substr(packed, i * 16 + 1, F.lit(16)))))


def content_id(*columns: str) -> Column:
    """SHA-256 of the row as JSON with columns in name order: the same content has the same id on every run."""
    return F.unhex(F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def content_doc_id(cid: Column) -> Column:
    return doc_id_unpack(F.substring(cid, 1, 16))


def key_type(c: Column) -> Column:
    return F.when(c.isin("ES256K", "ecdsa-256k"), "secp256k1").when(c.isin("Ed25519", "ed25519"), "ed25519").otherwise("unsupported")


# --- texts on their way ---


def pack(c: Column, kind: DataType) -> Column:
    """A column whose texts, at any depth, are bytes for a shuffle: lower-case hex of whole bytes, after 0x or not, takes half as many.

    Equal texts have equal bytes and others have others; unpack() gives back any text.
    """
    if isinstance(kind, StringType):
        hexed = lambda mark: c.rlike(rf"\A{mark}[0-9a-f]+\z") & (F.length(c) % 2 == 0)
        bare = F.when(hexed(""), F.concat(F.lit(bytearray(b"\2")), F.unhex(c)))
        return F.when(hexed("0x"), F.concat(F.lit(bytearray(b"\1")), F.unhex(F.substr(c, F.lit(3))))).otherwise(F.coalesce(bare, F.concat(F.lit(bytearray(b"\0")), c.cast("binary"))))
    return _within(c, kind, pack)


def unpack(c: Column, kind: DataType) -> Column:
    """What pack() was given; kind is the type before."""
    if isinstance(kind, StringType):
        mark, rest = F.substr(c, F.lit(1), F.lit(1)), F.substr(c, F.lit(2))
        hexed = F.when(mark == F.lit(bytearray(b"\1")), F.concat(F.lit("0x"), F.lower(F.hex(rest)))).when(mark == F.lit(bytearray(b"\2")), F.lower(F.hex(rest)))
        return hexed.otherwise(rest.cast("string"))
    return _within(c, kind, unpack)


def _within(c: Column, kind: DataType, f: Callable[[Column, DataType], Column]) -> Column:
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: f(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*(f(c[x.name], x.dataType).alias(x.name) for x in kind.fields)))
    return c
