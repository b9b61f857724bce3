"""Keyed tokens as native expressions: HMAC-SHA256 over namespace, 0x1F and value.

The prepared key is a one-row frame whose columns the expressions read, so that no plan, UI page
or event log shows it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INNER, OUTER = "_key_inner", "_key_outer"
SEPARATOR = "\x1f"
_KEYABLE = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.NullType)


def pads(key: str) -> tuple[bytes, bytes]:
    """The two padded keys of HMAC-SHA256."""
    if not key or len(key) < 32:
        raise ValueError("the key must have at least 32 characters")
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in raw), bytes(b ^ 0x5C for b in raw)


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Attach the prepared key's two columns (one broadcast row; no shuffle). A frame that has columns of these names is refused."""
    if taken := {INNER, OUTER} & {c.lower() for c in df.columns}:
        raise ValueError(f"column names {sorted(taken)} are kept for the key")
    inner, outer = pads(key)
    spark: SparkSession = df.sparkSession
    row = spark.createDataFrame([(bytearray(inner), bytearray(outer))], f"{INNER} binary, {OUTER} binary")
    return df.crossJoin(F.broadcast(row))


def require_keyable(kind: T.DataType, column: str) -> None:
    """Only types whose text form is beyond doubt can be keyed."""
    if not isinstance(kind, _KEYABLE):
        raise TypeError(f"column {column} of type {kind.simpleString()} cannot be keyed: cast it to string, an integer or a date")


def digest_hex(value: Column, namespace: str) -> Column:
    """The HMAC of a value in its namespace, as hexadecimal text."""
    message = F.encode(F.concat(F.lit(namespace + SEPARATOR), value.cast("string")), "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.col(INNER), message), 256))
    return F.sha2(F.concat(F.col(OUTER), inner), 256)


def unless_blank(value: Column, result: Column) -> Column:
    """Null and empty text pass as they are."""
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), text).otherwise(result)


def token(value: Column, namespace: str = "default", length: int = 16, prefix: str = "") -> Column:
    """Deterministic token: prefix and the first ``length`` hexadecimal characters."""
    return unless_blank(value, F.concat(F.lit(prefix), F.substring(digest_hex(value, namespace), 1, length)))


def token_numeric(value: Column, namespace: str = "default", digits: int = 10) -> Column:
    """Fixed-width number: the first 64 bits of the digest modulo 10^digits, filled with zeros."""
    number = F.conv(F.substring(digest_hex(value, namespace), 1, 16), 16, 10).cast("decimal(20,0)")
    return unless_blank(value, F.lpad((number % F.lit(10**digits).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), digits, "0"))


def token_shaped(value: Column, namespace: str = "default") -> Column:
    """Token of the same length whose characters keep their class: digit, upper, lower; others stay."""
    digest, text = digest_hex(value, namespace), value.cast("string")

    def change(ch: Column, i: Column) -> Column:
        byte = F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        letter = lambda first: F.char(byte % 26 + ord(first))
        return (
            F.when(ch.rlike(r"^\p{Nd}$"), (byte % 10).cast("string"))
            .when(ch.rlike(r"^\p{Lu}$"), letter("A"))
            .when(ch.rlike(r"^\p{Ll}$"), letter("a"))
            .otherwise(ch)
        )

    return unless_blank(value, F.array_join(F.transform(F.split(text, ""), change), ""))


def digest_number(value: Column, namespace: str) -> Column:
    """The first 32 bits of the digest as a number."""
    return F.conv(F.substring(digest_hex(value, namespace), 1, 8), 16, 10).cast("long")
