"""Business keys, stable GUIDs, key assignment and hash sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the business keys.
STORE_NUMBER = "SF-%05d"
EMPLOYEE_NUMBER = "EMP-%06d"
ITEM_CODE = "ITM-%04d"
ITEM_NAME = "Menu Item %04d"
PURCHASE_ORDER_NUMBER = "PO-%06d"
MEMBER_NUMBER = "MBR-%07d"
PHONE_NUMBER = "(555)%03d-%04d"


def business_key(pattern: str, number: Column) -> Column:
    """The formatted key. Numbers wider than the pattern keep all their digits."""
    return F.format_string(pattern, number)


def phone_number(number: Column) -> Column:
    return F.format_string(PHONE_NUMBER, number % 1000, number % 10000)


def stable_guid(namespace: str, key: Column) -> Column:
    """A GUID that depends on the key only, so a rerun gives the same one."""
    digest = F.md5(F.concat(F.lit(f"{namespace}:"), key.cast("string")))
    bounds = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in bounds])


def round_robin(sequence: Column, count: int | Column) -> Column:
    """A key in 1..count from a running number; parents must be numbered densely."""
    return (sequence % count) + 1


def hash_number(*parts: Column) -> Column:
    """A non-negative number below 2**32, equal wherever md5 is."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def sampled(key: Column, per_thousand: int, salt: str) -> Column:
    """Whether a key is in the sample; the same keys on every run."""
    return hash_number(F.lit(salt), key) % 1000 < per_thousand
