"""Row keys for sorted key/value tables.

The salt is a function of the whole unsalted key, not of the user alone, so one
very active user still spreads over every salt and any key can be found again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALTS = 6
LONG_MAX = 9223372036854775807


def salt_number(key: Column, salts: int = SALTS) -> Column:
    """Salt of a text key (crc32) or of a whole-number key (the number itself)."""
    return F.pmod(key, F.lit(salts)).cast("int")


def text_salt(key: Column, salts: int = SALTS) -> Column:
    return salt_number(F.crc32(key.cast("binary")), salts)


def salt_letter(number: Column) -> Column:
    """0 -> A, 1 -> B, ..."""
    return F.char(number + F.lit(65))


def newest_first(ms: Column) -> Column:
    """Sorts later times first within a user."""
    return F.lit(LONG_MAX) - ms


def event_key(user: Column, ms: Column, salt: Column | None = None) -> Column:
    bare = F.concat_ws("|", user.cast("string"), newest_first(ms).cast("string"))
    number = salt if salt is not None else text_salt(bare)
    return F.concat_ws("|", salt_letter(number), bare)


def view_key(author: Column, ms: Column, salt: Column | None = None) -> Column:
    bare = F.concat_ws("-", author.cast("string"), ms.cast("string"))
    number = salt if salt is not None else text_salt(bare)
    return F.concat_ws("-", salt_letter(number), bare)


def reversed_key(user: Column) -> Column:
    return F.reverse(user.cast("string"))


def watch_key(user: Column, item: Column, env: Column, mode: Column, bucket: Column) -> Column:
    return F.concat_ws("|", reversed_key(user), item.cast("string"), env, mode, bucket.cast("string"))


def bare_key(row_key: Column, sep: str = "|") -> Column:
    """The key without its one-letter salt."""
    return row_key.substr(F.lit(2 + len(sep)), F.length(row_key))
