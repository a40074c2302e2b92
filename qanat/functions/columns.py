"""Column builders that several operators share. All stay in the JVM but visual_digest."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from qanat.functions.visual import BLANKS, visual_key

_BLANK_CLASS = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in BLANKS) + "]"
_DIGITS = [chr(c) for c in range(0x80, 0xFFFF) if unicodedata.category(chr(c)) == "Nd"]
_ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def strip_blanks(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, f"^{_BLANK_CLASS}+|{_BLANK_CLASS}+$", "")


def ascii_digits(c: Column) -> Column:
    """Decimal digits of any script as 0-9; strings without such digits are not touched."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, "".join(_DIGITS), _ASCII_DIGITS)).otherwise(c)


def number_key(c: Column) -> Column:
    """An article number without letter case, outer blanks, digit script and leading zeros; null stays null, a blank one becomes ''."""
    return F.regexp_replace(ascii_digits(F.lower(strip_blanks(c))), "(^|[^0-9])0+(?=[0-9])", "$1")


def version_number(c: Column) -> Column:
    """The first number in a version label; null where there is none or it has over 38 digits."""
    return F.regexp_extract(ascii_digits(c), "([0-9]+)", 1).try_cast("decimal(38,0)")


def key_form(c: Column) -> Column:
    """A reference key without outer blanks and letter case; null where nothing is left."""
    bare = F.lower(strip_blanks(c))
    return F.when(bare != "", bare)


@F.pandas_udf(StringType())
def visual_digest(texts: pd.Series) -> pd.Series:
    """A 128-bit digest of what each text looks like; null for null."""
    return texts.map(lambda t: None if t is None else hashlib.md5(visual_key(t).encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest())
