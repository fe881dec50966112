"""Hash keys, difference hashes and bit distances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A difference hash compares neighbours in 8 rows of 9 pixels.
HASH_ROWS = 8
HASH_COLUMNS = 9


def order_key(*parts: Column | str | int) -> Column:
    """Hex digest of the parts joined by '|'; the seeded order of every shuffle here."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *columns))


def digest_fraction(key: Column, parts: int = 1000) -> Column:
    """Bucket 0..parts-1 from the first 24 bits of a hex digest."""
    return F.conv(F.substring(key, 1, 6), 16, 10).cast("bigint") % parts


def difference_hash(pixels: Column) -> Column:
    """64 tests "right neighbour is brighter", row by row, first test in the top bit; null gives 0."""
    bits = []
    for row in range(HASH_ROWS):
        for col in range(HASH_COLUMNS - 1):
            at = row * HASH_COLUMNS + col
            bit = (pixels[at + 1] > pixels[at]).cast("bigint")
            bits.append(F.shiftleft(bit, 63 - len(bits)))
    return F.coalesce(reduce(lambda a, b: a.bitwiseOR(b), bits), F.lit(0).cast("bigint"))


def hash_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
