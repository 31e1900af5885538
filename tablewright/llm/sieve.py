"""A filter of bounded size in front of a join: which wide rows may meet a narrow table of keys.

A join on a key sends whole rows to the key's partition, texts included, even if few rows find a
partner. The keys' hashes set bits in pages of 4 KB, ``BITS`` bits a key and ``PAGES`` pages at
most; the pages are broadcast, and rows whose bit is not set need not be sent. A set bit promises
nothing: the join still decides. With more keys than the pages have room for, more rows pass, and
at last all do; results are the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import pin

BITS = 16  # bits a key: one row in 17 passes without need
PAGE = 1 << 15  # bits in a page
PAGES = 1 << 14  # 64 MB


class Sieve:
    """The values of column ``key`` of ``keys``, which must give the same rows whenever it is read.

    No keys: no row passes. A null key is a value like others here; a join would not match it.
    """

    def __init__(self, keys: DataFrame, key: str):
        self.pages = max(1, min(PAGES, math.ceil(keys.count() * BITS / PAGE)))
        page, bit = self._place(F.col(key))
        places = keys.select(page.alias("page"), bit.alias("bit")).repartition("page")
        self.table = pin(places.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")))

    def _place(self, key: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(key), F.lit(self.pages * PAGE).cast("long"))
        return F.shiftright(at, 15), at.bitwiseAND(F.lit(PAGE - 1).cast("long"))

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """``rows`` that may have one of the keys, and those that have none."""
        page, bit = self._place(F.col(key))
        asked = rows.select(F.struct(*rows.columns).alias("row"), page.alias("page"), bit.alias("bit"))
        met = asked.join(F.broadcast(self.table), "page", "left")
        byte = F.conv(F.hex(F.substring("bits", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, F.col("bit").bitwiseAND(F.lit(7).cast("long")).cast("int")) == 1, F.lit(False))
        return met.filter(hit).select("row.*"), met.filter(~hit).select("row.*")
