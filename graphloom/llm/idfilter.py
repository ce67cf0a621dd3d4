"""A filter of bounded size that keeps rows which can't join away from a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.storage import materialize


def may_hold(ids: DataFrame, column: str, about: int, most_bits: int = 1 << 28) -> Callable[[DataFrame, str], DataFrame]:
    """Marks rows by a column of ids: ``asked`` is true for every id of the table, and for few others.

    ``about``: how many ids there are. The bitmap has some 16 bits for each and ``most_bits`` at
    most (32 MB), so it may be broadcast; beyond that it lets more through, and the join that follows
    decides. A null id is not held. It is a table of stretches of 64 words, looked up by a join.
    """
    bits = min(most_bits, 1 << max(16, (16 * about).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits))
    cells = ids.where(F.col(column).isNotNull()).select(place(column).alias("place"))
    words = cells.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
    stretches = words.groupBy(F.expr("word div 64").alias("held_stretch")).agg(F.map_from_entries(F.collect_list(F.struct(F.expr("word % 64").alias("k"), "bits"))).alias("own"))
    whole = stretches.select("held_stretch", F.expr("transform(sequence(0L, 63L), k -> coalesce(own[k], 0L))").alias("held_words"))
    whole = materialize(whole, "bitmap")  # bits / 4096 rows

    def asked(rows: DataFrame, of: str) -> DataFrame:
        at = rows.withColumn("held_at", place(of))
        found = at.join(F.broadcast(whole), F.expr("held_at div 4096") == F.col("held_stretch"), "left")
        held = F.expr("shiftrightunsigned(get(held_words, cast(held_at div 64 % 64 as int)), cast(held_at % 64 as int)) & 1 = 1")
        return found.select(*rows.columns, (F.coalesce(held, F.lit(False)) & F.col(of).isNotNull()).alias("asked"))

    return asked
