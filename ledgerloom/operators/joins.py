"""Joins whose strategy depends on a measured size, and survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a lookup may have to be sent to every executor; a documented bound, checked by counting.
BROADCAST_ROWS = 20_000
#: Copies made of each lookup row where the lookup is too large to broadcast.
SALTS = 16


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` with a lookup that has one row per key, whatever the keys' frequencies in ``facts``.

    The lookup is counted (it should be staged or cheap). Up to ``broadcast_rows`` rows it is broadcast; beyond that
    both sides are salted, so that a key holding a third of all facts is spread over ``salts`` tasks. Null keys match
    nothing. ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Every fact row is kept as the join type says;
    none is sampled or dropped.
    """
    if lookup.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return facts.join(F.broadcast(lookup), on, how)
    salted = facts.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")
