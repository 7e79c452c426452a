"""Shard placement by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.llm.frames import NULL_ID, keyed, real_id

# Slots of the table: a prime over a hundred times the number of shards keeps shares even.
SLOTS = 65_537
# The table is broadcast; it never grows with the data, and not beyond this many slots.
MOST_SLOTS = 1_000_003
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """Shard number of each slot.

    Every shard prefers the slots in an order of its own, offset + j * skip modulo the prime
    number of slots.  The shards take turns; at its turn a shard claims the first slot of its
    order that is still free.  Shares differ by at most one slot, and when a shard leaves, few
    slots of the others change.  Shards are named; a repeated name, no shard, more shards than
    slots, or a number of slots that isn't a prime within MOST_SLOTS is an error.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one and at most one per slot")
    if not _is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"slots must be a prime up to {MOST_SLOTS}")
    order = [(_number(f"offset:{s}") % slots, _number(f"skip:{s}") % (slots - 1) + 1)
             for s in shards]
    table, at, claimed = [-1] * slots, [offset for offset, _ in order], 0
    for turn in count():
        who = turn % len(shards)
        slot, skip = at[who], order[who][1]
        while table[slot] >= 0:
            slot = (slot + skip) % slots
        table[slot] = who
        at[who] = (slot + skip) % slots
        claimed += 1
        if claimed == slots:
            return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key's text: 60 bits of its MD5 modulo the number of slots; null counts as ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def _table_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    text = ",".join(map(str, table))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "number")
                                 ).select(F.col("slot").cast("long").alias("slot"),
                                          F.col("number").cast("int").alias("number"))


def placed(docs: DataFrame, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per document: doc_id, slot, shard.

    A document's key is its doc_id, so placement needs no shuffle, does not depend on the other
    rows, and copies of a text spread evenly.  The table has ``slots`` rows of two numbers, a
    bound set by a parameter, and is broadcast.  A null doc_id has the key ''; repeated ids share
    a shard.
    """
    table = _table_frame(docs.sparkSession, lookup_table(shards, slots))
    key = F.when(F.col("id") != F.lit(NULL_ID), F.col("id"))
    rows = keyed(docs).withColumn("slot", slot_of(key, slots))
    names = F.array(*[F.lit(s) for s in shards])
    return rows.join(F.broadcast(table), "slot").select(
        real_id().alias("doc_id"), "slot", names[F.col("number")].alias("shard"))


def oracle(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    """The placement of ``documents`` as SQL, over the same lookup table."""
    text = ",".join(map(str, lookup_table(shards, slots)))
    names = ", ".join(f"'{s}'" for s in shards)
    return (f"WITH t AS (SELECT string_split('{text}', ',') AS numbers, [{names}] AS names), "
            "d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), "
            f"1, 15))::BIGINT % {slots} AS slot FROM documents) "
            "SELECT doc_id, slot, names[CAST(numbers[slot + 1] AS INT) + 1] AS shard FROM d, t")
