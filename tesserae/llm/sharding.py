"""Placing rows on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import table

#: Prime, and well over a hundred times the usual number of shards, so that shares are even.
SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot.

    Each shard has an order of preference, a permutation of the slots given by an offset and a skip. The
    shards take turns, and each claims its next slot that is still free, until none is.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and one at least")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the table's size must be a prime, and no smaller than the number of shards")
    # The order of turns follows the names, so the order of the list doesn't matter.
    turns = sorted(range(len(shards)), key=lambda k: shards[k])
    place = [_number(name, "offset") % slots for name in shards]
    skip = [_number(name, "skip") % (slots - 1) + 1 for name in shards]
    owner, left = [-1] * slots, slots
    while True:
        for k in turns:
            while owner[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            owner[place[k]] = k
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A slot from the key's text: the first 60 bits of its SHA-256; a null key counts as an empty text."""
    return F.pmod(F.conv(F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 15), 16, 10).cast("long"), F.lit(slots))


def shard(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with _slot and _shard (a name of ``shards``).

    The table has ``slots`` rows whatever the input, so it is broadcast, and every row finds its shard in
    constant time with no shuffle. All rows of a key go to one shard; rows with a null key go to the
    shard of the empty text. A column named _slot or _shard is replaced.
    """
    owner = fill(shards, slots)
    lookup = df.sparkSession.createDataFrame([(s, shards[k]) for s, k in enumerate(owner)], "_slot long, _shard string")
    kept = df.drop("_slot", "_shard")
    return kept.withColumn("_slot", slot_of(kept[key], slots)).join(F.broadcast(lookup), "_slot")


def shard_names(n: int) -> list[str]:
    return [f"shard-{k:04d}" for k in range(n)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), "doc_id", shard_names(64))
    return placed.select("doc_id", F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))
