"""Sharding through a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size: an offset and a step, both taken
from a digest of its name. The shards take turns; each claims the first slot of its order that is still free. All
shards end with the same number of slots, give or take one, and if a shard leaves or joins, few other slots change
hands. A document goes to the shard that owns the slot of its key's digest: one lookup in a small broadcast table.

Defined cases: a missing key is placed like an empty text; equal keys share a shard; further columns are ignored by
``place`` and kept by ``write_shards``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The broadcast table has this many rows at most (about 16 MB).
LARGEST = 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def order_of(name: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's walk through the slots; any step from 1 to size - 1 visits all of them."""
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1


def claim_slots(shards: list[str], size: int) -> list[int]:
    """For each slot the number of the shard that owns it."""
    if not is_prime(size) or size > LARGEST:
        raise ValueError(f"the table size must be a prime of at most {LARGEST}: {size}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > size:
        raise ValueError("shard names must be given, distinct, and no more than slots")
    owner = [-1] * size
    walks = [list(order_of(name, size)) for name in shards]
    left = size
    while True:
        for number, walk in enumerate(walks):
            while owner[walk[0]] >= 0:
                walk[0] = (walk[0] + walk[1]) % size
            owner[walk[0]] = number
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, size: int) -> Column:
    """The key's slot: 60 bits of the md5 of its text, modulo the table size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: list[str], size: int = 65_537, key: str = "doc_id") -> DataFrame:
    """Per document its key, ``slot`` and ``shard`` name."""
    owner = claim_slots(shards, size)
    rows = pa.table({"slot": pa.array(range(size), pa.int32()), "shard": [shards[i] for i in owner]})
    lookup = docs.sparkSession.createDataFrame(rows)
    placed = docs.select(F.col(key), slot_of(F.col(key), size).alias("slot"))
    return placed.join(F.broadcast(lookup), "slot").select(key, "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: list[str], size: int = 65_537, key: str = "doc_id") -> None:
    """Write all columns of the documents below one folder ``shard=...`` per shard (a column of that name is replaced)."""
    owner = claim_slots(shards, size)
    rows = pa.table({"__slot": pa.array(range(size), pa.int32()), "__shard": [shards[i] for i in owner]})
    lookup = F.broadcast(docs.sparkSession.createDataFrame(rows))
    placed = docs.withColumn("__slot", slot_of(F.col(key), size)).join(lookup, "__slot").drop("__slot", "shard")
    placed = placed.withColumnRenamed("__shard", "shard").repartition("shard", F.pmod(F.xxhash64(key), F.lit(16)))
    placed.write.partitionBy("shard").parquet(path)
