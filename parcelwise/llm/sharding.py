"""Sharding by rendezvous hashing of stable record keys over weighted shards (operator 12).

Every shard draws a number for a key from a hash of both; the shard with the
highest draw, scaled by its weight, takes the record. A shard that is added or
made heavier only wins records for itself, and one that goes or gets lighter
only loses its own, so few records move when the shard count changes. The
shard depends on the key and the weights alone: not on the other rows, their
order or the files they lie in.

Slots number the rows of a shard from 0 without gaps. Rows are range-sorted by
(shard, hash of the key, key, ``by``) and every run of one shard inside one
range partition gets the count of the shard's rows before it, so no shard is
gathered in one task. A last sort column tells equal rows apart: a key that a
third of the rows share is cut over range partitions like any other.

Rules for odd rows: a null key is a key of its own; a null text has no bytes
(size 1, checksum 0); rows with one key share a shard, repeated rows get slots
of their own; an empty table gives an empty result. Columns of the input are
kept; the columns added here replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import let, stored

SHARDS = 8
#: Hexadecimal digits of a hash that make a draw: 52 bits, which a double holds exactly.
DIGITS = 13
ADDED = ("shard", "slot", "grown_shard")


def record_key(key: Column) -> Column:
    """The text that is hashed for a record; null is told apart from every value."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))


def _draw(key: Column, shard: int, weight: float) -> Column:
    """(scaled draw, shard): the highest wins, the lowest shard on a tie."""
    number = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, DIGITS), 16, 10).cast("double")
    score = F.ln((number + F.lit(0.5)) / F.lit(float(16 ** DIGITS))) / F.lit(float(weight))
    return F.struct(score.alias("score"), F.lit(-shard).alias("minus"))


def _winner(draws: Column) -> Column:
    return (-F.array_max(draws)["minus"]).cast("int")


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a record key; shard s has ``weights[s]``, a shard of weight 0 takes nothing."""
    alive = [(s, w) for s, w in enumerate(weights) if w > 0]
    if not alive or min(weights) < 0:
        raise ValueError("weights must be positive, or 0 for a shard that takes nothing")
    return let(record_key(key), lambda k: _winner(F.array(*[_draw(k, s, w) for s, w in alive])))


def shard_rows(rows: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None,
               key: str = "doc_id", by: Sequence[str] = ()) -> DataFrame:
    """Every row with its shard, its slot there, and the shard it would have under the weights ``grown``.

    ``grown`` defaults to one more shard of weight 1. Rows of a shard are in
    the order of (hash of the key, key, ``by``); rows equal in all of these may
    change places.
    """
    kept = [c for c in rows.columns if c not in ADDED]
    order = ["shard", "spread", "key", *[f"by{i}" for i in range(len(by))], "tie"]
    # the row travels in one field, as its columns may have the names used here
    drawn = stored(rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        shard_of(F.col(f"`{key}`"), weights).alias("shard"),
        shard_of(F.col(f"`{key}`"), grown or (*weights, 1.0)).alias("grown_shard"),
        F.conv(F.substring(F.md5(record_key(F.col(f"`{key}`"))), 1, DIGITS), 16, 10).cast("long").alias("spread"),
        F.col(f"`{key}`").alias("key"),
        *[F.col(f"`{c}`").alias(f"by{i}") for i, c in enumerate(by)],
        F.monotonically_increasing_id().alias("tie"),
    ), "sharding-drawn")
    dealt = stored(drawn.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "row", "shard", "grown_shard", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sharding-sorted")
    # one run per shard in each range partition: as many rows as there are partitions and shards
    runs = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = dealt.join(runs, ["shard", "part"])
    return placed.select(*[F.col(f"row.`{c}`") for c in kept], "shard", (F.col("at") + F.col("shift")).cast("long").alias("slot"), "grown_shard")


def write_shards(rows: DataFrame, path: str, **options) -> None:
    """The rows as one Parquet folder per shard (``shard=0``, ...), in the order of their slots within each file."""
    placed = shard_rows(rows, **options)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digests(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return shard_rows(narrow, weights, by=("size", "text_crc32"))


def _crc_entry(byte: int, zeros: int = 0) -> int:
    """A CRC-32 register that held ``byte`` after it has taken ``zeros`` + 1 zero bytes."""
    for _ in range(8 * (zeros + 1)):
        byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def _table(values) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]::bigint[]"


def _oracle_sql(shards: int = SHARDS, chunk: int = 64) -> str:
    """DuckDB SQL of ``shard_digests``. It has no CRC-32 of its own: chunks of a text are folded byte by
    byte, then the chunks' registers are moved on over each other by a table per register byte."""
    step = f"xor(c >> 8, ({_table(_crc_entry(b) for b in range(256))})[(xor(c, b) & 255) + 1])"
    moved = [f"({_table(_crc_entry(b << 8 * k, chunk - 1) for b in range(256))})[((c >> {8 * k}) & 255) + 1]" for k in range(4)]
    over = f"xor(xor({moved[0]}, {moved[1]}), xor({moved[2]}, {moved[3]}))"
    octets = "list_transform(range(0, (length({h}) // 2)::bigint), lambda i: ('0x' || {h}[2 * i + 1:2 * i + 2])::bigint)"
    draw = "ln((('0x' || substr(md5(k || '/' || s::varchar), 1, 13))::bigint::double + 0.5) / 4503599627370496.0)"
    return f"""
with raw as (
  select row_number() over () as rid, doc_id, coalesce('k' || doc_id::varchar, 'n') as k, hex(encode(coalesce(text, ''))) as h from documents),
cuts as (select rid, unnest(range(0, (length(h) // {2 * chunk})::bigint)) as part, h from raw),
parts as (select rid, part, h[part * {2 * chunk} + 1:(part + 1) * {2 * chunk}] as h from cuts),
folded as (select rid, list(list_reduce({octets.format(h='h')}, lambda c, b: {step}, 0::bigint) order by part) as registers from parts group by rid),
heads as (
  select rid, list_reduce(registers, lambda c, r: xor({over}, r), 4294967295::bigint) as register from folded),
tails as (select rid, doc_id, k, h, h[(length(h) // {2 * chunk}) * {2 * chunk} + 1:] as rest from raw),
summed as (
  select t.rid, doc_id, k, (length(h) // 2 + 1)::bigint as size,
    xor(4294967295, list_reduce({octets.format(h='t.rest')}, lambda c, b: {step}, coalesce(register, 4294967295::bigint))) as text_crc32
  from tails t left join heads using (rid)),
draws as (select rid, s, {draw} as score from summed, range({shards + 1}) r(s)),
best as (select rid, arg_max(-s, (score, -s)) filter (s < {shards}) * -1 as shard, arg_max(-s, (score, -s)) * -1 as grown from draws group by rid)
select doc_id, size, text_crc32, 'key' as law, shard::integer as shard,
  row_number() over (partition by shard order by ('0x' || substr(md5(k), 1, 13))::bigint, doc_id, size, text_crc32) - 1 as slot,
  grown::integer as grown_shard
from summed join best using (rid)
"""


ORACLE_SQL = _oracle_sql()
