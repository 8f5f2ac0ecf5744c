"""Sharding by a hierarchical weighted hash tree.

A topology names shards with their region, rack and weight.  A key descends from
the root: at each level every child draws a number from the key and its own
name, an exponential variate divided by the weight of the child's subtree, and
the smallest draw wins.  A child's draw depends on nothing but the key, its name
and its weight, so a changed weight moves rows only into or out of subtrees
whose weights change; a shard in a region of its own takes rows only into itself.

Everything is column expressions: no table is joined to find a shard.

Defined results: the key alone decides the shard, so equal keys meet in one
shard (law ``key``); a null key counts as the empty string.  A null text has
size 1 and CRC 0.  Slots follow a digest of key, size and CRC, so that numbering
a key with very many rows is spread as well; rows equal in all of these get
consecutive slots, and a row that stands many times is expanded in bounded pieces.
Very long texts only pass through their size and CRC.  An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradetide.llm.numbering import expanded, numbered

BUCKETS = 1024
DIGITS = 13  # of the digest: 52 bits, which a double holds exactly


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int = 8, regions: int = 2, racks: int = 2) -> list[Shard]:
    """Shards of equal weight, dealt evenly over regions and racks."""
    return [
        Shard(i, f"region{i * regions // shards}", f"rack{i * regions * racks // shards}")
        for i in range(shards)]


def grown(shards: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own."""
    number = max(s.number for s in shards) + 1
    return [*shards, Shard(number, f"region-of-{number}", f"rack-of-{number}", weight)]


def draw(key: Column, name: str, weight: float) -> Column:
    digest = F.substring(F.md5(F.concat(key, F.lit(f"|{name}"))), 1, DIGITS)
    unit = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    return -F.ln(unit) / weight


def winner(key: Column, children: dict[str, float], result: dict[str, Column]) -> Column:
    """The result of the child with the smallest draw; equal draws go by name."""
    if len(children) == 1:
        return result[next(iter(children))]
    best = F.array_min(F.array(*[
        F.struct(draw(key, name, weight).alias("draw"), F.lit(name).alias("name"))
        for name, weight in children.items()]))["name"]
    chosen = F.lit(None)
    for name in children:
        chosen = F.when(best == name, result[name]).otherwise(chosen)
    return chosen


def shard_of(key: Column, shards: list[Shard]) -> Column:
    """The shard a key descends to."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    tree: dict[str, dict[str, list[Shard]]] = {}
    for s in shards:
        if s.weight <= 0:
            raise ValueError("weights must be positive")
        tree.setdefault(s.region, {}).setdefault(s.rack, []).append(s)

    def weight(below: list[Shard]) -> float:
        return float(sum(s.weight for s in below))

    regions = {}
    for region, racks in tree.items():
        inside = {}
        for rack, below in racks.items():
            inside[f"{region}/{rack}"] = winner(
                key, {f"{region}/{rack}/{s.number}": s.weight for s in below},
                {f"{region}/{rack}/{s.number}": F.lit(s.number) for s in below})
        regions[region] = winner(
            key, {f"{region}/{rack}": weight(below) for rack, below in racks.items()}, inside)
    return winner(
        key, {r: weight([s for below in racks.values() for s in below]) for r, racks in tree.items()}, regions)


def assign(rows: DataFrame, key: str, shards: list[Shard], column: str = "shard") -> DataFrame:
    """``rows`` with the number of their shard; a column of that name is replaced."""
    return rows.withColumn(column, shard_of(F.col(key), shards).cast("int"))


def placed(docs: DataFrame, shards: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    shards = shards or topology()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    alike = assign(assign(alike, "doc_id", shards), "doc_id", grown(shards), "grown_shard")
    # Of the whole row: a key with very many rows is then spread over the buckets.
    alike = alike.withColumn("digest", F.md5(F.concat_ws(
        "|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32")))
    bucket = F.conv(F.substring("digest", 1, 4), 16, 10).cast("int") % 65536 * BUCKETS / 65536
    started = numbered(
        alike, ["shard"], F.floor(bucket).cast("int"),
        ["digest", F.col("doc_id").asc_nulls_first(), "size", "text_crc32"], "copies", "first_slot", "shards")
    return expanded(started, "copies", "first_slot", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard")


def crc32_table() -> str:
    """DuckDB has no CRC-32: the usual table, as the one row of ``crc``."""
    steps = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return f"crc as (select {steps}::bigint[] as steps)"


def crc32_sql(text: str) -> str:
    """The CRC-32 of a text as a fold over its bytes; ``steps`` is the table's column."""
    byte_list = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    return (f"xor(list_reduce([4294967295::bigint] || {byte_list}, "
            f"lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295)")


def placed_sql() -> str:
    """The same for eight shards in DuckDB's SQL, written from the topology."""
    def descent(shards: list[Shard]) -> str:
        tree: dict[str, dict[str, list[Shard]]] = {}
        for s in shards:
            tree.setdefault(s.region, {}).setdefault(s.rack, []).append(s)

        def pick(options: dict[str, tuple[float, str]]) -> str:
            if len(options) == 1:
                return next(iter(options.values()))[1]
            best = "list_min([" + ", ".join(
                f"{{'draw': -ln((('0x' || substr(md5(k || '|{n}'), 1, {DIGITS}))::bigint::double + 0.5)"
                f" / {16**DIGITS}.0) / {w}, 'name': '{n}'}}" for n, (w, _) in options.items()) + "]).name"
            return f"case {best} " + " ".join(f"when '{n}' then {r}" for n, (_, r) in options.items()) + " end"

        regions = {}
        for region, racks in tree.items():
            inside = {
                f"{region}/{rack}": (float(sum(s.weight for s in below)), pick({
                    f"{region}/{rack}/{s.number}": (s.weight, str(s.number)) for s in below}))
                for rack, below in racks.items()}
            regions[region] = (sum(w for w, _ in inside.values()), pick(inside))
        return pick(regions)

    shards = topology()
    return f"""
    with {crc32_table()},
    rows as (
        select doc_id, strlen(coalesce(text, ''))::bigint + 1 as size, coalesce(text, '') as t,
               coalesce(doc_id::varchar, '') as k, steps
        from documents, crc),
    placed as (
        select doc_id, size, {crc32_sql("t")} as text_crc32, 'key' as law,
               ({descent(shards)})::integer as shard, ({descent(grown(shards))})::integer as grown_shard,
               k
        from rows)
    select doc_id, size, text_crc32, law, shard,
           row_number() over (partition by shard order by md5(concat_ws('|', k, size, text_crc32)), doc_id nulls first, size, text_crc32) - 1 as slot,
           grown_shard
    from placed"""
