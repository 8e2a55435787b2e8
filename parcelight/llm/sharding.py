"""Shards that each hold the mixture of the whole, by proportional stratified interleaving.

Within a source the rows are put in a seeded order; a row's rank divided by the
number of rows of its source is its fractional rank, between 0 and 1.  In the
order of fractional ranks every source is spread evenly, so cutting that order
into equal runs gives shards that repeat the mixture.  A seeded phase moves each
source by less than one of its steps; without it all sources of one row would
meet in the middle shard.

Both orders are running totals over range-partitioned blocks, so neither a hot
source nor the order of all rows is ever in one task.  Only ids, sizes and
checksums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import set_apart, text_of
from parcelight.operators.prefix import prior_totals, with_position
from parcelight.session import cut_lineage

SHARDS = 40
ROW_BYTES = 16
LAW = "rows"


def _drawn(value: Column, digits: int) -> Column:
    """The first hexadecimal digits of a value's md5 as a whole number."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("bigint")


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: str = "shard",
    keep: tuple[str, ...] = (),
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, ``keep``, size, text_crc32, shard and slot, a row for each input row.

    Row counts of shards differ by one at most; slots of a shard run from 0
    without gaps.  A null source is a source of its own, a null text is empty, a
    null id is drawn as an empty one.  Rows with the same id are placed apart, in
    the order of checksum and size; which of two wholly equal rows comes first
    changes nothing in the result.  Fewer rows than shards leave shards empty, an
    empty table gives an empty table.  Other columns are not read.
    """
    names = [f"__k{i}" for i in range(len(keep))]
    text = text_of(f"`{text_col}`")
    slim = cut_lineage(
        docs.select(
            F.col(f"`{id_col}`").alias("__id"),
            *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)],
            F.col(f"`{source_col}`").cast("string").alias("__source"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("__size"),
            F.crc32(text.cast("binary")).alias("__crc"),
            _drawn(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 15).alias("__draw"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    ranked = prior_totals(
        slim, ["__draw", "__crc", "__size", "__row"], {"__rank": F.lit(1).cast("bigint")}, partition_by=["__source"]
    )
    totals = slim.groupBy("__source").agg(F.count(F.lit(1)).alias("__rows"))
    phase = (_drawn(F.concat(F.lit(f"{seed}/"), F.coalesce("__source", F.lit(""))), 8) + 0.5) / 4294967296.0
    sources = totals.select(F.col("__source").alias("__name"), "__rows", phase.alias("__phase"))
    spread = ranked.join(sources, F.col("__source").eqNullSafe(F.col("__name"))).withColumn(
        "__part", (F.col("__rank") + F.col("__phase")) / F.col("__rows")
    )
    slim_again = spread.select("__id", *names, "__size", "__crc", "__part", "__draw", "__row")
    placed = with_position(slim_again, ["__part", "__draw", "__crc", "__size", "__row"], "__at")
    everything = F.lit(slim.count()).cast("bigint")
    shard = F.expr(f"__at * {int(shards)} div __n")
    first = F.expr(f"(__shard * __n + {int(shards) - 1}) div {int(shards)}")
    return (
        placed.withColumn("__n", everything)
        .withColumn("__shard", shard)
        .select(
            F.col("__id").alias("doc_id"),
            *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
            F.col("__size").alias("size"),
            F.col("__crc").alias("text_crc32"),
            F.col("__shard").cast("int").alias("shard"),
            (F.col("__at") - first).alias("slot"),
        )
    )


def shard_digest(docs: DataFrame) -> DataFrame:
    """The place of every document, with the law that the shards keep.

    Nulls, repeated rows and empty tables as in ``interleave``.
    """
    return interleave(docs).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: str = "shard", file_rows: int = 500_000) -> None:
    """All columns of the documents as Parquet below ``path``, one folder ``shard=k`` a shard, rows in the order of slots.

    A shard is written as files of about ``file_rows`` rows, each by a task of its
    own, so a large shard is not one task.  ``docs`` must be a stored table: it is
    read twice, and the checksum carried from the first read is compared in the
    second.  A column named ``shard`` in the documents is written as ``shard_``.
    """
    inner, named = set_apart(docs)
    given = inner.select(
        named["doc_id"], named["source"], named["text"], F.col("__at").alias("__of")
    )
    places = interleave(given, shards, seed, keep=("__of",)).select(
        "__of", F.col("text_crc32").alias("__told"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot")
    )
    told = F.crc32(F.coalesce(named["text"].cast("string"), F.lit("")).cast("binary"))
    same = F.assert_true(F.col("__told") == told, F.lit("the documents changed between two reads"))
    columns = [c.alias("shard_") if name == "shard" else c for name, c in named.items()]
    rows = inner.join(places, F.col("__at") == F.col("__of")).select(
        *columns, F.col("__shard").alias("shard"), "__slot", F.coalesce(same.cast("boolean"), F.lit(True)).alias("__same")
    )
    runs = max(1, -(-docs.count() // file_rows))
    (
        rows.where("__same")
        .repartitionByRange(runs + shards, "shard", "__slot")
        .sortWithinPartitions("shard", "__slot")
        .drop("__slot", "__same")
        .write.partitionBy("shard")
        .parquet(path)
    )


SHARDING_SQL = r"""
with recursive table_of(i, crc, turn) as (
    select i, i, 0 from range(16) r(i)
    union all
    select i, case when crc & 1 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end, turn + 1 from table_of where turn < 4),
nibbles as (select list(crc order by i) as t from table_of where turn = 4),
sized as (
    select doc_id, source, strlen(coalesce(text, '')) + 16 as size,
        (select xor(list_reduce(
            list_prepend(4294967295, flatten(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                lambda h: [cast('0x' || h[2] as bigint), cast('0x' || h[1] as bigint)]))),
            lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) from nibbles) as text_crc32,
        cast('0x' || substr(md5('shard:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as draw
    from documents),
ranked as (
    select *, row_number() over (partition by source order by draw, text_crc32, size) - 1 as place,
        count(*) over (partition by source) as n,
        (cast('0x' || substr(md5('shard/' || coalesce(source, '')), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double as phase
    from sized),
placed as (
    select *, row_number() over (order by (place + phase) / n, draw, text_crc32, size) - 1 as spot, count(*) over () as total
    from ranked)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law,
    cast(spot * 40 // total as integer) as shard,
    cast(spot - (spot * 40 // total * total + 39) // 40 as bigint) as slot,
    cast(null as integer) as grown_shard
from placed
"""
