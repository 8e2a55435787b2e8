"""Mixing sources to target weights by capped water-filling, in column expressions only.

Every source has a weight and a ceiling (so many epochs of its own size).  The
water level is the words a unit of weight gets; a source whose ceiling is below
its share stands at the ceiling, and what it cannot take raises the level of the
others.  In the order of ceiling per weight the sources at their ceiling come
first, so running totals give the level at once.

A source's words are then taken as whole repetitions of all its documents and,
in a seeded order, a fraction: the documents before the running total reaches
the rest of the target, the last of them in part.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import WORD, text_of
from parcelight.operators.prefix import prior_totals, with_position
from parcelight.session import cut_lineage

# Weights in the order of the sources, again and again.
WEIGHTS = (5, 2, 1)


def water_fill(sources: DataFrame, total: float, epochs: int) -> DataFrame:
    """``sources`` (name columns, size, weight) with ``target``.

    Sizes and weights are whole numbers, so the comparison that finds the
    sources at their ceiling is exact.  Sources of size zero have target zero;
    if all ceilings together are below ``total``, all stand at their ceiling.
    """
    names = sources.columns
    ready = sources.withColumn("__cap", F.lit(epochs) * F.col("size")).withColumn("__order", F.col("__cap") / F.col("weight"))
    with_sums = prior_totals(ready, ["__order", "place"], {"__caps": F.col("__cap"), "__weights": F.col("weight")})
    sums = ready.agg(F.sum("weight").alias("__w"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    rest = (wide("__w") - wide("__weights") - wide("weight")).cast("decimal(18,0)")
    exact = F.lit(Decimal(total).quantize(Decimal("0.01"))).cast("decimal(18,2)")
    # words that all sources would take at the level where this one is full
    needed = (wide("__caps") + wide("__cap")) * wide("weight") + wide("__cap") * rest
    marked = with_sums.crossJoin(F.broadcast(sums)).withColumn(  # one row of sums
        "__full", needed <= exact * F.col("weight").cast("decimal(9,0)")
    )
    marked = cut_lineage(marked)
    level = marked.agg(
        (
            (F.lit(float(total)) - F.coalesce(F.sum(F.when(F.col("__full"), F.col("__cap"))), F.lit(0)).cast("double"))
            / F.nullif(F.max("__w") - F.coalesce(F.sum(F.when(F.col("__full"), F.col("weight"))), F.lit(0)), F.lit(0)).cast("double")
        ).alias("__level")
    )
    target = F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(F.col("weight") * F.col("__level"))
    return marked.crossJoin(F.broadcast(level)).select(*names, target.alias("target"))  # one row


def mix_sources(
    docs: DataFrame,
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
    keep: tuple[str, ...] = (),
    source_col: str = "source",
) -> DataFrame:
    """doc_id, ``keep``, size, source_size, target and taken, a row for each input row.

    Sizes are counts of words.  A null source is one of its own and comes last; a
    null or empty text has size zero and nothing is taken of it.  The order of
    the fraction is the digest of seed and id, then the text's, so reruns agree;
    rows that repeat an id are documents of their own.
    """
    names = [f"__k{i}" for i in range(len(keep))]
    sized = cut_lineage(
        docs.select(
            "doc_id",
            *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)],
            F.col(source_col).cast("string").alias("__source"),
            F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("__draw"),
            F.xxhash64("text").alias("__tie"),
        )
    )
    totals = sized.groupBy("__source").agg(F.sum("size").alias("size")).withColumn("__absent", F.col("__source").isNull())
    placed = with_position(totals, ["__absent", "__source"], "place").drop("__absent")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    everything = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    targets = water_fill(placed.withColumn("weight", weight), share * everything, epochs).select(
        F.col("__source").alias("__name"), F.col("size").alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target")
    )
    running = prior_totals(sized, ["__draw", "__tie"], {"__before": F.col("size")}, partition_by=["__source"])
    mixed = running.join(targets, F.col("__source").eqNullSafe(F.col("__name")))
    words = F.round("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__before")))
    return mixed.select(
        "doc_id",
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + part).cast("bigint").alias("taken"),
    )


MIXING_SQL = r"""
with sized as (
    select doc_id, source, text,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
        md5('mix:' || coalesce(cast(doc_id as varchar), '')) as draw
    from documents),
totals as (
    select source, sum(size) as size, row_number() over (order by source is null, source) - 1 as place
    from sized group by source),
weighed as (
    select source, size, 2 * size as cap,
        case place % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
        1.5 * sum(size) over () as total
    from totals),
filled as (
    select a.source, a.size, a.cap, a.weight, a.total,
        (select sum(least(b.cap * a.weight, b.weight * a.cap)) from weighed b) <= a.total * a.weight as is_full
    from weighed a),
leveled as (
    select *, (total - coalesce(sum(case when is_full then cap end) over (), 0))
        / nullif(sum(case when is_full then 0 else weight end) over (), 0) as level
    from filled),
targets as (
    select source, cast(size as bigint) as source_size,
        case when is_full then cast(cap as double) else cast(weight * level as double) end as target
    from leveled),
running as (
    select doc_id, source, size,
        sum(size) over (partition by source order by draw rows unbounded preceding) - size as before
    from sized)
select r.doc_id, cast(r.size as bigint) as size, t.source_size, t.target,
    cast(case when t.source_size = 0 then 0 else
        floor(round(t.target) / t.source_size) * r.size
        + greatest(0, least(r.size, round(t.target) - floor(round(t.target) / t.source_size) * t.source_size - r.before))
        end as bigint) as taken
from running r join targets t on r.source is not distinct from t.source
"""
