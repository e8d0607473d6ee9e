"""Mixing sources to target weights by Poisson replication.

A source whose target share of the text is ``t`` and whose own share is ``s`` repeats each document ``t / s`` times on
average. A document's count is the Poisson quantile of a number that its id and the seed fix, so a rerun or a lost
executor gives the same corpus. Only one row per source is ever gathered; the table of rates is broadcast up to
``broadcast_rows`` sources and joined by shuffle beyond. The copies are then dealt out and sorted by a hash of id, copy and
seed, which spreads every source evenly over all tasks.

Nulls and ties: a NULL source is a source of its own; a NULL id counts as an empty id; a NULL or empty text adds nothing
to its source's size, and a source without any text is drawn with mean 1; rows that repeat get the same count each; a
source that given weights don't name is not drawn. Other columns pass through; the columns that this adds replace older
ones of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstand.llm.common import stored

#: 13 hexadecimal digits of a digest make an exact double.
DIGITS, SCALE = 13, float(1 << 52)


def digest(*parts: Column) -> Column:
    """52 bits that the parts fix, as a long."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, DIGITS), 16, 10).cast("long")


def poisson_table(mean: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... as far as a double can tell it from 1."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct((-mean).alias("log"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("table"))

    def grow(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(mean / k)
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["table"], F.array(total)).alias("table"))

    table = F.aggregate(F.sequence(F.lit(1), last), start, grow, lambda state: state["table"])
    return F.when(mean <= 0, F.array(F.lit(1.0))).otherwise(table)


def rates(docs: DataFrame, weights: DataFrame | None = None, exponent: float = 0.5, source: str = "source", text: str = "text") -> DataFrame:
    """(source, size, rate, table). Without ``weights`` (source, weight) a source weighs its size to the ``exponent``.

    The expected size of the mix is that of the input.
    """
    size = F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).cast("long")
    sizes = docs.groupBy(F.col(source).alias("mix_source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        named = weights.select(F.col(source).alias("w_source"), F.col("weight").cast("double").alias("weight"))
        weighed = sizes.join(named, F.col("mix_source").eqNullSafe(F.col("w_source")), "left").drop("w_source").fillna(0.0, ["weight"])
    weighed = stored(weighed)
    # One row of totals over one row per source.
    totals = weighed.agg(F.sum("size").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight"))
    total = totals.first()
    all_size, all_weight = float(total["all_size"] or 0), float(total["all_weight"] or 0)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.col("weight") / F.lit(all_weight or 1.0) * F.lit(all_size) / F.col("size")
    )
    return weighed.select("mix_source", "size", rate.alias("rate")).withColumn("table", poisson_table(F.col("rate")))


def mixed_copies(
    docs: DataFrame,
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    seed: int = 17,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    broadcast_rows: int = 50_000,
) -> DataFrame:
    """``docs`` with each row as often as drawn, in random order, and ``copy`` (from 1) and ``shuffle_key``, which replace
    older columns of these names; all others pass through."""
    table = rates(docs, weights, exponent, source, text).select("mix_source", F.col("table").alias("mix_table"))
    if table.count() <= broadcast_rows:
        table = F.broadcast(table)
    names = [name for name in docs.columns if name not in ("copy", "shuffle_key")]
    row = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)])
    held = docs.select(row.alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("origin"))
    drawn = digest(F.lit(seed), F.col("id")) / F.lit(SCALE)
    count = F.size(F.filter("mix_table", lambda below: below <= drawn))
    copies = (
        held.join(table, F.col("origin").eqNullSafe(F.col("mix_source")))
        .withColumn("mix_count", count)
        .where(F.col("mix_count") > 0)
        .select("row", "id", F.explode(F.sequence(F.lit(1), F.col("mix_count"))).alias("copy"))
    )
    keyed = copies.withColumn("shuffle_key", digest(F.lit(seed), F.col("id"), F.col("copy"))).drop("id")
    mixed = keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return mixed.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(names)], "copy", "shuffle_key")
