"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import SPACED_WORD, stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
# 60 bits of hash in five levels of 12 bits.
_LEVELS = 5
_LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACED_WORD)).cast("long")


def ticket(doc_id: Column, seed: str = SEED) -> Column:
    """60 bits that depend on the document's id only, so that reruns agree."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _numbered(sources: DataFrame, spread: int) -> DataFrame:
    """`place` of each source by code point from 0, null last, without a single task."""
    ranged = stored(
        sources.repartitionByRange(spread, F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "sources",
    )
    # One row for each range: as many as `spread`.
    before, offsets = 0, []
    for row in sorted(ranged.groupBy("part").count().collect()):
        offsets.append((row["part"], before))
        before += row["count"]
    if not offsets:
        return ranged.select("source", "source_size", F.col("at").alias("place"))
    table = sources.sparkSession.createDataFrame(offsets, "part int, before long")
    return ranged.join(table, "part").select(
        "source", "source_size", (F.col("at") + F.col("before")).alias("place")
    )


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """`source, source_size` to `source, source_size, target`.

    Sources in the order of their code points (null last) get `weights` in turn and
    share the total of all sizes; a target stops at `most` times its source's size,
    and what that leaves is shared again by weight until none is above. Rounds run
    over whole numbers, so the order of summing cannot show. Sources of size zero get
    zero.
    """
    spread = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weight = F.element_at(
        F.array(*(F.lit(w).cast("long") for w in weights)),
        (F.col("place") % len(weights) + 1).cast("int"),
    )
    table = stored(
        _numbered(sources, min(spread, 64)).select(
            "source", "source_size", weight.alias("weight")
        ),
        "weights",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rest, shares = total, table.agg(F.sum("weight")).first()[0] or 1
    while True:
        share = F.col("weight") * F.lit(float(rest)) / F.lit(float(shares))
        above = share > most * F.col("source_size")
        row = table.agg(
            F.sum(F.when(above, most * F.col("source_size"))).alias("size"),
            F.sum(F.when(above, F.col("weight"))).alias("weight"),
        ).first()
        left, open_shares = total - (row["size"] or 0), None
        if row["weight"] is not None:
            open_shares = (table.agg(F.sum("weight")).first()[0]) - row["weight"]
        if open_shares is None or (left, open_shares) == (rest, shares) or not open_shares:
            break
        rest, shares = left, open_shares
    cap = (most * F.col("source_size")).cast("double")
    return table.select("source", "source_size", F.least(cap, share).alias("target"))


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """`source, copies, threshold`: documents with a smaller ticket get one copy more.

    Sizes are summed by source and the first 12 bits of the ticket; the bucket in which
    the budget ends is the only one that the next level looks into. What meets in one
    place is a histogram of 4096 buckets a source, never documents. At the last level
    the bucket is taken if that comes nearer to the budget.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    open_ = stored(
        goals.select(
            "source",
            F.coalesce(whole, F.lit(0)).cast("long").alias("copies"),
            "target",
            "source_size",
        ).select(
            "source",
            "copies",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
            F.lit(0).cast("long").alias("low"),
        ),
        "budgets",
    )
    ready = None
    for level in range(_LEVELS):
        shift = _LEVEL_BITS * (_LEVELS - 1 - level)
        same = F.col("r.source").eqNullSafe(F.col("o.source"))
        within = (F.col("r.ticket") >= F.col("o.low")) & (
            F.col("r.ticket") < F.col("o.low") + F.lit(1 << (shift + _LEVEL_BITS))
        )
        sums = (
            rows.alias("r")
            .join(open_.alias("o"), same & within)
            .groupBy(
                F.col("r.source").alias("source"),
                F.shiftright("r.ticket", shift).alias("bucket"),
            )
            .agg(
                F.sum("r.size").alias("size"),
                F.min("o.budget").alias("budget"),
                F.min("o.copies").alias("copies"),
                F.count("*").alias("n"),
            )
        )
        order = Window.partitionBy("source").orderBy("bucket")
        running = sums.withColumn("upto", F.sum("size").over(order))
        # The first bucket that does not fit is the boundary; a source without one
        # takes all its documents.
        first = F.row_number().over(order)
        edge = running.where("upto > budget").withColumn("first", first).where("first = 1")
        edge = stored(
            edge.select(
                "source",
                "copies",
                (F.col("budget") - F.col("upto") + F.col("size")).alias("budget"),
                F.shiftleft("bucket", shift).alias("low"),
                "size",
                "n",
            ),
            f"edges{level}",
        )
        none = F.col("o.source").eqNullSafe(F.col("e.source"))
        all_in = (
            open_.alias("o")
            .join(edge.alias("e"), none, "left_anti")
            .select(
                "source",
                "copies",
                (F.col("low") + F.lit(1 << (shift + _LEVEL_BITS))).alias("threshold"),
            )
        )
        last = (F.col("n") == 1) if level < _LEVELS - 1 else F.lit(True)
        nearer = F.col("budget") * 2 >= F.col("size")
        done = edge.where(last).select(
            "source",
            "copies",
            F.when(nearer, F.col("low") + F.lit(1 << shift))
            .otherwise(F.col("low"))
            .alias("threshold"),
        )
        found = all_in.unionByName(done)
        ready = found if ready is None else ready.unionByName(found)
        if level < _LEVELS - 1:
            open_ = stored(edge.where(~last).drop("size", "n"), f"open{level}")
            if open_.isEmpty():
                break
    return stored(ready, "thresholds")


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each source of `rows` (`source, size, ticket`): what the mix takes of it."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, most), "targets")
    limits = _thresholds(rows, goals)
    return stored(
        goals.alias("g")
        .join(limits.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")))
        .select("g.source", "source_size", "target", "copies", "threshold"),
        "plan",
    )


def _sizes(docs: DataFrame, text: str) -> DataFrame:
    return stored(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            docs["source"].alias("source"),
            word_count(docs[text]).alias("size"),
            ticket(docs["doc_id"]).alias("ticket"),
        ),
        "sizes",
    )


def _times(ticket_: Column, most: int) -> Column:
    more = (ticket_ < F.col("p.threshold")).cast("long")
    return F.least(F.col("p.copies") + more, F.lit(most).cast("long"))


def mix(
    docs: DataFrame,
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row for each row of `docs`: `doc_id, size` (words), `source, source_size,
    target` (of the source) and `copies`. A document is taken whole, as often as its
    target holds its source, and once more if its ticket lies under the source's threshold:
    at most `most` times. A source misses its target by half of the document at its
    boundary, at most (rows that repeat an id stand or fall together). Null text has no
    words, null is a source of its own, and an empty table gives no rows.
    """
    rows = _sizes(docs, text)
    return (
        rows.alias("r")
        .join(plan(rows, weights, most).alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select(
            "r.doc_id",
            "r.size",
            "r.source",
            "p.source_size",
            "p.target",
            _times(F.col("r.ticket"), most).alias("copies"),
        )
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the mix takes, with `copies`: how often to read each.

    The plan has a row for each source; documents meet it and not each other.
    Documents without words stay out, for nothing is taken from them. A column
    `copies` that the documents already have is replaced.
    """
    docs = docs.drop("copies")
    limits = plan(_sizes(docs, "text"))
    return (
        docs.where(word_count(docs["text"]) > 0)
        .select(F.struct("*").alias("doc"))
        .alias("d")
        .join(limits.alias("p"), F.col("d.doc.source").eqNullSafe(F.col("p.source")))
        .select("doc", _times(ticket(F.col("d.doc.doc_id")), MOST).alias("taken"))
        .where("taken > 0")
        .select("doc.*", F.col("taken").alias("copies"))
    )
