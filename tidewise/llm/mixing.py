"""Mixing sources to target weights by weighted fair queueing, with DataFrame
functions only.

Every source is a queue of its documents in shuffled order (md5 of doc_id),
repeated up to REPEATS times. A copy's virtual finish time is the cumulative
words of its source up to and including it, divided by the source's target.
The mix is the documents of all sources in the global (range-sorted) order of
their virtual finish times, truncated at the total budget: at virtual time 1
every source has served its target, and the targets sum to the budget. A copy
that straddles time 1 is taken when at least half of its words come before it,
so each source ends within half a document of its target.

Targets: sources in code point order, null last, have the weights 5, 2, 1
repeating; the budget is the words of all documents; a target stops at REPEATS
times its source's words and the excess is shared by weight among the others
until none is above.

Scale: word counts are summed map-side. Cumulative words use two levels, a
running sum inside (bucket, source) groups of the shuffled order, and a
running sum of the bucket totals of each source; a bucket has about
max(512, sqrt(rows)) rows, so both levels stay small at any size and a source
with a third of all rows is spread over all buckets. Nothing is broadcast by
hand.

Edge cases: a null or empty text has size 0 and is never taken; null sources
are one source, apart from the source '' ; null and repeated doc_ids are
queued like others (ties by size); when all sizes are 0 every target is 0; an
empty table gives an empty result; columns of any name pass through ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewise.session import cut_lineage

from .common import WORD_PATTERN, ranked

WEIGHTS = (5, 2, 1)
REPEATS = 3
BUCKET_ROWS = 512


def _queue_columns(id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [F.col(id_col).alias("doc_id"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            F.col(source_col).isNull().alias("no_source"),
            F.coalesce(F.col(source_col), F.lit("")).alias("source"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("shuffled")]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Targets of sources: ``sizes`` has (no_source, source, words), one row
    each; adds target. One aggregate per round of resharing; exact integers
    until the final division."""
    order = [F.col("no_source").asc(), F.col("source").asc()]
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % n + 1).cast("int"))
    s = cut_lineage(ranked(sizes, order, "rank").withColumn("weight", weight.cast("long")))
    whole = "cast(%s as decimal(38,0))"
    total, rest_weight = s.agg(F.sum("words"), F.sum("weight")).first()
    rest = total = total or 0
    while True:
        above = F.expr(f"{whole % 'weight'} * {rest} > {whole % 'words'} * {repeats * (rest_weight or 0)}")
        capped, free = s.agg(F.sum(F.when(above, F.col("words"))), F.sum(F.when(~above, F.col("weight")))).first()
        now = (total - repeats * (capped or 0), free or 0)
        if now == (rest, rest_weight):
            break
        rest, rest_weight = now
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(rest_weight or 1))
    return s.select("no_source", "source", "words",
                    F.when(above, (F.col("words") * repeats).cast("double")).otherwise(share).alias("target"))


def _served(rows: DataFrame, narrow: DataFrame) -> DataFrame:
    """``rows`` (queue columns and any others) with source_size, target,
    virtual_finish (of the first copy) and copies; ``narrow`` is a cheap frame
    of the queue columns of the same rows."""
    count = narrow.count()
    buckets = max(1, count // max(BUCKET_ROWS, math.isqrt(count)))
    place = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    bucket = F.floor(place * F.lit(buckets) / F.lit(1 << 32)).cast("long")
    totals = cut_lineage(narrow.groupBy(bucket.alias("bucket"), "no_source", "source")
                         .agg(F.sum("size").alias("words")))
    targets = source_targets(totals.groupBy("no_source", "source").agg(F.sum("words").alias("words")))
    before = W.partitionBy("no_source", "source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    starts = starts.join(targets.withColumnRenamed("words", "source_size"), ["no_source", "source"])
    inside = (W.partitionBy("bucket", "no_source", "source").orderBy("shuffled", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, 0))
    queued = (rows.withColumn("bucket", bucket).withColumn("own", F.sum("size").over(inside))
              .join(starts, ["bucket", "no_source", "source"])
              .withColumn("served", F.col("start") + F.col("own")))
    copies = sum((F.when((F.col("served") + F.col("source_size") * c) * 2 - F.col("size")
                         <= F.col("target") * 2, 1).otherwise(0) for c in range(REPEATS)), F.lit(0))
    return (queued.withColumn("copies", F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(0))
            .withColumn("virtual_finish", F.try_divide(F.col("served").cast("double"), F.col("target"))))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document, in the order of the mix: doc_id, size, source_size,
    target, taken (words, repeats counted), virtual_finish (first copy)."""
    rows = cut_lineage(docs.select(*_queue_columns(id_col, text_col, source_col)))
    out = _served(rows, rows).withColumn("taken", F.col("size") * F.col("copies"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish").orderBy(
        "virtual_finish", "doc_id")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents, each as often as it is taken, with the columns of
    ``docs``, range-sorted by virtual finish time."""
    queue = _queue_columns(id_col, text_col, source_col)
    narrow = cut_lineage(docs.select(*queue))
    served = _served(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *queue), narrow)
    rounds = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("round")
    finish = F.col("virtual_finish") + F.col("round") * F.col("source_size") / F.col("target")
    taken = served.filter("copies > 0").select("row", "virtual_finish", "source_size", "target", rounds)
    return taken.withColumn("finish", finish).orderBy("finish").select("row.*")
