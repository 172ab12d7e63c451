"""Exact deduplication by Grace hashing.

Records are partitioned by content hash until the distinct content of every
bucket fits one in-memory table; the shuffle files are the spill files of that
partitioning, so a lost executor's buckets are rebuilt by Spark. Bucket sizes
are measured beforehand from (hash, bytes) rows; a bucket beyond the budget is
partitioned again with another hash, recursively, until it fits or holds one
hash value. Each bucket is then merged in one open-addressing table (a Python
dict: open addressing, complete keys compared on every hit) whose key is the
whole text. A task reads its partition sorted by bucket and empties the table
after each, so the number of buckets follows the data, memory a bucket, and the
number of partitions the session's settings.

Copies are merged in the map tasks first (same table, emptied whenever it
reaches its budget), so a group that holds a third of all rows reaches its
bucket as one record per map task.

Edge cases: a null text counts as empty; empty texts are equal to each other;
a null doc_id is smaller than any other; of rows that repeat both doc_id and
text one stays; other columns of any name pass through unchanged; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.session import cut_lineage

from .common import frees, join_counted, worker_cache

BUCKET_BYTES = 32 << 20  # distinct content that one table may hold
LEVEL_FAN_OUT = 8        # sub-buckets of a bucket that does not fit


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _merge(budget: int | None, schema: pa.Schema):
    """mapInArrow function over (hash, content, id, rest, n): one record per
    distinct content, holding the row of the largest id and the number of
    rows. With a budget the table is emptied when its content reaches it
    (partial merge); without, rows come with their bucket as a last column and
    sorted by it, and the table is emptied after each bucket."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("exact_dedup")
        table: dict[str, list] = {}
        held, at = 0, None

        def out():
            rows = [[v[0] for v in table.values()], list(table), *([v[i] for v in table.values()] for i in (1, 2, 3))]
            for k in range(0, len(table), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[k:k + 4096], f.type) for c, f in zip(rows, schema)], schema=schema)
            table.clear()

        for batch in batches:
            hashes, ids, rests, counts = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            buckets = [None] * len(batch) if budget else batch.column(5).to_pylist()
            for h, content, key, rest, n, bucket in zip(hashes, batch.column(1), ids, rests, counts, buckets):
                if bucket != at:
                    yield from out()
                    at = bucket
                content = content.as_py()
                slot = table.get(content)
                if slot is None:
                    table[content] = [h, key, rest, n]
                    held += len(content)
                    continue
                slot[3] += n
                mine, theirs = (slot[1] is not None, slot[1] or 0), (key is not None, key or 0)
                if theirs > mine or theirs == mine and str(rest) > str(slot[2]):
                    slot[1], slot[2] = key, rest
            if budget and held > budget:
                yield from out()
                held = 0
        yield from out()

    return run


def merge_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per distinct content: (hash, content, id, rest, n); id is the
    largest of the group, rest the other columns of that row, n the rows."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(F.col(text_col).isNull().alias("no_text"), F.struct(*others or [F.lit(0)]).alias("columns"))
    records = docs.select(F.xxhash64(_text(text_col)).alias("hash"), _text(text_col).alias("content"),
                          F.col(id_col).alias("id"), rest.alias("rest"), F.lit(1).cast("long").alias("n"))
    sizes = (records.select("hash", F.octet_length("content").cast("long").alias("bytes"))
             .groupBy("hash").agg(F.max("bytes").alias("bytes")))
    return _grace(records, cut_lineage(sizes), 0, bucket_bytes)


def _grace(records: DataFrame, sizes: DataFrame, level: int, bucket_bytes: int) -> DataFrame:
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    fan = max(1, -(-total // bucket_bytes)) if level == 0 else LEVEL_FAN_OUT * max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(fan)).alias("bucket")
    sized = sizes.groupBy(bucket).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("hashes"))
    over = sized.filter((F.col("bytes") > 2 * bucket_bytes) & (F.col("hashes") > 1)).select("bucket")
    merged = []
    if not over.isEmpty():
        over = cut_lineage(over)
        merged.append(_grace(records.withColumn("bucket", bucket).join(over, "bucket", "left_semi").drop("bucket"),
                             cut_lineage(sizes.withColumn("bucket", bucket).join(over, "bucket", "left_semi")
                                         .drop("bucket")), level + 1, bucket_bytes))
        records = records.withColumn("bucket", bucket).join(over, "bucket", "left_anti").drop("bucket")
    schema = T.StructType(records.schema.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    partial = records.mapInArrow(_merge(bucket_bytes, arrow), schema)
    spilled = partial.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket")
    out = spilled.mapInArrow(_merge(None, arrow), schema)
    for m in merged:
        out = out.unionByName(m)
    return out


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay (largest id of each group of equal texts), with the
    columns of ``docs``."""
    kept = merge_copies(docs, id_col, text_col)
    cols = {id_col: F.col("id"), text_col: F.when(~F.col("rest.no_text"), F.col("content"))}
    rest = F.col("rest.columns")
    return kept.select(*[cols[c].alias(c) if c in cols else rest.getField(c).alias(c) for c in docs.columns])


def duplicate_map(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Groups come from ``merge_copies``, which compares contents; rows find
    theirs by (sha256, 64-bit hash) of the content."""
    digest = F.sha2(_text(text_col), 256)
    rows = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), digest.alias("text_sha256"),
                                   F.xxhash64(_text(text_col)).alias("hash")))
    groups = merge_copies(docs.select(id_col, text_col), id_col, text_col).mapInArrow(
        _digests, "hash long, text_sha256 string, keep_id long, group_size long")
    groups = cut_lineage(groups.withColumn("key", F.struct("text_sha256", "hash")).drop("text_sha256", "hash"))
    keyed = rows.withColumn("key", F.struct("text_sha256", "hash")).select("key", "doc_id")
    out = join_counted(keyed, groups, "key", "group_size", rows.count())
    from pyspark.sql import Window as W

    top = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # rows that repeat a doc_id with its text: the first of them stays
    first = F.row_number().over(W.partitionBy("doc_id", "key").orderBy("group_size")) == 1
    return out.select("doc_id", "keep_id", "group_size", (top & first).alias("kept"),
                      F.col("key.text_sha256").alias("text_sha256"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, sha256, keep_id, group_size) of a bucket's groups."""
    for b in batches:
        digests = [hashlib.sha256(t.as_py().encode()).hexdigest() for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(digests), b.column(2), b.column(4)],
            names=["hash", "text_sha256", "keep_id", "group_size"])
