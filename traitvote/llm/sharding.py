"""Shards by extendible hashing.

A directory maps the leading bits of a document's hash to a shard. It starts
with one bucket; a bucket over the byte limit is split on one more bit, the
others stay as they are. Sizes come from one aggregation of the rows to cells
(prefixes somewhat longer than a shard needs); splitting then works on cells.
Cells that are still too large are counted again with more bits, and only
they. Rows that share all bits are dealt to numbered pages of their bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import Stages

HASH_BITS = 60
#: Bits that one round of counting looks beyond the depth an even spread needs.
SPARE_BITS = 4
ROUND_BITS = 12
#: Rows of one hash that are numbered together.
PAGE_GROUP = 1000


def hash_of(id_column: str, text_column: str) -> Column:
    """60 bits of the MD5 of the id; of the text where there is no id."""
    key = F.coalesce(F.col(id_column).cast("string"), F.col(text_column), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def bytes_of(text_column: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_column)), F.lit(0)).cast("bigint")


def _prefix(hash_column: str, depth: int) -> Column:
    return F.shiftright(F.col(hash_column), HASH_BITS - depth)


def _nodes(cells: DataFrame, low: int, high: int) -> DataFrame:
    """``depth, prefix, bytes`` of the cells, which are at ``high``, and all above."""
    depths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    spread = cells.select(depths, F.col("prefix").alias("__cell"), "bytes")
    prefix = F.expr(f"shiftright(__cell, {high} - depth)").alias("prefix")
    return spread.groupBy("depth", prefix).agg(F.sum("bytes").alias("bytes"))


def _split(nodes: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Buckets ``depth, prefix, bytes`` within the limit, and those full at ``high``.

    A bucket is a node whose parent had to be split; what is above ``low`` is
    known to be too large. A parent has two children, so no key is hot.
    """
    ends = nodes.filter((F.col("bytes") <= limit) | (F.col("depth") == high))
    parents = nodes.filter(F.col("bytes") > limit).select(
        (F.col("depth") + 1).alias("__depth"), F.col("prefix").alias("__parent")
    )
    on = (F.col("depth") == F.col("__depth")) & (F.shiftright("prefix", 1) == F.col("__parent"))
    return ends.filter(F.col("depth") == low).unionByName(ends.join(parents, on, "left_semi"))


def _directory(cells: DataFrame, buckets: DataFrame, high: int) -> DataFrame:
    """The bucket of each cell, ``cell, depth, prefix, bytes``."""
    least, most = buckets.agg(F.min("depth"), F.max("depth")).first()
    if least is None:
        least = most = high
    depths = F.explode(F.sequence(F.lit(least), F.lit(most))).alias("depth")
    spread = cells.select(F.col("prefix").alias("cell"), depths).withColumn(
        "prefix", F.expr(f"shiftright(cell, {high} - depth)")
    )
    return spread.join(buckets, ["depth", "prefix"]).select("cell", "depth", "prefix", "bytes")


def shard_directory(sizes: DataFrame, stages: Stages, limit: int) -> list[tuple[int, DataFrame]]:
    """Directories ``cell, depth, prefix, bytes, full`` by number of bits.

    ``sizes`` has ``__hash, __bytes``. There is one directory as long as the
    hashes are even, and a further one for cells that are too large for it.
    """
    total = sizes.agg(F.sum("__bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    rows, directories = sizes, []
    while True:
        cells = rows.groupBy(_prefix("__hash", high).alias("prefix")).agg(
            F.sum("__bytes").alias("bytes")
        )
        cells = stages.write(f"cells_{high}", cells)
        nodes = stages.write(f"nodes_{high}", _nodes(cells, low, high))
        buckets = stages.write(f"buckets_{high}", _split(nodes, low, high, limit))
        directory = _directory(cells, buckets, high)
        directory = directory.withColumn("full", F.col("bytes") > limit)
        directory = stages.write(f"directory_{high}", directory)
        directories.append((high, directory))
        full = directory.filter("full").select(F.col("cell").alias("__cell"))
        if high == HASH_BITS or full.isEmpty():
            return directories
        rows = rows.withColumn("__cell", _prefix("__hash", high)).join(full, "__cell", "left_semi")
        low, high = high, min(HASH_BITS, high + ROUND_BITS)


def _pages(docs: DataFrame, limit: int) -> DataFrame:
    """Number the pages of buckets whose rows share all bits of the hash.

    Rows are dealt to groups of bounded size first, so no bucket is gathered
    in one task. Half the limit is filled before the next page begins, and a
    row over half of it has a page of its own; so a page keeps to the limit.
    """
    small = F.col("__bytes") * 2 <= limit
    per_hash = Window.partitionBy("__hash", "__group").orderBy("__row")
    before = F.sum(F.when(small, F.col("__bytes")).otherwise(0)).over(
        per_hash.rowsBetween(Window.unboundedPreceding, -1)
    )
    page = F.when(
        small, F.floor(F.coalesce(before, F.lit(0)) / F.lit(max(1, limit // 2)))
    ).otherwise(-F.row_number().over(per_hash))
    return docs.withColumn(
        "shard", F.concat_ws("-", "shard", F.col("__group").cast("string"), page.cast("string"))
    )


def shard(
    docs: DataFrame,
    stages: Stages,
    limit: int = 256 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows with ``shard, shard_depth, n_bytes``.

    A shard is named by the bits of its hash prefix (empty text for the one
    shard of a small table) and holds at most ``limit`` bytes of UTF-8 text,
    unless a single text is longer than that. A NULL text has no bytes; a NULL
    id is replaced by the text. Rows with one hash that exceed the limit
    together, as repeated rows can, get pages: the shard's name then ends in
    ``-group-page``. All columns stay; the three new ones replace columns of
    the same name.
    """
    sizes = docs.select(
        hash_of(id_column, text_column).alias("__hash"), bytes_of(text_column).alias("__bytes")
    )
    directories = shard_directory(stages.write("sizes", sizes), stages, limit)
    rows = docs.withColumns(
        {"__hash": hash_of(id_column, text_column), "__bytes": bytes_of(text_column)}
    )
    depth, prefix = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    full = F.lit(False)
    for bits, directory in directories:
        own = [f"__cell_{bits}", f"__depth_{bits}", f"__prefix_{bits}", f"__full_{bits}"]
        named = directory.select("cell", "depth", "prefix", "full").toDF(*own)
        rows = rows.join(named, _prefix("__hash", bits) == F.col(own[0]), "left")
        depth, prefix = F.coalesce(F.col(own[1]), depth), F.coalesce(F.col(own[2]), prefix)
        full = F.coalesce(F.col(own[3]), full)
    bits = F.when(depth == 0, F.lit("")).otherwise(F.expr("lpad(bin(__prefix), __depth, '0')"))
    rows = rows.withColumns({"__depth": depth, "__prefix": prefix, "__full": full})
    rows = rows.withColumns(
        {"shard": bits, "shard_depth": F.col("__depth"), "n_bytes": F.col("__bytes")}
    )
    names = list(dict.fromkeys([*docs.columns, "shard", "shard_depth", "n_bytes"]))
    bits, directory = directories[-1]
    if bits < HASH_BITS or directory.filter("full").isEmpty():
        return rows.select(*names)
    same = rows.filter("__full AND __depth = " + str(HASH_BITS))
    counts = same.groupBy("__hash").agg(F.count("*").alias("__n"))
    counts = stages.write("same_hash", counts)
    dealt = (
        same.withColumn("__row", F.monotonically_increasing_id())
        .join(counts, "__hash")
        .withColumn(
            "__group", F.expr(f"pmod(xxhash64(__row), CAST(ceil(__n / {PAGE_GROUP}) AS BIGINT))")
        )
    )
    rest = rows.filter(f"NOT (__full AND __depth = {HASH_BITS})")
    return rest.select(*names).unionByName(_pages(dealt, limit).select(*names))
