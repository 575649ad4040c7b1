"""Find benchmark items in documents by SimHash windows.

A window has as many five-word shingles as a benchmark item. A document and an
item are paired if the document has one of the item's rarest shingles: of so
many of them that the others alone cannot reach the similarity asked for. A
line that many items and documents have in common is not among them. Windows
are then drawn where a shingle shared with the item puts its start, and where
such a shingle comes last. The best of all windows is among the latter: a window
whose last shingle is not shared loses nothing when it moves back by one, until
it ends with a shared one or begins with the text. They are cut out only where
such shingles stand close enough. Each window and each item gets a 60-bit
SimHash, cut into one block more than the radius: fingerprints within the radius
are equal in a block at least, so only those that share one are candidates; for
these the exact weighted similarity of the shingles decides.

The similarity is that of multisets: sum of the smaller over sum of the larger
count of each shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import Stages
from .common import ROW_KEY, lower_ascii, row_key, same_row, words

SHINGLE = 5
BITS = 60
#: Two multisets with similarity 0.75 share 6/7 of their weight; their
#: fingerprints differ in 10 bits on average with a deviation of 3, and in more
#: than 26 with a chance of about 1e-7.
RADIUS = 26
#: Rows of item shingles that are broadcast at most (some 50 MB); beyond that
#: they are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Documents with a shared shingle whose ids are broadcast at most.
BROADCAST_DOCS = 300_000

#: Four lanes of 15 bits; the lowest bit of each.
LANE_BITS = 15
LANES = sum(1 << (LANE_BITS * lane) for lane in range(4))


def word_hashes(text: Column) -> Column:
    return F.transform(words(lower_ascii(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w))


def shingles(hashes: str) -> Column:
    """Hashes of all five-word runs of a column of word hashes, in order.

    A shorter text has one shingle of all its words, an empty one has none.
    """
    h, size = F.col(hashes), F.size(hashes)
    runs = F.transform(
        F.sequence(F.lit(0), size - SHINGLE),
        lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(SHINGLE))),
    )
    short = F.array(F.xxhash64(h))
    return F.when(size >= SHINGLE, runs).when(size > 0, short).otherwise(
        F.array().cast("array<bigint>")
    )


def with_shingles(df: DataFrame, text_column: str, *keep: str | Column) -> DataFrame:
    """``keep`` and the columns ``hs`` (shingles) and ``n`` (their number)."""
    hashed = df.select(*keep, word_hashes(F.col(text_column)).alias("__words"))
    names = [c for c in hashed.columns if c != "__words"]
    return hashed.select(*names, shingles("__words").alias("hs")).withColumn("n", F.size("hs"))


def simhash(hashes: Column) -> Column:
    """Bit i is set where more than half of the shingles have it set.

    Four counters of 15 bits share a number, so 15 sums count all 60 bits.
    Exact for windows of up to 16,383 shingles.
    """
    fingerprint, ones = F.lit(0).cast("bigint"), F.lit(LANES).cast("bigint")
    # adding this makes the top bit of a lane tell count > half
    add = (F.lit((1 << (LANE_BITS - 1)) - 1) - F.shiftright(F.size(hashes), 1)) * ones
    for bit in range(LANE_BITS):

        def add_lanes(total: Column, h: Column) -> Column:
            return total + F.shiftrightunsigned(h, bit).bitwiseAND(ones)  # noqa: B023

        count = F.aggregate(hashes, F.lit(0).cast("bigint"), add_lanes)
        over = F.shiftrightunsigned(count + add, LANE_BITS - 1).bitwiseAND(ones)
        fingerprint = fingerprint.bitwiseOR(F.shiftleft(over, bit))
    return fingerprint


def blocks(fingerprint: str, radius: int) -> Column:
    """``radius + 1`` numbers: the blocks of a fingerprint, each with its place."""
    edges = [BITS * j // (radius + 1) for j in range(radius + 2)]
    parts = []
    for j, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        part = F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        parts.append((F.lit(j).cast("bigint") * F.lit(1 << 32)) + part)
    return F.array(*parts)


def common_weight(a: str, b: str) -> Column:
    """Sum of the smaller counts of two arrays of shingles."""
    left, right = F.col(a), F.col(b)
    shared = F.array_intersect(left, right)
    repeated = (F.size(F.array_distinct(left)) < F.size(left)) & (
        F.size(F.array_distinct(right)) < F.size(right)
    )
    counts = F.aggregate(
        shared,
        F.lit(0),
        lambda total, h: total
        + F.least(
            F.size(F.filter(left, lambda x: x == h)), F.size(F.filter(right, lambda x: x == h))
        ),
    )
    # without repeats on one side no shared shingle counts more than once
    return F.when(repeated, counts).otherwise(F.size(shared))


def dense_ends(percent: int) -> Column:
    """Those of ``positions`` at which a window can end that is similar enough.

    ``positions`` are the places of a text's ``n`` shingles that an item of
    ``m`` has, in order. A window has to hold so many of them that they would
    do if each counted in full, which it does at the most.
    """
    size = F.least("n", "m") + F.col("m")
    least = F.greatest(F.lit(1), F.ceil(size * percent / (100 + percent))).cast("int")

    def dense(end: Column, k: Column) -> Column:
        return (k >= least - 1) & (end - F.get("positions", k - least + 1) < F.col("m"))

    return F.filter("positions", dense)


def rarest(held: DataFrame, hits: DataFrame, percent: int) -> DataFrame:
    """``item_id, m, h``: shingles of which a similar window has one at least.

    An item's shingles are ordered by how often documents have them. A similar
    window shares ``percent`` / 100 of the item's weight ``m`` or more, whatever its own
    size; shingles after which less than that is left cannot be all it shares.
    """
    known = hits.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    counted = held.join(known, "h", "left").fillna(0, ["often"])
    rest = Window.partitionBy("item_id", "m").orderBy("often", "h")
    rest = rest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = counted.withColumn("left", F.sum("times").over(rest))
    return left.filter(F.col("left") * 100 >= F.col("m") * percent).select("item_id", "m", "h")


def _broadcast(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    stages: Stages,
    percent: int = 75,
    radius: int = RADIUS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Windows of documents that are near copies of a benchmark item.

    One row for each document row and item with a similar window: the columns
    of ``common.row_key`` (they identify the row), ``item_id``, ``start`` (the
    word the best window begins at; of equals the first that is aligned, with a
    shared shingle in its own place of an item, or else the first), ``n_common,
    n_union`` (weights shared and in all), and ``similarity``, their quotient,
    of at least ``percent`` / 100; no window of the item's size is more similar.
    A window at the end of a document is
    shortened to it. Texts or items without words, and empty tables, give no
    rows; repeated rows have one result between them; NULL ids are ids.
    """
    items = with_shingles(benchmark, item_text, F.col(item_column).alias("item_id"))
    items = items.select("item_id", "hs", F.col("n").alias("m"), simhash(F.col("hs")).alias("fp"))
    items = stages.write("items", items)  # a filter before this would inline the shingles
    held = items.select("item_id", "m", F.explode("hs").alias("h")).groupBy("item_id", "m", "h")
    held = stages.write("held", held.agg(F.count(F.lit(1)).alias("times")))
    shared = _broadcast(stages.write("shared", held.select("h").distinct()), BROADCAST_ROWS)

    hashed = with_shingles(docs, text_column, *row_key(id_column, text_column))
    # the outer form, as the other adds a filter that computes the shingles again
    at = hashed.select(*ROW_KEY, "n", F.posexplode_outer("hs").alias("position", "h"))
    hits = stages.write("hits", at.join(shared, "h"))
    rare = _broadcast(stages.write("rare", rarest(held, hits, percent)), BROADCAST_ROWS)
    near = stages.write("paired", hits.join(rare, "h").select(*ROW_KEY, "item_id", "m").distinct())
    near = near.withColumnsRenamed({c: f"{c}_paired" for c in ROW_KEY})
    of_row = [hits[c].eqNullSafe(near[f"{c}_paired"]) for c in ROW_KEY]
    own = _broadcast(held.select(F.col("item_id").alias("__item"), F.col("m").alias("__m"), F.col("h").alias("__h")), BROADCAST_ROWS)
    of_item = (F.col("h") == F.col("__h")) & (F.col("m") == F.col("__m")) & F.col("item_id").eqNullSafe(F.col("__item"))
    met = hits.join(near, of_row).join(own, of_item, "left_semi").groupBy(*ROW_KEY, "n", "item_id", "m")
    met = met.agg(F.array_sort(F.collect_set("position")).alias("positions"))
    pairs = met.withColumn("ends", dense_ends(percent)).filter("size(ends) > 0")
    pairs = stages.write("pairs", pairs.select(*ROW_KEY, "item_id", "m", "ends"))

    hit = _broadcast(stages.write("hit", pairs.select(*ROW_KEY).distinct()), BROADCAST_DOCS)
    keyed = docs.select(*row_key(id_column, text_column), F.col(text_column).alias("__text"))
    touched = keyed.join(hit, same_row(keyed, hit), "left_semi").dropDuplicates(list(ROW_KEY))
    touched = stages.write("touched", with_shingles(touched, "__text", *ROW_KEY))

    anchors = items.select("m", F.posexplode("hs").alias("offset", "h")).distinct()
    anchors = _broadcast(stages.write("anchors", anchors), BROADCAST_ROWS)
    start = F.greatest(F.lit(0), F.least(F.col("position") - F.col("offset"), F.col("n") - F.col("m")))
    # only for sizes of items that the row is paired with
    wanted = pairs.select(*ROW_KEY, F.col("m").alias("size")).distinct()
    wanted = stages.write("wanted", wanted).withColumnsRenamed({c: f"{c}_of" for c in ROW_KEY})
    of_row = [hits[c].eqNullSafe(wanted[f"{c}_of"]) for c in ROW_KEY]
    inside = hits.join(wanted, of_row).select(*ROW_KEY, "n", "position", "h", "size")
    aligned = inside.join(anchors.withColumnRenamed("m", "size"), ["size", "h"]).withColumnRenamed("size", "m")
    aligned = aligned.select(*ROW_KEY, "m", start.alias("start"), F.lit(True).alias("aligned"))
    last = F.greatest(F.lit(0), F.col("end") - F.col("m") + 1)
    ending = pairs.select(*ROW_KEY, "m", F.explode("ends").alias("end"))
    ending = ending.select(*ROW_KEY, "m", last.alias("start"), F.lit(False).alias("aligned"))
    starts = aligned.union(ending).groupBy(*ROW_KEY, "m", "start").agg(F.max("aligned").alias("aligned"))

    starts = stages.write("starts", starts)
    touched = touched.withColumnsRenamed({c: f"{c}_touched" for c in ROW_KEY})
    on = [starts[c].eqNullSafe(touched[f"{c}_touched"]) for c in ROW_KEY]
    windows = starts.join(touched, on).select(
        *ROW_KEY, "m", "start", "aligned", F.slice("hs", F.col("start") + 1, F.col("m")).alias("hs")
    )
    windows = stages.write("windows", windows.withColumn("fp", simhash(F.col("hs"))))

    of_item = items.selectExpr("item_id AS __item", "m AS __m", "fp AS item_fp")
    with_fp = pairs.select(*ROW_KEY, "item_id", "m").join(
        of_item, F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("m") == F.col("__m"))
    )
    with_fp = with_fp.select(*(F.col(c).alias(f"{c}_near") for c in (*ROW_KEY, "m")), "item_id", "item_fp")
    of_window = [windows[c].eqNullSafe(F.col(f"{c}_near")) for c in (*ROW_KEY, "m")]
    of_block = F.arrays_overlap(blocks("fp", radius), blocks("item_fp", radius))
    near = (
        windows.select(*ROW_KEY, "m", "start", "fp")
        .join(with_fp, [*of_window, of_block])
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select(*ROW_KEY, "m", "start", "item_id")
        .distinct()
    )
    near = stages.write("candidates", near.withColumnsRenamed({c: f"{c}_near" for c in ROW_KEY}))
    found = (
        near.withColumnsRenamed({"m": "m_near", "start": "start_near"})
        .join(
            windows,
            [windows[c].eqNullSafe(F.col(f"{c}_near")) for c in ROW_KEY]
            + [F.col("m") == F.col("m_near"), F.col("start") == F.col("start_near")],
        )
        .drop("m_near", "fp")
        .join(
            items.selectExpr("item_id AS __item", "m AS __m", "hs AS item_hs"),
            F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("m") == F.col("__m")),
        )
    )
    common = common_weight("hs", "item_hs").cast("bigint")
    total = (F.size("hs") + F.size("item_hs")).cast("bigint")
    scored = found.select(*ROW_KEY, "item_id", "start", "aligned", common.alias("n_common"), total.alias("__sizes"))
    scored = scored.withColumn("n_union", F.col("__sizes") - F.col("n_common")).filter(
        F.col("n_common") * 100 >= F.col("n_union") * percent
    )
    scored = scored.withColumn("similarity", F.col("n_common") / F.col("n_union"))
    best = F.struct("similarity", "aligned", (-F.col("start")).alias("back"), "n_common", "n_union")
    return (
        scored.groupBy(*ROW_KEY, "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            *ROW_KEY,
            "item_id",
            (-F.col("best.back")).cast("bigint").alias("start"),
            "best.n_common",
            "best.n_union",
            "best.similarity",
        )
    )


def decontaminate(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in which :func:`find_items` found nothing."""
    keyed = docs.select("*", *row_key(id_column, text_column))
    hit = found.select(*ROW_KEY).distinct()
    return keyed.join(hit, same_row(keyed, hit), "left_anti").select(*docs.columns)
