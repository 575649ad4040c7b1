"""A Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Rows are leaves of one binary tree for each group (a language); the groups'
subroots are leaves of a top tree, whose root stands for the dataset. Trees are
built upwards, some levels at a time, from runs of neighbours. Every node then
knows its sibling, which is its proof for one step. Self-joins double that:
a node's segment of siblings towards an ancestor, and the ancestor's own
segment of the same length, make one of twice the length, until every leaf
reaches its subroot; one more join appends the subroots' way to the root.

Everything is made of Spark's own expressions. H is SHA-256 of its inputs one
after the other, digests as lowercase hexadecimal text; tables carry digests as
32 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import Stages

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels built at a time, so leaves that meet in a row: two to this power.
SPAN = 8
#: Copies of an ancestor that a join spreads over the runs of leaves below it, as
#: a power of two.
SPREAD = 12
#: Groups whose way to the root is broadcast (about 1 kB each).
BROADCAST_GROUPS = 20_000


def _digest(value: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value as H takes it: byte count, colon, value; ``-`` if there is none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """H of the columns, which are in the order of :data:`LEAF_COLUMNS`."""
    return _digest(F.concat(*(field(columns[name]) for name in LEAF_COLUMNS)))


def is_tampered(doc_id: Column) -> Column:
    """Rows that a test of the manifest changes: 7 divides crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def numbered(rows: DataFrame, order: list[Column], stages: Stages, name: str) -> DataFrame:
    """Add ``at``, the place of each row in ``order`` over all rows, from 0.

    Rows are range-partitioned and written; a place is the number of rows in
    the partitions before plus the row's own place in its partition. Rows equal
    in ``order`` get places in no particular order.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, "__tie")
    dealt = dealt.drop("__tie").withColumn("__row", F.monotonically_increasing_id())
    dealt = stages.write(f"{name}_dealt", dealt)
    part = F.shiftright(F.col("__row"), 33)
    sizes = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row for each partition of the sort
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    starts = stages.write(f"{name}_starts", starts)
    own = F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    joined = dealt.withColumn("__part", part).join(starts, "__part")
    return joined.withColumn("at", F.col("__before") + own).drop("__part", "__before", "__row")


def _height(n: Column) -> Column:
    """Levels between a leaf and the root of a tree of ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _wide(n: Column, level: Column) -> Column:
    """Nodes on a level of a tree of ``n`` leaves."""
    return F.call_function("shiftright", n - 1, level) + 1


def _grown(lowest: Column, steps: Column) -> Column:
    """The levels above ``lowest``, itself first; each is an array of digests."""

    def above(nodes: Column) -> Column:
        pairs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / 2).cast("int"))
        return F.transform(
            pairs,
            lambda i: _digest(
                F.concat(_text(F.get(nodes, i * 2)), F.coalesce(_text(F.get(nodes, i * 2 + 1)), F.lit("")))
            ),
        )

    rounds = F.slice(F.sequence(F.lit(1), F.lit(SPAN)), F.lit(1), steps)
    return F.aggregate(
        rounds,
        F.array(lowest),
        lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))),
    )


def grow(
    leaves: DataFrame, most: int, stages: Stages, name: str, payload: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The nodes and roots of trees.

    ``leaves`` has ``tree, pos, n, digest``: the tree, the place in it, how many
    leaves it has; ``most`` is the largest ``n``. Nodes below a root have ``tree,
    n, level, pos, sibling`` and, on level 0, the ``payload`` columns; a node
    alone in its run has no sibling. Roots have ``tree, n, digest``.
    """
    made, roots, level = [], [], 0
    rest = leaves.select("tree", "n", "pos", "digest", *payload)
    while True:
        at_root = _height(F.col("n")) <= level
        if level == 0:  # a tree of one leaf is all root
            roots.append(rest.filter(at_root).select("tree", "n", "digest"))
            alone = rest.filter(at_root).select(
                "tree", "n", F.lit(0).alias("level"), "pos", F.lit(None).cast("binary").alias("sibling"), *payload
            )
            made.append(alone)
            rest = rest.filter(~at_root)
        if most <= 1 << level:
            break
        member = F.struct("pos", "digest", *payload)
        run = F.shiftright(F.col("pos"), SPAN).alias("run")
        runs = rest.groupBy("tree", "n", run).agg(F.sort_array(F.collect_list(member)).alias("members"))
        steps = F.least(F.lit(SPAN), _height(F.col("n")) - level)
        lowest = F.transform("members", lambda m: m["digest"])
        runs = stages.write(f"{name}_runs_{level}", runs.withColumn("levels", _grown(lowest, steps)))
        below = F.slice("levels", F.lit(1), F.size("levels") - 1)

        def node(digests, k, place, level=level):
            of_leaf = [
                (F.get("members", place)[c] if level == 0 else F.lit(None)).alias(c) for c in payload
            ]
            other = place + F.when(place % 2 == 0, 1).otherwise(-1)
            start = F.call_function("shiftright", F.shiftleft(F.col("run"), SPAN), k)
            own = [F.when(k == 0, c) for c in of_leaf]
            return F.struct(
                (k + level).alias("level"),
                (start + place).alias("pos"),
                F.get(digests, other).alias("sibling"),
                *(c.alias(p) for c, p in zip(own, payload, strict=True)),
            )

        nodes = F.flatten(
            F.transform(below, lambda digests, k: F.transform(digests, lambda _, i: node(digests, k, i)))
        )
        found = runs.select("tree", "n", F.inline(nodes))
        types = dict(leaves.select(*payload).dtypes)
        made.append(found.withColumns({c: F.col(c).cast(types[c]) for c in payload}))
        top = runs.select(
            "tree", "n", F.col("run").alias("pos"), F.get(F.element_at("levels", -1), F.lit(0)).alias("digest")
        )
        level += SPAN
        over = _height(F.col("n")) <= level
        roots.append(top.filter(over).select("tree", "n", "digest"))
        rest = top.filter(~over).select("*", *(F.lit(None).cast(types[c]).alias(c) for c in payload))
    nodes, tops = made[0], roots[0]
    for more in made[1:]:
        nodes = nodes.unionByName(more)
    for more in roots[1:]:
        tops = tops.unionByName(more)
    return stages.write(f"{name}_nodes", nodes), stages.write(f"{name}_roots", tops)


def jump(nodes: DataFrame, most: int, stages: Stages, name: str, payload: list[str]) -> DataFrame:
    """Leaves with ``segment``, their siblings up to the root of their tree.

    ``segment`` is an array, from the leaf upwards, NULL where a node has no
    sibling. After k joins a node's segment spans 2^k levels, and only nodes on
    every 2^k-th level are still asked for theirs. A high ancestor has many
    leaves below: it is copied to their runs, so no key of the join has more
    than some thousand rows, or a 4096th of a larger tree.
    """
    height = (most - 1).bit_length()
    # a root's step leads nowhere; only trees of one leaf have theirs among the nodes
    segment = F.when(_height(F.col("n")) > 0, F.array("sibling"))
    empty = F.array().cast("array<binary>")
    rows = nodes.select("tree", "n", "level", "pos", *payload, F.coalesce(segment, empty).alias("segment"))
    step, k = 1, 0
    while step < height:
        shift = step if step <= SPAN else max(SPAN, step - SPREAD)
        low = rows.filter(F.col("level") % (2 * step) == 0)
        high = rows.filter(F.col("level") % (2 * step) == step)
        first = F.shiftleft(F.col("pos"), step - shift)
        width = _wide(F.col("n"), F.col("level") - step)
        last = F.shiftright(F.least(F.shiftleft(F.col("pos") + 1, step - shift) * (1 << shift), width) - 1, shift)
        high = high.select(
            F.col("tree").alias("__tree"),
            (F.col("level") - step).alias("__level"),
            F.col("segment").alias("__further"),
            (F.col("pos") if shift == step else F.explode(F.sequence(first, last))).alias("__run"),
        )
        if shift != step:  # its copies are more than Spark expects
            high = high.hint("merge")
        on = (
            (F.col("tree") == F.col("__tree"))
            & (F.col("level") == F.col("__level"))
            & (F.shiftright(F.col("pos"), shift) == F.col("__run"))
        )
        joined = low.join(high, on, "left")
        longer = F.concat("segment", F.coalesce("__further", empty)).alias("segment")
        rows = stages.write(
            f"{name}_jump_{k}", joined.select("tree", "n", "level", "pos", *payload, longer)
        )
        step, k = 2 * step, k + 1
    return rows.filter("level = 0").drop("level")


def fold(digest: Column, pos: Column, segment: Column) -> Column:
    """The root that a leaf, its place and its siblings lead to."""

    def up(state: Column, sibling: Column) -> Column:
        own, other = _text(state["digest"]), F.coalesce(_text(sibling), F.lit(""))
        both = F.when(state["pos"] % 2 == 0, F.concat(own, other)).otherwise(F.concat(other, own))
        return F.struct(
            _digest(both).alias("digest"), F.shiftright(state["pos"], 1).alias("pos")
        )

    start = F.struct(digest.alias("digest"), pos.cast("bigint").alias("pos"))
    return F.aggregate(segment, start, up, lambda state: state["digest"])


def proof_digest(segment: Column) -> Column:
    """H of the siblings of a proof."""
    siblings = F.transform(F.filter(segment, lambda s: s.isNotNull()), _text)
    return F.sha2(F.array_join(siblings, ""), 256)


def manifest(docs: DataFrame, stages: Stages, group: str = "lang") -> DataFrame:
    """The leaf, the way to the root and the root, for each row of ``docs``.

    Returns ``doc_id, tree, pos, top_pos, leaf, tampered, segment, top_segment,
    subroot, root``: the place in its group's tree and the group's in the top
    tree, digests as bytes, ``tampered`` the leaf with one more in ``n_chars`` for
    the rows of :func:`is_tampered`. Groups are ordered bytewise, NULL first; a
    group's rows by id, NULL first, then by leaf. Repeated rows are leaves of
    their own; which of them has which place does not show, as they are equal.
    NULL in any column counts as ``-``; a NULL id is not tampered with. No rows
    give no rows. Further columns are left out.
    """
    plain = {name: F.col(name) for name in LEAF_COLUMNS}
    other = plain | {"n_chars": F.col("n_chars") + 1}
    changed = F.when(is_tampered(F.col("doc_id")), leaf(other))
    rows = docs.select(*LEAF_COLUMNS).withColumn("leaf", leaf(plain)).withColumn("tampered", changed)
    leaves = stages.write("leaves", rows.select("doc_id", F.col(group).alias("grp"), "leaf", "tampered"))
    order = [F.col("grp").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = stages.write("placed", numbered(leaves, order, stages, "leaves"))

    groups = placed.groupBy("grp").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    groups = stages.write("groups", groups)
    groups = numbered(groups, [F.col("grp").asc_nulls_first()], stages, "groups")
    groups = stages.write("trees", groups.withColumnRenamed("at", "tree"))
    n_groups, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()

    # a hot group meets its row once for each block of places
    block = F.shiftright(F.col("at"), SPREAD)
    spans = placed.select("grp", block.alias("block")).distinct()
    named = groups.withColumnRenamed("grp", "__grp")
    spans = spans.join(named, spans["grp"].eqNullSafe(named["__grp"])).drop("__grp")
    spans = spans.withColumnRenamed("grp", "__grp")
    keyed = placed.withColumn("block", block)
    on = (keyed["block"] == spans["block"]) & keyed["grp"].eqNullSafe(spans["__grp"])
    trees = keyed.join(spans, on).select(
        "tree", "n", (F.col("at") - F.col("start")).alias("pos"), F.col("leaf").alias("digest"), "doc_id", "tampered"
    )
    trees = stages.write("leaves_of_trees", trees.withColumn("leaf", F.col("digest")))

    payload = ["doc_id", "leaf", "tampered"]
    nodes, roots = grow(trees, most or 0, stages, "low", payload)
    below = jump(nodes, most or 0, stages, "low", payload)

    subroots = roots.select(
        F.lit(0).cast("bigint").alias("tree"),
        F.lit(n_groups).cast("bigint").alias("n"),
        F.col("tree").alias("pos"),
        "digest",
        F.col("digest").alias("subroot"),
        F.col("n").alias("below"),
    )
    nodes, top = grow(subroots, n_groups, stages, "top", ["subroot", "below"])
    above = jump(nodes, n_groups, stages, "top", ["subroot", "below"])
    above = above.select(
        F.col("pos").alias("__tree"), "subroot", "below", F.col("segment").alias("top_segment")
    )
    root = top.first()  # one row, or none of an empty table
    digest = F.lit(bytes(root["digest"]) if root else None).cast("binary")
    above = stages.write("above", above.withColumn("root", digest))
    if n_groups <= BROADCAST_GROUPS:
        whole = below.join(F.broadcast(above), F.col("tree") == F.col("__tree"))
    else:  # a group's way is copied to blocks of its leaves
        shift = F.greatest(F.lit(SPAN), _height(F.col("below")) - SPREAD)
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("shiftright", F.col("below") - 1, shift)))
        spread = above.withColumn("__run", copies).hint("merge")
        of_leaf = F.greatest(F.lit(SPAN), _height(F.col("n")) - SPREAD)
        run = F.call_function("shiftright", F.col("pos"), of_leaf)
        whole = below.join(spread, (F.col("tree") == F.col("__tree")) & (run == F.col("__run")))
    return whole.select(
        "doc_id", "tree", "pos", F.col("tree").alias("top_pos"), "leaf",
        F.coalesce("tampered", "leaf").alias("tampered"), "segment", "top_segment", "subroot", "root",
    )


def verified(rows: DataFrame) -> DataFrame:
    """Rows of :func:`manifest` with ``folded``: the root recomputed from ``tampered``."""
    folded = fold(F.col("tampered"), F.col("pos"), F.col("segment"))
    rows = rows.withColumn("__sub", folded)
    return rows.withColumn("folded", fold(F.col("__sub"), F.col("top_pos"), F.col("top_segment"))).drop("__sub")
