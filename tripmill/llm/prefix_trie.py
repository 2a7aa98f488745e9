"""Prefix trie of conversations by ROLLUP over positional turn columns.

Turns are numbered by conversation, and every WIDTH of them become one row with a column per position. GROUP BY the block,
its key, ROLLUP(t1, ..) then makes all prefixes of all blocks in one pass: grouping_id tells how many positions of a group
count. A long conversation continues in further blocks, and the key of a block is the node that the block before it ends
in. A node is known by two exclusive ors of hashes over (position, turn), so the keys of all blocks come from a running
aggregate and no block waits for another; a hot prefix reaches an exchange as one row per task.

Sums over subtrees take no walk over levels. The smallest member of a node owns it, and a conversation that owns a node
owns all further nodes on its way. So the sum over the subtree of a node is what its members own (a second ROLLUP), less
what its owner owns above it (a running sum along the owner's nodes). Running sums go in two steps, over spans of SPAN
positions and within them, and turns are numbered over sorted ranges; so a conversation of any length is spread over tasks.

The ends of a node are joined as text in blocks of ids; one task reads the blocks of a node in order and feeds them to the
digest, which holds one block at a time however many there are.

Defined results: null role or text is empty; turns go by number, null first, those of equal number by the MD5 of role and
text; equal rows are turns of their own; rows without conv_id belong to no conversation and are left out; other columns are
not looked at; a conversation without turns ends in the root; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import read, written

WIDTH = 4  # positions by block
HEADS = 6  # conversations take 0 to HEADS - 1 turns of the first one of their hundred
HUNDRED = 100
SPAN = 256  # positions whose running sums are taken together
IDS_SHIFT = 7  # conv_ids that share all bits but so many are joined at once

TURN = [f"t{j}" for j in range(1, WIDTH + 1)]
ENDS = "x long, y long, ids string"
DIGESTS = "x long, y long, ends_sha256 string"
DIGESTS_SCHEMA = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
NONE_SHA256 = hashlib.sha256(b"").hexdigest()


def _turn(role: Column, text: Column) -> Column:
    """32 hexadecimal digits for role and text, then the code points of the text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(whole.cast("binary")), F.length(text).cast("string"))


def _points(turn: Column) -> Column:
    return F.substring(turn, F.lit(33), F.lit(20)).cast("long")


def _hashes(place: Column, turn: Column) -> list[Column]:
    """What a turn adds to the two codes of its node."""
    return [F.xxhash64(F.lit(salt), place.cast("long"), F.substring(turn, F.lit(1), F.lit(32))) for salt in ("x", "y")]


def numbered(turns: DataFrame) -> DataFrame:
    """conv, turn (see `_turn`) and place, from 1, of every row with a conv_id.

    Rows are sorted into ranges first and numbered within them; what a conversation has in earlier ranges is known for
    the few that go on from one range to the next, at most one a range.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("at"), _turn(role, text).alias("turn"), F.monotonically_increasing_id().alias("row"))
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(ranges, F.col("conv"), F.col("at").asc_nulls_first(), "turn", "row")
    rows = written(rows.select("conv", "at", "turn", "row", F.spark_partition_id().alias("range")), "turns")
    counts = rows.groupBy("conv", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    goes_on = counts.withColumn("before", before).where("before > 0").select("conv", "range", "before")  # one a range at most
    own = F.row_number().over(Window.partitionBy("conv", "range").orderBy(F.col("at").asc_nulls_first(), "turn", "row"))
    rows = rows.withColumn("own", own).join(F.broadcast(goes_on), ["conv", "range"], "left")
    return rows.select("conv", "turn", (F.col("own") + F.coalesce("before", F.lit(0))).alias("place"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv, place and turn of the rebuilt conversations; one without turns has one row with a null place.

    `rows` has the original turns. The first h turns are those of the conversation that the hundred begins with.
    """
    first = rows.where((F.col("conv") % HUNDRED == 0) & (F.col("place") < HEADS))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "turn"))), lambda x: x["turn"]).alias("heads"))
    convs = rows.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % HUNDRED)
    convs = convs.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int"))
    convs = convs.join(heads, "base", "left").withColumn("heads", F.slice(F.coalesce("heads", F.array().cast("array<string>")), F.lit(1), F.col("h")))
    convs = written(convs.select("conv", "h", "heads"), "heads")
    own = rows.join(convs.select("conv", "h", F.size("heads").alias("k")), "conv").where("place > h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("k")).cast("long").alias("place"), "turn")
    taken = convs.select("conv", F.posexplode_outer("heads").alias("i", "turn")).select("conv", (F.col("i") + 1).cast("long").alias("place"), "turn")
    return own.union(taken)


def _running(rows: DataFrame, owner: str, place: str, columns: dict[str, tuple]) -> DataFrame:
    """Adds columns {name: (aggregate, column, value for none)}: the aggregate of all rows of an owner at smaller places."""
    spanned = rows.withColumn("_span", F.floor(F.col(place) / SPAN).cast("long"))
    totals = spanned.groupBy(owner, "_span").agg(*(f(c).alias(name) for name, (f, c, _) in columns.items()))
    before = Window.partitionBy(owner).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(owner, "_span", *(f(name).over(before).alias(f"_{name}") for name, (f, _, _) in columns.items())).where("_span > 0")
    within = Window.partitionBy(owner, "_span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    spanned = spanned.withColumns({name: f(c).over(within) for name, (f, c, _) in columns.items()}).join(carried, [owner, "_span"], "left")
    both = {name: f(F.array(F.coalesce(name, F.lit(none)), F.coalesce(f"_{name}", F.lit(none)))) for name, (_, _, none) in columns.items() for f in [_added(columns[name][0])]}
    return spanned.withColumns(both).drop("_span", *(f"_{name}" for name in columns))


def _added(aggregate):
    plus = (lambda a, b: a.bitwiseXOR(b)) if aggregate is F.bit_xor else (lambda a, b: a + b)
    return lambda pair: plus(pair[0], pair[1])


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv, block, x and y (the node that the block before ends in), t1 .. and the node (last_x, last_y) it ends in."""
    at = F.col("place") - 1
    rows = turns.select("conv", F.coalesce(F.floor(at / WIDTH), F.lit(0)).cast("long").alias("block"), (at % WIDTH).alias("j"), "turn", *(h.alias(n) for h, n in zip(_hashes(F.col("place"), F.col("turn")), ("hx", "hy"), strict=True)))
    own = {name: F.bit_xor(F.when(F.col("turn").isNotNull(), F.col(h))) for name, h in (("ox", "hx"), ("oy", "hy"))}
    rows = rows.groupBy("conv", "block").agg(*(F.max(F.when(F.col("j") == j, F.col("turn"))).alias(t) for j, t in enumerate(TURN)), *(F.coalesce(c, F.lit(0).cast("long")).alias(n) for n, c in own.items()))
    keyed = _running(written(rows, "blocks"), "conv", "block", {"x": (F.bit_xor, "ox", 0), "y": (F.bit_xor, "oy", 0)})
    ends = {f"last_{n}": F.col(n).bitwiseXOR(F.col(f"o{n}")) for n in ("x", "y")}
    return written(keyed.withColumns(ends).drop("ox", "oy"), "keyed-blocks")


def prefixes(blocks: DataFrame, aggregates: str) -> DataFrame:
    """The nodes of the trie with SQL aggregates over the rows of their members: x, y, parent_x, parent_y, depth, points."""
    columns = ", ".join(TURN)
    # grouping_id has a bit for each position that does not count.
    query = f"SELECT block, x, y, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} FROM {{rows}} GROUP BY block, x, y, ROLLUP({columns})"
    groups = blocks.sparkSession.sql(query, rows=blocks)
    # The node without turns of a block belongs to the block before, but for the root; nor are positions past the end nodes.
    last = F.element_at(F.array(*TURN), F.greatest(F.col("level"), F.lit(1)).cast("int"))
    groups = groups.where(((F.col("level") == 0) & (F.col("block") == 0)) | ((F.col("level") > 0) & last.isNotNull()))
    depth = F.col("block") * WIDTH + F.col("level")

    def code(n: str, which: int, most: Column) -> Column:
        out = F.col(n)
        for j, t in enumerate(TURN, 1):
            added = _hashes(F.col("block") * WIDTH + j, F.col(t))[which]
            out = out.bitwiseXOR(F.when(most >= j, added).otherwise(F.lit(0).cast("long")))
        return out

    level = F.col("level")
    parents = [F.when(level > 0, code(n, i, level - 1)).alias(f"parent_{n}") for i, n in enumerate(("x", "y"))]
    rest = [c for c in groups.columns if c not in ("block", "x", "y", "level", *TURN)]
    points = F.when(level > 0, _points(last)).otherwise(F.lit(0).cast("long")).alias("points")
    return groups.select(code("x", 0, level).alias("x"), code("y", 1, level).alias("y"), *parents, depth.cast("long").alias("depth"), points, *rest)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the ids of each node, whose blocks come one after the other in order."""
    node, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for x, y, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (x, y) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (x, y), hashlib.sha256(ids.encode())
            else:
                digest.update(b",")
                digest.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGESTS_SCHEMA, strict=True)], schema=DIGESTS_SCHEMA)
    if node is not None:
        yield pa.RecordBatch.from_pydict({"x": [node[0]], "y": [node[1]], "ends_sha256": [digest.hexdigest()]}, schema=DIGESTS_SCHEMA)


def ends_of(blocks: DataFrame) -> DataFrame:
    """x, y and ends_sha256 of the nodes in which conversations end."""
    ends = blocks.groupBy("conv").agg(F.max_by(F.struct("last_x", "last_y"), "block").alias("e")).select("conv", F.col("e.last_x").alias("x"), F.col("e.last_y").alias("y"))
    near = ends.groupBy("x", "y", F.shiftright("conv", IDS_SHIFT).alias("part")).agg(F.array_sort(F.collect_list("conv")).alias("convs"))
    near = near.select("x", "y", "part", F.array_join(F.col("convs").cast("array<string>"), ",").alias("ids"))
    ranges = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return near.repartition(ranges, "x", "y").sortWithinPartitions("x", "y", "part").select("x", "y", "ids").mapInArrow(_digests, DIGESTS)


def with_parents(nodes: DataFrame, least: int | None) -> DataFrame:
    """Adds parent_conv_id. Only the first node that a conversation owns has a parent of another owner, and of the nodes
    under the root, of which there may be any number, `least` is known to be that owner.
    """
    under = F.col("depth") == 1
    known = F.when(under, F.lit(least).cast("long")).when(F.col("owned_above"), F.col("conv_id"))
    apart = nodes.where("depth > 1 AND NOT owned_above")
    owners = nodes.select(F.col("x").alias("parent_x"), F.col("y").alias("parent_y"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.where("depth <= 1 OR owned_above").withColumn("parent_conv_id", known).unionByName(apart.join(owners, ["parent_x", "parent_y"]))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations; `turns` has conv_id, turn, role and text. See the module's text."""
    blocks = blocks_of(rebuilt(numbered(turns)))
    nodes = written(prefixes(blocks, "count(*) AS n_convs, min(conv) AS conv_id"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_x").alias("x"), F.col("parent_y").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["x", "y"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({"own_saved": (F.col("n_convs") - 1) * F.col("points"), "own_leaf": (F.col("n_children") == 0).cast("long"), "one": F.lit(1)})
    nodes = written(nodes, "owned-nodes")

    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("own_saved").alias("saved"), F.sum("own_leaf").alias("leaves"))
    weighed = blocks.join(owned, "conv", "left").withColumns({"saved": F.coalesce("saved", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(0))})
    below = prefixes(weighed, "sum(saved) AS all_saved, sum(leaves) AS n_leaves").select("x", "y", "all_saved", "n_leaves")
    above = _running(nodes, "conv_id", "depth", {"above": (F.sum, "own_saved", 0), "owned": (F.sum, "one", 0)})
    whole = above.join(below, ["x", "y"]).join(ends_of(blocks), ["x", "y"], "left")
    whole = written(whole.withColumns({"owned_above": F.col("owned") > 0, "saved_tokens": F.col("all_saved") - F.col("above")}), "whole-nodes")

    least = whole.where("depth = 0").select("conv_id").first()
    out = with_parents(whole, least["conv_id"] if least else None)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NONE_SHA256)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


# CRC-32 of the decimal number, bit by bit, as the engine has no such function.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::UBIGINT)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT)"""

ORACLE = f"""
WITH c AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, t, conv_id - conv_id % {HUNDRED} AS base, ({_CRC} % {HEADS})::BIGINT AS h FROM c
), r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.t, 1, h.h), []), list_slice(h.t, h.h + 1, len(h.t))) AS t FROM h LEFT JOIN c AS b ON b.conv_id = h.base
), p AS (
  SELECT conv_id, len(t) AS n, d, list_slice(t, 1, d) AS node, CASE WHEN d > 0 THEN list_slice(t, 1, d - 1) END AS parent, CASE WHEN d = 0 THEN 0 ELSE length(t[d].x) END AS points
  FROM r, unnest(range(0, len(t) + 1)) AS u(d)
), n AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM p GROUP BY node, d
), k AS (
  SELECT n.*, coalesce(q.n_children, 0) AS n_children, (n_convs - 1) * points AS own
  FROM n LEFT JOIN (SELECT parent, count(*) AS n_children FROM n WHERE d > 0 GROUP BY parent) AS q ON q.parent = n.node
), s AS (
  SELECT list_slice(k.node, 1, u.a) AS node, u.a AS d, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM k, unnest(range(0, k.d + 1)) AS u(a) GROUP BY 1, 2
)
SELECT k.conv_id::BIGINT AS conv_id, k.d::BIGINT AS depth, o.conv_id::BIGINT AS parent_conv_id, k.n_convs::BIGINT AS n_convs, k.n_children::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN s ON s.node = k.node AND s.d = k.d LEFT JOIN n AS o ON o.node = k.parent AND o.d = k.d - 1
"""
