"""A trie of the prefixes that conversations share, by ROLLUP over columns of turns.

A conversation's turns are digests, laid out in blocks of ``WIDTH`` columns. One
ROLLUP over the columns of all blocks makes every prefix a group, with its
number of members, its least member and the longest member; ``grouping_id``
says how deep a group is. A block is keyed by the node that the blocks before
it end at. That node's key is known beforehand: the exclusive-or of the hashes
of the turns on the way to it, each hashed with its position, twice 64 bits.
So long conversations need no round for each block.

What is summed over subtrees comes from a second ROLLUP. A node is written down
at its least member, and of a member's nodes the ones that it is least of are a
stretch from some depth to its end. So each conversation carries one sum, the
members of a node add up to its subtree, and only the part of its own least
member's stretch that lies above it is taken off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import common

#: Turn columns in one ROLLUP.
WIDTH = 8
#: Rows of one key that a window orders at once; longer ones are added up stretch by stretch.
STRETCH = 1024
_TURNS = [f"t{j}" for j in range(WIDTH)]
_NODE = ["depth", "a", "b"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, n_turns): the turns of each conversation numbered from 0 in the order of ``turn``.

    Null turn numbers come first; turns of one number are ordered by their
    digests. ``turn_id`` is the digest of role and text (null: empty) and, in
    its last four bytes, the text's code points. Rows without conv_id belong
    to no conversation and are left out. Numbers are counted by ranges of the
    sorted rows and the ranges' counts added up, so that one conversation may
    hold any share of the rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.concat(digest, F.unhex(F.lpad(F.hex(F.char_length(text).cast("long")), 8, "0"))).alias("turn_id"),
        F.monotonically_increasing_id().alias("_n"),  # only splits turns that are alike in all else
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "turn_id", "_n"]
    rows = common.stored(rows, "turns").repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "_n")
    rows = common.numbered(rows, "sorted").withColumn("_part", F.shiftright("_row", 33))
    each = Window.partitionBy("conv_id").orderBy("_part")
    parts = (
        rows.groupBy("conv_id", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(each.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n_turns", F.sum("_n").over(Window.partitionBy("conv_id")))
    )
    local = F.row_number().over(Window.partitionBy("conv_id", "_part").orderBy("_row")) - 1
    return rows.withColumn("_local", local).join(parts.drop("_n"), ["conv_id", "_part"]).select(
        "conv_id", (F.col("_before") + F.col("_local")).alias("pos"), "turn_id", "n_turns"
    )


def rebuilt(numbered: DataFrame, most: int = 6, group: int = 100) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of the first conversation of its group.

    h is crc32(c) modulo ``most``; the first of c's group is c less c modulo
    ``group`` (never negative). If it is shorter, all its turns are taken; if
    absent, none. Returns (conv_id, pos, turn_id, n_turns); a conversation
    without turns has one row with null pos and turn_id. At most ``group``
    conversations read the same ``most - 1`` turns.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    convs = numbered.filter("pos = 0").select("conv_id", "n_turns", h.alias("h"), first.alias("first_id"))
    lengths = numbered.filter("pos = 0").select(F.col("conv_id").alias("first_id"), F.col("n_turns").alias("n_first"))
    taken = F.least("h", F.coalesce("n_first", F.lit(0)))
    convs = convs.join(lengths, "first_id", "left").select(
        "conv_id", "h", "first_id", taken.alias("taken"), (F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)) + taken).alias("length")
    )
    heads = numbered.filter(F.col("pos") < most - 1).select(F.col("conv_id").alias("first_id"), "pos", "turn_id")
    heads = convs.join(heads, "first_id").filter("pos < h").select("conv_id", "pos", "turn_id", F.col("length").alias("n_turns"))
    own = numbered.filter(F.col("pos") >= h).drop("n_turns").join(convs, "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id", F.col("length").alias("n_turns"))
    none = convs.filter("length = 0").select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("n_turns"))
    return own.unionByName(heads).unionByName(none)


def _hash(seed: int, pos: Column, turn_id: Column) -> Column:
    return F.when(turn_id.isNotNull(), F.xxhash64(F.lit(seed), pos.cast("long"), turn_id)).otherwise(F.lit(0).cast("long"))


def _xor(first: Column, *others: Column) -> Column:
    for c in others:
        first = first.bitwiseXOR(c)
    return first


def _before(df: DataFrame, key: str, at: str, total, out: dict[str, str], joined) -> DataFrame:
    """``out``'s new columns: ``total`` of an old one over the rows of ``key`` that come before by ``at``.

    ``STRETCH`` values of ``at`` are ordered at once, then one row for each
    stretch; ``joined`` puts the two together. Nothing before: 0.
    """
    df = df.withColumn("_stretch", F.floor(F.col(at) / STRETCH))
    near = Window.partitionBy(key, "_stretch").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = df.groupBy(key, "_stretch").agg(*[total(F.col(c)).alias(f"_{n}") for n, c in out.items()])
    sums = sums.select(key, "_stretch", *[F.coalesce(total(F.col(f"_{n}")).over(far), zero).alias(f"_far_{n}") for n in out])
    df = df.select("*", *[F.coalesce(total(F.col(c)).over(near), zero).alias(f"_near_{n}") for n, c in out.items()])
    df = df.join(sums, [key, "_stretch"])
    for n in out:
        df = df.withColumn(n, joined(F.col(f"_near_{n}"), F.col(f"_far_{n}"))).drop(f"_near_{n}", f"_far_{n}")
    return df.drop("_stretch")


def _blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, block, a, b, t0 .., n_turns): a and b are the key of the node that the earlier blocks end at."""
    pos = F.coalesce("pos", F.lit(0))
    rows = rows.withColumn("block", F.floor(pos / WIDTH)).withColumn("_j", pos % WIDTH)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.max("n_turns").alias("n_turns"),
        *[F.bit_xor(_hash(s, F.col("pos"), F.col("turn_id"))).alias(f"_x{s}") for s in (1, 2)],
        *[F.max(F.when(F.col("_j") == j, F.col("turn_id"))).alias(t) for j, t in enumerate(_TURNS)],
    )
    return _before(blocks, "conv_id", "block", F.bit_xor, {"a": "_x1", "b": "_x2"}, _xor)


def _rolled(blocks: DataFrame, **sums: str) -> DataFrame:
    """One row for each node: depth, its key a and b, its parent's key pa and pb, its last text's code points, and ``sums``."""
    columns = ", ".join(_TURNS)
    made = ", ".join(f"{v} AS {k}" for k, v in sums.items())
    grouped = blocks.sparkSession.sql(
        f"SELECT block, a, b, {columns}, {WIDTH} - bit_count(grouping_id()) AS _level, {made} "
        f"FROM {{blocks}} GROUP BY block, a, b, ROLLUP({columns})",
        blocks=blocks,
    )
    last = F.get(F.array(*_TURNS), F.col("_level") - 1)
    # a conversation that ends within the block has no turn at the deeper levels, and the first level of a later block is the node before
    grouped = grouped.withColumn("_last", last).filter("_last IS NOT NULL OR (_level = 0 AND block = 0)")
    depth = F.col("block") * WIDTH + F.col("_level")
    keys = {
        k: _xor(F.col(k), *[_hash(s, F.col("block") * WIDTH + j, F.when(F.col("_level") > j, F.col(t))) for j, t in enumerate(_TURNS)])
        for s, k in ((1, "a"), (2, "b"))
    }
    chars = F.coalesce(F.conv(F.hex(F.substring("_last", 17, 4)), 16, 10).cast("long"), F.lit(0))
    made = grouped.select(
        depth.cast("long").alias("depth"), keys["a"].alias("a"), keys["b"].alias("b"), "_last", chars.alias("chars"), *sums
    )
    up = [F.col(k).bitwiseXOR(_hash(s, F.col("depth") - 1, F.col("_last"))).alias(f"p{k}") for s, k in ((1, "a"), (2, "b"))]
    return made.select("*", *up).drop("_last")


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of the nodes' lists of ids to digests; a piece is all that is held of a list."""
    at, digest = None, None
    out: list[tuple] = []

    def told() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == len(_NODE) else pa.int64()) for i, c in enumerate(columns)], names=[*_NODE, "ends_sha256"])
        out.clear()
        return batch

    for batch in batches:
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
            if node == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((*at, digest.hexdigest()))
            at, digest = node, hashlib.sha256(ids.encode())
        if out:
            yield told()
    if at is not None:
        out.append((*at, digest.hexdigest()))
        yield told()


def _ends(blocks: DataFrame) -> DataFrame:
    """For each node that conversations end at: the digest of their ids, ascending.

    A list is joined from pieces of 65,536 consecutive possible ids. SHA-256
    has to read a list in order: one task streams the pieces of one node, and
    holds one piece.
    """
    last = blocks.filter(F.col("n_turns") <= (F.col("block") + 1) * WIDTH)
    keys = [
        _xor(F.col(k), *[_hash(s, F.col("block") * WIDTH + j, F.col(t)) for j, t in enumerate(_TURNS)]).alias(k) for s, k in ((1, "a"), (2, "b"))
    ]
    ends = last.select(F.col("n_turns").alias("depth"), *keys, "conv_id", F.shiftright("conv_id", 16).alias("piece"))
    pieces = ends.groupBy(*_NODE, "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")
    return pieces.select(*_NODE, "ids").mapInArrow(_sha256, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The trie of conversations given as (conv_id, pos, turn_id, n_turns), one row for each turn.

    One row for each distinct sequence of first d turns, from the root (d = 0,
    all conversations, also those without turns): conv_id (its least member),
    depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves
    (childless nodes of its subtree, itself included), saved_tokens (over its
    subtree, (n_convs - 1) times the code points of a node's last text) and
    ends_sha256 (of the comma-joined ids of the conversations that end here).
    No conversations: no rows, not even a root.

    Groups are made by partial aggregates, so that a prefix which a third of
    all conversations share is one row of each task. A parent with very many
    children meets them in one join on narrow rows, whose skewed partitions
    Spark splits.
    """
    blocks = common.stored(_blocks(rows), "blocks")
    nodes = common.stored(
        _rolled(blocks, s_conv="min(conv_id)", s_n="count(1)", s_longest="max(n_turns)").withColumn(
            "worth", (F.col("s_n") - 1) * F.col("chars")
        ),
        "nodes",
    )
    least = nodes.groupBy("s_conv").agg(
        F.sum("worth").alias("worth"),
        F.max((F.col("s_longest") == F.col("depth")).cast("long")).alias("leaf"),
        F.min_by(F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")), "depth").alias("over"),
    )
    below = blocks.join(least.select(F.col("s_conv").alias("conv_id"), "worth", "leaf"), "conv_id")
    below = _rolled(below, s_worth="sum(worth)", s_leaves="sum(leaf)").select(*_NODE, "s_worth", "s_leaves")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    # a node whose least member is not its parent's is the top of that member's stretch: one such row a member
    tops = least.select(F.col("s_conv").alias("_conv"), "over.*").join(nodes.select(*_NODE, F.col("s_conv").alias("_over")), _NODE)
    tops = tops.select(F.col("_conv").alias("s_conv"), (F.col("depth") + 1).alias("depth"), "_over")
    own = _before(nodes, "s_conv", "depth", F.sum, {"above": "worth"}, lambda near, far: near + far)
    return (
        own.join(tops, ["s_conv", "depth"], "left")
        .join(below, _NODE)
        .join(children, _NODE, "left")
        .join(_ends(blocks), _NODE, "left")
        .select(
            F.col("s_conv").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("_over", "s_conv")).alias("parent_conv_id"),
            F.col("s_n").alias("n_convs"),
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.col("s_leaves").alias("n_leaves"),
            (F.col("s_worth") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the conversations as ``rebuilt`` makes them share their beginnings.

    Null roles and texts are empty; rows without conv_id take no part;
    repeated rows are turns of their own; texts are used whole; an empty table
    gives no rows. Only conv_id, turn, role and text are read, so other
    columns' names cannot clash.
    """
    return prefix_trie(rebuilt(common.stored(turns(conversations), "numbered")))


#: The same in DuckDB's SQL, by lists of turns.
ORACLE = """
WITH numbered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), CAST(range(8) AS BIGINT[])),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
  FROM (SELECT DISTINCT c FROM numbered)
), turn AS (
  SELECT v.c, n.pos AS place, n.role, n.text FROM conv v JOIN numbered n ON n.c = v.base AND n.pos < v.h
  UNION ALL
  SELECT v.c, n.pos + 10 AS place, n.role, n.text FROM conv v JOIN numbered n ON n.c = v.c AND n.pos >= v.h
), path AS (
  SELECT v.c, coalesce(p.keys, []) AS keys, coalesce(p.sizes, []) AS sizes FROM conv v LEFT JOIN (
    SELECT c, list(md5(len(role) || ':' || role || text) ORDER BY place) AS keys, list(len(text) ORDER BY place) AS sizes FROM turn GROUP BY c
  ) p ON p.c = v.c
), prefix AS (
  SELECT c, d, array_to_string(keys[1:d], ',') AS key, array_to_string(keys[1:d - 1], ',') AS above, len(keys) = d AS ends,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT c, keys, sizes, unnest(range(0, len(keys) + 1)) AS d FROM path)
), node AS (
  SELECT d, key, any_value(above) AS above, min(c) AS m, count(*) AS n, (count(*) - 1) * any_value(size) AS worth,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefix GROUP BY d, key
), child AS (SELECT d - 1 AS d, above AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
), subtree AS (
  SELECT p.d, p.key, sum(u.worth) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM node u LEFT JOIN child k ON k.d = u.d AND k.key = u.key JOIN prefix p ON p.c = u.m AND p.d <= u.d GROUP BY ALL
)
SELECT v.m AS conv_id, CAST(v.d AS BIGINT) AS depth, o.m AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM node v JOIN subtree s ON s.d = v.d AND s.key = v.key
LEFT JOIN child k ON k.d = v.d AND k.key = v.key
LEFT JOIN node o ON o.d = v.d - 1 AND v.d > 0 AND o.key = v.above
"""
