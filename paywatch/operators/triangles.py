"""Triangles per node of an undirected simple graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.operators.graph import both_directions
from paywatch.operators.skew import join_lookup
from paywatch.session import Scratch, shuffles_freed


#: Out-neighbours in one chunk of a node's list.
CHUNK = 1024

#: Longs in the signature of a chunk, of 64 bits each.
WORDS = 4

#: Bits of the ids of `monotonically_increasing_id` that count inside a partition.
ID_BITS = 33


def _all_pairs(edges: DataFrame) -> DataFrame:
    """Distinct undirected pairs, self loops too; the pair of an end that is missing has the other one first."""
    known = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return edges.select(
        F.least("src", "dst").alias("node_a"),  # the one that is known, if one is
        F.when(known, F.greatest("src", "dst")).alias("node_b"),
    ).distinct()


def _ranked(pairs: DataFrame) -> DataFrame:
    """Every node with an id that rises with its number of neighbours."""
    degree = both_directions(pairs).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return degree.orderBy("degree", "node").select("node", F.monotonically_increasing_id().alias("id"))


def _numbered(ranked: DataFrame) -> DataFrame:
    """The nodes numbered from 0 in the order of their ids; numbers are shorter than names and ids in what follows."""
    part = F.shiftright("id", ID_BITS)
    sizes = sorted(ranked.groupBy(part.alias("part")).count().collect())  # one row per partition
    before, shifts = 0, []
    for at, size in sizes:
        shifts.append((at, before - (at << ID_BITS)))
        before += size
    shift = ranked.sparkSession.createDataFrame(shifts, "part long, shift long")
    kind = "int" if before < 1 << 31 else "long"
    placed = ranked.withColumn("part", part).join(F.broadcast(shift), "part")
    return placed.select("node", (F.col("id") + F.col("shift")).cast(kind).alias("number"))


def _oriented(pairs: DataFrame, numbered: DataFrame, rows: int) -> DataFrame:
    """Each pair directed from the node with fewer neighbours to the one with more (ties by name)."""

    def side(name: str) -> DataFrame:
        return numbered.select(F.col("node").alias(name), F.col("number").alias(f"number_{name}"))

    known = join_lookup(
        join_lookup(pairs, side("node_a"), ["node_a"], total_rows=rows),
        side("node_b"),
        ["node_b"],
        total_rows=rows,
        count_from=pairs,
    )
    return known.select(
        F.least("number_node_a", "number_node_b").alias("low"), F.greatest("number_node_a", "number_node_b").alias("high")
    )


def _chunk_of(target: str | Column, chunks: Column) -> Column:
    """Chunk of a target in a list of `chunks` (a power of two) chunks: the last bits of its hash."""
    return F.xxhash64(target).bitwiseAND((chunks - 1).cast("long")).cast("int")


def _bit(target: str | Column) -> tuple[Column, Column]:
    """Word and bit of a target in a signature, by other bits of its hash than the chunk's."""
    number = F.shiftrightunsigned(F.xxhash64(target), 34).cast("int")
    return F.pmod(F.shiftright(number, 6), F.lit(WORDS)), F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63))


def _signature(target: str) -> Column:
    """The bits of all targets of a group, in `WORDS` longs."""
    word, bit = _bit(target)
    return F.array(*[F.bit_or(F.when(word == n, bit).otherwise(F.lit(0).cast("long"))) for n in range(WORDS)])


def _may_hold(signature: str, target: Column) -> Column:
    """Whether a signature has the bit of a target: surely so if the target is in its group."""
    word, bit = _bit(target)
    return F.get(signature, word).bitwiseAND(bit) != 0


def _sized(arcs: DataFrame, rows: int) -> DataFrame:
    """Arcs with the number of out-neighbours of both ends and the chunks those are cut into."""
    out = arcs.groupBy("low").agg(F.count(F.lit(1)).alias("size"))
    of_low = out.select("low", F.col("size").alias("low_size"))
    of_high = out.select(F.col("low").alias("high"), F.col("size").alias("high_size"))
    sized = join_lookup(join_lookup(arcs, of_low, ["low"], total_rows=rows), of_high, ["high"], total_rows=rows, count_from=arcs)

    def chunks(size: str) -> Column:
        needed = F.ceil(F.log2(F.col(size) / F.lit(float(CHUNK))))
        return F.pow(F.lit(2.0), F.greatest(needed, F.lit(0))).cast("int")

    return sized.withColumns({"low_chunks": chunks("low_size"), "high_chunks": chunks("high_size")})


def _closing(arcs: DataFrame, rows: int) -> DataFrame:
    """low, high and the third corners of the triangles of every arc, `rows` arcs at most carrying chunks."""
    # third corners are targets of both ends: an end without targets, or a low end with this one only, has none
    open_arcs = arcs.where((F.col("low_size") > 1) & F.col("high_size").isNotNull())
    lists = (
        arcs.select("low", _chunk_of("high", F.col("low_chunks")).alias("chunk"), "high")
        .groupBy("low", "chunk")
        .agg(F.collect_list("high").alias("targets"), _signature("high").alias("signature"))
    )
    # the finer of the two cuts: a chunk of the one end meets the only chunk of the other that can share targets with it
    parts = open_arcs.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest("low_chunks", "high_chunks") - 1)))
    asked = parts.select(
        "low",
        "high",
        F.col("part").bitwiseAND(F.col("low_chunks") - 1).alias("chunk"),
        F.col("part").bitwiseAND(F.col("high_chunks") - 1).alias("high_chunk"),
    )
    theirs = lists.select(F.col("low").alias("high"), F.col("chunk").alias("high_chunk"), F.col("targets").alias("high_targets"))
    # narrow rows go to the hubs, where a hub's rows are spread, and take the signature of the low end's chunk along;
    # back to (low, chunk) go only the targets that it may hold
    signed = asked.join(lists.select("low", "chunk", "signature"), ["low", "chunk"])
    met = join_lookup(signed, theirs, ["high", "high_chunk"], total_rows=rows, count_from=asked)
    likely = F.filter("high_targets", lambda t: _may_hold("signature", t))
    reached = met.select("low", "high", "chunk", likely.alias("high_targets")).where(F.size("high_targets") > 0)
    return (
        reached.join(lists.select("low", "chunk", "targets"), ["low", "chunk"])
        .select("low", "high", F.array_intersect("targets", "high_targets").alias("third"))
        .where(F.size("third") > 0)
    )


def triangles(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Number of triangles each node is a corner of.

    Directed towards the higher degree, no node has more than sqrt(2 * pairs) out-neighbours, hubs included. They
    are kept in chunks of about `CHUNK`, cut by hash, so that each directed pair intersects the chunks of its two
    ends that can share targets, one by one; pairs of neighbours are never listed, and no row carries a whole list.
    The many pairs that lead to a hub are split over tasks. Of a chunk only what a signature of the other chunk may
    hold is moved; what is moved is intersected exactly.
    """
    scratch = Scratch(edges.sparkSession, "triangles")
    # at any time the disk holds what one step reads, shuffles and writes, and the pairs
    with shuffles_freed(edges.sparkSession):
        every = scratch.write(_all_pairs(edges), "pairs")
        pairs = every.where(F.col("node_a") != F.col("node_b"))
        rows = pairs.count()
        numbered = scratch.write(_numbered(scratch.write(_ranked(pairs), "ranked")), "numbered")
        scratch.discard("ranked")
        oriented = scratch.write(_oriented(pairs, numbered, rows), "oriented")
        if nodes is None:
            rest = every.where(~F.coalesce(F.col("node_a") != F.col("node_b"), F.lit(False)))
            alone = scratch.write(rest.select(F.explode(F.array("node_a", "node_b")).alias("node_id")).distinct(), "alone")
        scratch.discard("pairs")
        arcs = scratch.write(_sized(oriented, rows), "arcs")
        scratch.discard("oriented")
        closed = _closing(arcs, rows)
        corner = F.explode(
            F.concat(
                F.array(
                    F.struct(F.col("low").alias("number"), F.size("third").cast("long").alias("n")),
                    F.struct(F.col("high").alias("number"), F.size("third").cast("long").alias("n")),
                ),
                F.transform("third", lambda t: F.struct(t.alias("number"), F.lit(1).cast("long").alias("n"))),
            )
        )
        counts = scratch.write(
            closed.select(corner.alias("c")).groupBy("c.number").agg(F.sum("c.n").alias("triangle_count")), "counts"
        )
        scratch.discard("arcs")
    named = numbered.join(counts, "number", "left").select(F.col("node").alias("node_id"), "triangle_count")
    if nodes is None:  # those of pairs, and what has a self loop or a missing end only
        nodes = numbered.select(F.col("node").alias("node_id")).unionByName(
            alone.join(numbered, F.col("node_id") == F.col("node"), "left_anti")
        )
    return (
        nodes.select("node_id")
        .join(named, "node_id", "left")
        .select("node_id", F.coalesce("triangle_count", F.lit(0)).alias("triangle_count"))
    )


def no_triangles(nodes: DataFrame) -> DataFrame:
    """Triangles of a graph whose edges all run between two kinds of nodes: always none."""
    return nodes.select("node_id", F.lit(0).cast("long").alias("triangle_count"))
