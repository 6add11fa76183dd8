"""Shards of near-equal bytes by a k-d tree over the metadata of documents.

Documents are points in a few metadata dimensions, each scaled to whole numbers. A
node that owes k shards is cut along its widest dimension where the weights divide as
k//2 to k-k//2; leaves are the shards. All nodes of a level are cut together by
counting weights in bins and refining the bin that holds the cut, so no task or driver
sees the points of a node. Ties are ordered by a hash of the id; the cut falls between
two documents also where all metadata agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, ranked, table, written

#: Bits of a scaled coordinate and of the hash that orders ties.
SCALE_BITS = 20
TIE_BITS = 40
#: Bits settled by one counting pass; a pass returns 2**BIN_BITS sums per node.
BIN_BITS = 10

DIMENSIONS = ("_d_size", "_d_lang", "_d_source")


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the scaled dimensions of every document.

    Size is the UTF-8 length plus 16, dimensions are its logarithm and the hash places
    of language and source (null has a place of its own).
    """
    top = (1 << SCALE_BITS) - 1
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + 16).cast("long")

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(c), F.col(c)), F.lit(top + 1))

    scaled = F.least(F.lit(top), F.floor(F.log2(size) * (top / 40.0))).cast("long")
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        scaled.alias("_d_size"),
        place("lang").alias("_d_lang"),
        place("source").alias("_d_source"),
        F.pmod(F.xxhash64(F.lit("tie"), "doc_id", F.crc32(text)), F.lit(1 << TIE_BITS)).alias("_tie"),
    )


def _key(dimension: str) -> Column:
    """Coordinate and tie as one number: a total order of the points but for equal ties."""
    return F.col(dimension) * F.lit(1 << TIE_BITS) + F.col("_tie")


class Tree:
    """The cuts so far. A node's number is its first shard, ``owed`` its shards."""

    def __init__(self, shards: int):
        self.owed = {0: shards}
        self.root: dict = {"node": 0}
        self.leaves = {0: self.root}

    def cut(self, node: int, dimension: str, at: int) -> None:
        k = self.owed[node]
        leaf = self.leaves[node]
        left, right = {"node": node}, {"node": node + k // 2}
        leaf.update(dimension=dimension, at=at, left=left, right=right)
        self.owed |= {node: k // 2, node + k // 2: k - k // 2}
        self.leaves |= {node: left, node + k // 2: right}

    def column(self, leaf) -> Column:
        """``leaf(node)`` of the node that a row falls into; one test per level."""

        def below(part: dict) -> Column:
            if "at" not in part:
                return leaf(part["node"])
            return F.when(
                _key(part["dimension"]) >= F.lit(part["at"]), below(part["right"])
            ).otherwise(below(part["left"]))

        return below(self.root)


def _widest(rows: DataFrame, tree: Tree, dimensions: tuple[str, ...]) -> dict[int, str]:
    """The dimension with the largest range of each node to be cut; the first on ties."""
    ranges = (
        rows.select(tree.column(lambda n: F.lit(n)).alias("_node"), *dimensions)
        .groupBy("_node")
        .agg(*[(F.max(d) - F.min(d)).alias(d) for d in dimensions])
    )
    return {
        r["_node"]: max(dimensions, key=lambda d: r[d])
        for r in ranges.collect()
        if tree.owed[r["_node"]] > 1
    }


def _cuts(rows: DataFrame, tree: Tree, widest: dict[int, str], weight: str) -> dict[int, int]:
    """Per node the first key of its right half.

    Each pass settles ``BIN_BITS`` more bits of the keys; what reaches the driver is a
    sum per bin, at most 2**BIN_BITS of them per node.
    """
    fixed = dict.fromkeys(widest, 0)
    below = dict.fromkeys(widest, 0)
    totals: dict[int, int] = {}
    left = SCALE_BITS + TIE_BITS
    while left > 0:
        step = min(BIN_BITS, left)
        left -= step

        def leaf(n: int) -> Column:
            if n not in widest:
                return F.lit(None).cast("struct<node:int,bin:bigint>")
            key = _key(widest[n])
            inside = F.shiftright(key, left + step) == F.lit(fixed[n])
            return F.when(
                inside, F.struct(F.lit(n).alias("node"), F.shiftright(key, left).alias("bin"))
            )

        sums = (
            rows.select(tree.column(leaf).alias("_p"), F.col(weight).alias("_weight"))
            .where(F.col("_p").isNotNull())
            .groupBy("_p")
            .agg(F.sum("_weight").alias("_sum"))
            .collect()
        )
        bins: dict[int, list[tuple[int, int]]] = {}
        for r in sums:
            bins.setdefault(r["_p"]["node"], []).append((r["_p"]["bin"], r["_sum"]))
        for n in widest:
            found = sorted(bins.get(n, []))
            totals.setdefault(n, sum(total for _, total in found))
            k = tree.owed[n]
            goal = totals[n] * (k // 2) / k
            chosen = fixed[n] << step
            for value, total in found:
                chosen = value
                if below[n] + total > goal:
                    break
                below[n] += total
            fixed[n] = chosen
    return fixed


def kd_shards(
    rows: DataFrame,
    shards: int,
    dimensions: tuple[str, ...] = DIMENSIONS,
    weight: str = "size",
) -> DataFrame:
    """Add ``shard``, 0 to shards-1, to rows with the scaled ``dimensions`` and ``_tie``.

    The weights of two shards differ by about one row's weight per level of the tree.
    Rows that agree in a dimension and the tie stay together. An empty table gives an
    empty result; with fewer rows than shards some shards are empty.
    """
    tree = Tree(shards)
    # Nodes without rows are not seen and stay uncut.
    while widest := _widest(rows, tree, dimensions):
        for n, at in _cuts(rows, tree, widest, weight).items():
            tree.cut(n, widest[n], at)
    return rows.withColumn("shard", tree.column(lambda n: F.lit(n)))


def shard_count(total: int, target_bytes: int) -> int:
    """Leaves so that each has about the target bytes."""
    return max(1, -(-total // target_bytes))


def shard_documents(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 without gaps) per document.

    Give the number of shards or the bytes each should reach. Null texts have size 16;
    null ids, languages and sources are values like others.
    """
    rows = written(points(docs), "shard-points")
    if shards is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
        shards = shard_count(total, target_bytes or 128 << 20)
    placed = written(
        kd_shards(rows, shards).select("doc_id", "size", "text_crc32", "shard"), "shards"
    )
    return ranked(placed, ["shard"], "doc_id", "slot")


@query("op5_kd_tree_shards")
def kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    placed = shard_documents(table(spark, folder, "documents"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
