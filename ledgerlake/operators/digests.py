"""V1, V7: tables compared by trees of digests.

Rows fall into 2^bits ranges of their key's hash.  A range's digest is its number of rows and the sum of their
hashes, so the digest of any group of ranges is the sum of theirs: a table's digests are one aggregate that
combines before the shuffle, and all higher levels come from the 2^bits rows it leaves.  Two tables are compared
from the root down, level by level, only below nodes that differ.  Rows of ranges that are equal are neither
shuffled nor compared; digests may be stored and compared without the other table at hand.

Two contents of a range pass for equal if their counts and 64-bit sums are: about one in 2^64 a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.checks import table_diff
from ledgerlake.sources.io import stage_table

#: 2^BITS ranges a table, at most 2^16: the ranges that differ are broadcast (eight bytes each).
BITS, MOST_BITS = 12, 16
#: Levels of the tree are so many bits apart.
FANOUT_BITS = 4
NODE = "_node"


def node_of(keys: Sequence[str], bits: int) -> Column:
    """A row's range: the first bits of its key's hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits) if bits else F.lit(0).cast("long")


def digests(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """(node, rows, digest) of the ranges that have rows, stored.  Columns go into the hash in the order of their names."""
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"a tree has at most {MOST_BITS} bits")
    rows = df.select(node_of(keys, bits).alias(NODE), F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)").alias("_h"))
    return stage_table(_sums(rows.select(NODE, F.lit(1).cast("long").alias("rows"), F.col("_h").alias("digest"))), "digests")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(NODE).agg(F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest"))


def differing(a: DataFrame, b: DataFrame, bits: int = BITS, fanout: int = FANOUT_BITS) -> tuple[DataFrame, int]:
    """The ranges in which two tables' digests differ, and the number of nodes compared on the way."""
    above, level, open_nodes, compared = 0, 0, None, 0

    def at(tree: DataFrame) -> DataFrame:
        """The tree's nodes of this level, below the nodes of the level above that differ."""
        if open_nodes is not None:
            up = open_nodes.select(F.col(NODE).alias("_up"))
            tree = tree.withColumn("_up", F.shiftright(NODE, bits - above)).join(up, "_up", "left_semi").drop("_up")
        return _sums(tree.withColumn(NODE, F.shiftright(NODE, bits - level)))

    while True:
        x, y = at(a), at(b).select(NODE, F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
        same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
        both = stage_table(x.join(y, NODE, "full").select(NODE, (~same).alias("differs")), "nodes")
        compared += both.count()
        open_nodes = both.where("differs").select(NODE)
        if level == bits or open_nodes.isEmpty():
            return open_nodes, compared
        above, level = level, min(bits, level + fanout)


def suspects(df: DataFrame, keys: Sequence[str], nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of some ranges.  At most 2^MOST_BITS nodes, so they are broadcast; the rows aren't shuffled."""
    return df.withColumn(NODE, node_of(keys, bits)).join(F.broadcast(nodes), NODE, "left_semi").drop(NODE)


def tree_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = BITS, digests_a: DataFrame | None = None,
              digests_b: DataFrame | None = None) -> DataFrame:
    """``table_diff`` of the ranges that differ, which is ``table_diff`` of the tables; stored digests may be given."""
    nodes, _ = differing(digests(a, keys, bits) if digests_a is None else digests_a, digests(b, keys, bits) if digests_b is None else digests_b, bits)
    return table_diff(suspects(a, keys, nodes, bits), suspects(b, keys, nodes, bits))
