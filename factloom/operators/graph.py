"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.session import discard, written

#: edges that a task gathers before it reduces them to a forest
GATHERED = 1 << 20


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A root for each of n nodes, the same for all that the edges a[i], b[i] connect."""
    root = np.arange(n)
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (further := root[root])).any():
            root = further


def forest_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges without nulls (two columns of one type, many rows) so many that the same nodes are connected: each node hangs on one of its component."""
    kept, names, rows = [], None, 0

    def reduced() -> pa.Table:
        t = pa.concat_tables(kept)
        ends = [t.column(i).combine_chunks() for i in (0, 1)]
        nodes = pc.unique(pa.chunked_array(ends))
        a, b = (pc.index_in(x, nodes).to_numpy(zero_copy_only=False) for x in ends)
        root = _roots(len(nodes), a, b)
        (hung,) = np.nonzero(root != np.arange(len(nodes)))
        return pa.table([nodes.take(pa.array(root[hung])), nodes.take(pa.array(hung))], names=names)

    limit = GATHERED
    for batch in batches:
        names = batch.schema.names
        kept.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= limit:
            kept = [reduced()]
            rows = kept[0].num_rows
            limit = max(GATHERED, 2 * rows)
    if kept:
        yield from reduced().to_batches(max_chunksize=1 << 16)


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60, hint: str | None = None) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round hangs every node on its least neighbour, doubles these pointers until they end at roots (a chain of n nodes
    takes log n steps), and contracts the edges by them: every tree has at least two nodes, so the graph shrinks by half or
    more, and components that are done have no edge left and take no part in later rounds. The maps, ever smaller, are
    joined one after the other in the end. Rounds are written to the shared
    folder and the edges of a round are deleted once they are contracted; if edges are left after ``max_rounds``, that
    is an error, never a truncated answer. Edges with a null end are ignored.
    ``hint``: a join hint; with "merge" no table of nodes passes through the driver, whatever its size on disk is.
    """
    e = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src is not null and dst is not null and src <> dst")
    e = written(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    total = None
    hinted = lambda d: d.hint(hint) if hint else d
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        to = written(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("to")), "hooks")
        for _ in range(max_rounds):
            further = to.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped = written(to.join(hinted(further), "to").select("node", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")), "hooks")
            discard(to)
            to = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        total = to if total is None else _composed(total, to, hinted)
        ends = to.select(F.col("node").alias("src"), F.col("to").alias("s")), to.select(F.col("node").alias("dst"), F.col("to").alias("d"))
        rest = e.join(hinted(ends[0]), "src").join(hinted(ends[1]), "dst").filter("s <> d").select(F.greatest("s", "d").alias("src"), F.least("s", "d").alias("dst")).distinct()
        old, e = e, written(rest, "edges")
        discard(old)
        if e.isEmpty():
            return total.withColumnRenamed("to", "component")
    raise RuntimeError(f"edges are left after {max_rounds} rounds")


def _composed(first: DataFrame, then: DataFrame, hinted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``then`` after ``first``; nodes that ``then`` lacks stay where they are."""
    then = then.select(F.col("node").alias("to"), F.col("to").alias("further"))
    return first.join(hinted(then), "to", "left").select("node", F.coalesce("further", "to").alias("to"))
