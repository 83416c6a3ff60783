"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has a bit where over half of a text's four-word shingles have it
in their XXH64. Fingerprints within ``budget`` bits of each other are linked
and the links contracted to components.

Distinct fingerprints stand in ``budget + 1`` tries, each of which reads the
bits from another block on. Of two close fingerprints at least one block is
equal, so in that trie they lie below one node; a join therefore starts there
with no differing bit and goes down both nodes of a pair together, adding up
the bits in which they differ and dropping the pair once the budget is
exceeded. Nodes whose fingerprints are all in one component already are dropped
too: what is sought is the components, not all pairs.

Small nodes are packed, ``CELL`` fingerprints a task. Nodes with more are taken
apart by Spark joins over pairs of nodes (``wide_links``) until the two nodes
of a pair fit a task, so no group has to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from outletlab.llm.common import text_parts
from outletlab.llm.near_dedup import components
from outletlab.session import cut_lineage

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
BUDGET = 4  # differing bits up to which fingerprints are linked
CELL = 8_192  # fingerprints below a node up to which one task joins it
STEP = 4  # bits by which Spark takes larger nodes apart
LEAF_PAIRS = 64  # pairs of leaves below two nodes up to which they are compared at once
CHUNK = 1 << 18  # pairs of nodes a step of a task goes down with


def fingerprint(text: bytes) -> int:
    """The SimHash of a text as an unsigned number; 0 without words."""
    counts, n = np.zeros(BITS, np.int64), 0
    last: list[bytes] = []  # the words that a shingle may share with the next part
    for part in text_parts(text.lower()):
        words = last + part.split()
        if len(words) >= SHINGLE_WORDS:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes)[: 1 - SHINGLE_WORDS].tolist()
            ends = ends[SHINGLE_WORDS - 1:].tolist()
            digest = xxhash.xxh64_digest
            for lo in range(0, len(starts), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[some], ends[some], strict=True)])
                counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(starts)
        last = words[1 - SHINGLE_WORDS:]
    if not n and last:  # fewer words than a shingle has
        return xxhash.xxh64_intdigest(b" ".join(last), SEED)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(text.as_py() or b"") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=["id", "fp"])


class Labels:
    """Components of a task's fingerprints, as the smallest place in each."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.of[self.of], self.of):
                self.of = up


def _leaf_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all leaves below pairs of nodes (lo, hi, lo2, hi2, ..)."""
    width = pairs[3] - pairs[2]
    count = (pairs[1] - pairs[0]) * width
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = np.repeat(width, count)
    return np.repeat(pairs[0], count) + nth // width, np.repeat(pairs[2], count) + nth % width


def trie_join(values: np.ndarray, start: np.ndarray, depth: int, budget: int, labels: Labels) -> None:
    """Unite the labels of all fingerprints within ``budget`` bits below pairs
    of nodes. ``values`` are sorted and distinct; a node is a range of places
    whose values agree in their first ``depth`` bits, and ``start`` has a pair a
    column: its two ranges (equal, or the second above) and the bits in which
    they differ so far."""
    ones = {}
    stack = [(depth, start[:, lo: lo + CHUNK]) for lo in range(0, start.shape[1], CHUNK)]
    while stack:
        depth, pairs = stack.pop()
        change = np.concatenate([[0], np.cumsum(labels.of[1:] != labels.of[:-1])])
        one = (change[pairs[0]] == change[pairs[1] - 1]) & (change[pairs[2]] == change[pairs[3] - 1]) & (
            labels.of[pairs[0]] == labels.of[pairs[2]])
        pairs = pairs[:, ~one]
        count = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        few = count <= LEAF_PAIRS
        i, j = _leaf_pairs(pairs[:, few])
        new = (i < j) & (labels.of[i] != labels.of[j])
        i, j = i[new], j[new]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        labels.unite(i[near], j[near])
        pairs = pairs[:, ~few]
        if not pairs.shape[1]:
            continue
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        a, b, c, d, apart = pairs
        mid = b - (ones[depth][b] - ones[depth][a])  # where the ones of the next bit begin
        mid2 = d - (ones[depth][d] - ones[depth][c])
        same = (a == c) & (b == d)
        below = np.concatenate([np.stack([a, mid, c, mid2, apart]), np.stack([mid, b, mid2, d, apart]),
                                np.stack([a, mid, mid2, d, apart + 1]),
                                np.stack([c, mid2, mid, b, apart + 1])[:, ~same]], axis=1)
        below = below[:, (below[0] < below[1]) & (below[2] < below[3]) & (below[4] <= budget)]
        low = below[0] > below[2]  # the second range is the one above
        below[:, low] = below[:, low][[2, 3, 0, 1, 4]]
        stack += [(depth + 1, below[:, lo: lo + CHUNK]) for lo in range(0, below.shape[1], CHUNK)]


def _ranges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])


def _joined(table: pa.Table, budget: int, depth: int, across: bool) -> pa.Table:
    """(a, b): the representative of every fingerprint that isn't the first of
    its component with that of the first. Joined are the fingerprints below
    each node of ``depth`` bits, or ``across`` the table's two such nodes."""
    values = table.column("value").to_numpy().view(np.uint64)
    order = np.argsort(values)
    values, reps = values[order], table.column("rep").combine_chunks().take(pa.array(order))
    labels = Labels(len(values))
    if "label" in table.column_names:
        codes = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()[order]
        first = np.full(codes.max() + 1, len(codes))
        np.minimum.at(first, codes, np.arange(len(codes)))
        labels.of = first[codes]
    known = labels.of.copy()
    lo, hi = _ranges(values >> np.uint64(BITS - depth))
    if across:
        apart = np.bitwise_count((values[0] ^ values[-1]) >> np.uint64(BITS - depth))
        start = np.array([[lo[0]], [hi[0]], [lo[-1]], [hi[-1]], [apart]], np.int64)
    else:
        start = np.stack([lo, hi, lo, hi, np.zeros(len(lo), np.int64)])
    trie_join(values, start, depth, budget, labels)
    moved = np.flatnonzero(labels.of != known)
    return pa.table({"a": reps.take(pa.array(moved)), "b": reps.take(pa.array(labels.of[moved]))})


def _joining(budget: int, depth: int, across: bool):
    return lambda table: _joined(table, budget, depth, across)


def _node(depth: int) -> Column:
    return F.shiftrightunsigned("value", BITS - depth)


def _link_schema(rows: DataFrame) -> StructType:
    return StructType([StructField(c, rows.schema["rep"].dataType) for c in ("a", "b")])


def cell_links(rows: DataFrame, budget: int, block: int, cell: int) -> DataFrame:
    """Links among rows (trie, value, rep) below one node of ``block`` bits.

    The counts of the nodes, at most 2 ** block a trie, pack neighbouring ones
    to cells of one to two ``cell`` fingerprints. A larger node is cut by its
    next bits into cells; ``wide_links`` finds what lies between those.
    """
    cells, depth = [], block
    nodes = rows.groupBy("trie", _node(block).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("trie").orderBy("node")) - F.col("n")
    nodes = cut_lineage(nodes.withColumn("place", F.floor(before / cell)), "trie_nodes")
    placed = rows.withColumn("node", _node(block)).join(F.broadcast(nodes), ["trie", "node"])  # at most (budget + 1) * 2 ** block rows
    cells.append(placed.filter(F.col("n") <= cell).select("trie", F.lit(0).alias("depth"), "place", "value", "rep"))
    wide = placed.filter(F.col("n") > cell).select("trie", "value", "rep")
    while depth < BITS and wide.limit(1).count():
        depth += STEP
        wide = cut_lineage(wide, "trie_rows")
        nodes = wide.groupBy("trie", _node(depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        placed = wide.withColumn("node", _node(depth)).join(nodes, ["trie", "node"])
        cells.append(placed.filter(F.col("n") <= cell).select("trie", F.lit(depth).alias("depth"), F.col("node").alias("place"), "value", "rep"))
        wide = placed.filter(F.col("n") > cell).select("trie", "value", "rep")
    every = cells[0]
    for more in cells[1:]:
        every = every.unionByName(more)
    return every.groupBy("trie", "depth", "place").applyInArrow(_joining(budget, block, False), _link_schema(rows))


def wide_links(rows: DataFrame, budget: int, block: int, cell: int) -> DataFrame | None:
    """Links between the cells of one node of over ``cell`` fingerprints; None
    if there is no such node. ``rows`` are (trie, value, rep, label).

    Pairs of nodes go down together, ``STEP`` bits a round. A pair is dropped
    when its bits differ too much or both nodes are wholly in one component, and
    joined in a task as soon as each node has at most ``cell`` fingerprints.
    """
    nodes = rows.groupBy("trie", _node(block).alias("a")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
    pairs = cut_lineage(nodes.select("trie", "a", F.col("a").alias("b"), F.lit(0).alias("apart")), "trie_pairs")
    rows = cut_lineage(rows.withColumn("a", _node(block)).join(pairs.select("trie", "a"), ["trie", "a"], "left_semi").drop("a"), "trie_rows")
    found, depth = [], block
    while depth < BITS and pairs.limit(1).count():
        depth += STEP
        below = cut_lineage(rows.groupBy("trie", _node(depth).alias("node")).agg(
            F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .withColumn("up", F.shiftrightunsigned("node", STEP)), "trie_nodes")
        side = lambda up, end: below.select("trie", F.col("up").alias(up), *[F.col(c).alias(c + end) for c in ("node", "n", "lo", "hi")])
        down = (pairs.join(side("a", "1"), ["trie", "a"]).join(side("b", "2"), ["trie", "b"])
                .withColumn("apart", F.col("apart") + F.bit_count(F.col("node1").bitwiseXOR(F.col("node2")).bitwiseAND(F.lit((1 << STEP) - 1))))
                .filter((F.col("node1") <= F.col("node2")) & (F.col("apart") <= budget)
                        & ~((F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2")))))
        down = cut_lineage(down.select("trie", F.col("node1").alias("a"), F.col("node2").alias("b"), "apart",
                                       (F.greatest("n1", "n2") <= cell).alias("fits")), "trie_pairs")
        ready = down.filter(F.col("fits") & (F.col("a") < F.col("b"))).select("trie", "a", "b")
        here = rows.withColumn("node", _node(depth))
        sides = ready.withColumn("node", F.explode(F.array("a", "b"))).join(here, ["trie", "node"])
        joined = sides.select("trie", "a", "b", "value", "rep", "label").groupBy("trie", "a", "b").applyInArrow(
            _joining(budget, depth, True), _link_schema(rows))
        found.append(cut_lineage(joined, "trie_links"))
        pairs = down.filter(~F.col("fits")).drop("fits")
    links = None
    for more in found:
        links = more if links is None else links.unionByName(more)
    return links


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET,
                       cell: int = CELL) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``: the SimHash as a
    signed 64-bit number and the smallest id reachable over links.

    A null or blank text has fingerprint 0 and is linked like any other.
    Rows with a null id get a fingerprint, but link nothing (component_id
    null). Rows repeating an id with several texts link their fingerprints. An
    empty table gives no rows; other columns are not read.
    """
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("fp", LongType())])
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    prints = cut_lineage(source.mapInArrow(_fingerprint_batches, schema), "fingerprints")
    distinct = cut_lineage(prints.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")), "distinct_prints")
    block = BITS // (budget + 1)
    turned = [F.col("fp") if not k else F.shiftleft("fp", k * block).bitwiseOR(F.shiftrightunsigned("fp", BITS - k * block))
              for k in range(budget + 1)]
    rows = cut_lineage(distinct.select("rep", F.posexplode(F.array(*turned)).alias("trie", "value")), "trie_rows")
    # an id with several texts: its fingerprints belong together
    again = (prints.join(distinct, "fp").groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("c"))
             .filter("c > 1"))
    same_id = prints.join(distinct, "fp").join(again.filter("lo <> hi").select("id", "lo"), "id").select(F.col("rep").alias("a"), F.col("lo").alias("b"))
    roots = cut_lineage(components(cut_lineage(cell_links(rows, budget, block, cell).unionByName(same_id), "trie_links")), "roots")
    labelled = rows.join(roots, F.col("rep") == F.col("node"), "left").select("trie", "value", "rep", F.coalesce("root", "rep").alias("label"))
    more = wide_links(labelled, budget, block, cell)
    if more is not None:
        own = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = cut_lineage(components(more.unionByName(own)), "roots")
    known = distinct.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return prints.join(known, "fp", "left").select(F.col("id").alias(id_col), "fp",
                                                   F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
