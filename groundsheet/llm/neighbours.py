"""Near-duplicate embeddings by graph search within blocks and comparison across them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.components import components
from groundsheet.llm.flat_graph import near_pairs
from groundsheet.operators.lineage import materialize

#: Vectors that one block of a region holds, give or take chance; a task compares two blocks at most.
REGION_ROWS = 20_000
#: Vectors of one block that are held against the other block at a time.
ROWS_AT_ONCE = 256
#: Pairs that are verified at a time.
PAIRS_AT_ONCE = 1 << 18
#: Directions equal to so many digits are copies of each other.
DIGITS = 12


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once per row, not once per element of the lambda around it."""
    return F.transform(F.array(value), use)[0]


def _direction(v: Column) -> Column:
    """Unit vector in whole steps of 10^-DIGITS; null for vectors that link with nothing."""
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))

    def unit(scaled: Column) -> Column:
        norm = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x))
        return _bound(norm, lambda n: F.transform(scaled, lambda x: F.floor(x / n * 10.0**DIGITS + 0.5)))

    scaled = _bound(largest, lambda m: F.transform(v, lambda x: x / m))
    return F.when(fine & (largest > 0), _bound(scaled, unit))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows with the pairs (a, b) of blocks they meet in; ``block`` is the row's own.

    A region of up to REGION_ROWS is one block and one pair.  A larger one is dealt by a hash over
    blocks of about that size, and a row goes to every pair of blocks with its own in it, so any two
    rows of a region meet: two of one block in the pair (a, a), two of different blocks in (a, b).
    """
    sizes = placed.groupBy("region").agg(F.count("*").alias("n"))
    big = materialize(sizes.where(F.col("n") > REGION_ROWS), "big-regions")
    zero = F.lit(0)
    if big.isEmpty():
        return placed.withColumns({"block": zero, "a": zero, "b": zero})
    blocks = F.coalesce(F.ceil(F.col("n") / REGION_ROWS), F.lit(1)).cast("int")
    joined = placed.join(big, "region", "left").withColumn("blocks", blocks)
    joined = joined.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    met = joined.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    met = met.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    return met.select(*placed.columns, "block", "a", "b")


def link_vectors(vectors: DataFrame, threshold: float) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Two vectors of one label (and one length) link when their cosine, in double precision, is
    ``threshold`` or more.  ``n_links`` counts the other rows linked directly, ``component_id`` is
    the smallest vec_id reachable, ``kept`` says that this is the row's own.

    Rows of one direction are one node with a count, however many they are.  Labels over REGION_ROWS
    are dealt over blocks of about that size.  The vectors of one block are linked in one task through
    a graph, those of two blocks in another by comparing all pairs, so no two vectors of a label are
    left unmet.  Only counts and one edge per vector leave a task.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows with a null
    label or vec_id, link with nothing: no links, their own component.  An id that repeats with
    different vectors is one node of the components and has the links of all of them.  An empty
    table gives no rows.  Other columns are not read.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = rows.withColumn("way", F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull(), _direction(F.col("v"))))
    # 128 bits of a direction's hash name it.
    named = F.when(F.col("way").isNotNull(), F.concat(*[F.hex(F.xxhash64(F.lit(k), "way")) for k in (1, 2)]))
    rows = materialize(rows.select("vec_id", "label", named.alias("key"), F.when(named.isNotNull(), F.col("v")).alias("v")), "vectors")
    classes = materialize(
        rows.where("key is not null").groupBy("label", "key").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("v").alias("v")
        ),
        "directions",
    )
    placed = classes.select("rep", "key", "v", "copies", F.concat_ws("/", F.size("v"), F.col("label")).alias("region"))

    def link(table: pa.Table) -> pa.Table:
        return _link_region(table, threshold)

    found = materialize(
        _dealt(placed).select("region", "a", "b", "block", "rep", "v", "copies").groupBy("region", "a", "b").applyInArrow(
            link, "rep long, links long, root long"
        ),
        "region-links",
    )
    links = materialize(found.groupBy("rep").agg(F.sum("links").alias("links")), "links")
    roots = components(found, "rep", "root").withColumnRenamed("node", "rep")
    named = materialize(links.join(roots, "rep", "left").select("rep", "links", F.coalesce("root", "rep").alias("root")), "named")
    of_class = materialize(classes.join(named, "rep").select("label", "key", "copies", "links", "root"), "class-links")
    joined = rows.select("vec_id", "label", "key").join(of_class, ["label", "key"], "left")
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _pairs_across(x: np.ndarray, block: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of two blocks that may be within ``threshold``, in both orders."""
    sides = [np.flatnonzero(block == k) for k in np.unique(block)]
    if len(sides) < 2:  # the other block happens to be empty; its own rows meet in the pair (a, a)
        return
    other = np.ascontiguousarray(x[sides[1]].T)
    for low in range(0, len(sides[0]), ROWS_AT_ONCE):
        who = sides[0][low : low + ROWS_AT_ONCE]
        row, col = np.nonzero(x[who] @ other >= threshold - 1e-9)
        a, b = who[row], sides[1][col]
        yield np.concatenate([a, b]), np.concatenate([b, a])


def _link_region(table: pa.Table, threshold: float) -> pa.Table:
    """Links and the smallest linked id of every vector, from the pairs within one block or across two."""
    table = table.combine_chunks()
    n = table.num_rows
    ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = _unit(flat.reshape(n, -1))
    block = table.column("block").to_numpy()
    across = table.column("a")[0].as_py() != table.column("b")[0].as_py()
    links, parent = np.zeros(n, np.int64), np.arange(n)

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in _pairs_across(x, block, threshold) if across else near_pairs(x, ids, threshold):
        for low in range(0, len(a), PAIRS_AT_ONCE):
            some_a, some_b = a[low : low + PAIRS_AT_ONCE], b[low : low + PAIRS_AT_ONCE]
            verified = (some_a != some_b) & (np.einsum("pd,pd->p", x[some_a], x[some_b]) >= threshold)
            some_a, some_b = some_a[verified], some_b[verified]
            if not len(some_a):
                continue
            links += np.bincount(some_a, weights=copies[some_b], minlength=n).astype(np.int64)
            tops = np.array([top(k) for k in range(n)])
            differ = tops[some_a] != tops[some_b]
            for i, j in np.unique(np.stack([tops[some_a[differ]], tops[some_b[differ]]], 1), axis=0):
                i, j = top(int(i)), top(int(j))
                if i != j:
                    parent[max(i, j)] = min(i, j)
    group = np.array([top(k) for k in range(n)], np.int64)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids)
    return pa.table({"rep": pa.array(ids, pa.int64()), "links": pa.array(links), "root": pa.array(least[group])})
