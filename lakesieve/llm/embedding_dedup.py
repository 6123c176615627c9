"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with a cosine of c or more are at a squared distance of 2 - 2c at
most. After a rotation that spreads what the vectors hold over all coordinates,
they are split into blocks of a few dimensions; a pair within the budget is, in
one block at least, within that block's share of it (its dimensions over all).
Each block is range-joined under its share: its first coordinates are cut into
cells as wide as the share's root, and a vector visits the neighbouring cells on
one side. What is near in some block is verified by its whole cosine; a pair is
told by the first block that finds it, so the union has each pair once.

Equal vectors of a label are one node with a count. Cells over `most` rows are
dealt in parts that meet pair by pair.

Defined results
---------------
null, empty or zero vector, null or non-finite component, null label
                     linked with nothing
vectors of different lengths
                     never linked
null id              linked with nothing, null component, kept
repeated rows        one output row per input row; each counts as a vector
equal ids            one node of the graph: links and components of all its vectors
empty table          empty result
other columns        ignored
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import cut, ship
from lakesieve.llm.graph import UnionFind, components

BLOCK_DIMS = 8
SLACK = 1e-9
ROWS = 256


@lru_cache(4)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    m = max(1, dims // BLOCK_DIMS)
    cuts = [dims * i // m for i in range(m + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def unit_vectors(data: list[bytes], kind: str) -> np.ndarray:
    """Rows of length 1, in double precision."""
    v = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def cells(rotated: np.ndarray, a: int, b: int, budget: float, grid: int) -> np.ndarray:
    """Cell numbers of a block's first coordinates."""
    g = min(grid, b - a)
    return np.floor(rotated[:, a : a + g] / np.sqrt(budget * (b - a) / rotated.shape[1] + SLACK)).astype(np.int64)


def neighbours(g: int) -> list[tuple[int, ...]]:
    """The cell itself and those on one side of it."""
    steps = [()]
    for _ in range(g):
        steps = [(*s, d) for s in steps for d in (-1, 0, 1)]
    return [s for s in steps if s >= (0,) * g]


def _visits(rows: DataFrame, kind: str, budget: float, grid: int) -> DataFrame:
    """(unit, block, home, id, n, vector): each vector in its own and in its neighbouring cells, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.array([len(x) for x in b.column("vector").to_pylist()])
            for d in np.unique(dims).tolist():
                some = b.filter(pa.array(dims == d))
                data, label = some.column("vector").to_pylist(), some.column("label").to_pylist()
                v = unit_vectors(data, kind) @ rotation(d // np.dtype(kind).itemsize)
                for k, (lo, hi) in enumerate(blocks(v.shape[1])):
                    c = cells(v, lo, hi, budget, grid)
                    for step in neighbours(c.shape[1]):
                        at = c + np.array(step, np.int64)
                        names = [f"{x}|{d}|{k}|" + ",".join(map(str, y)) for x, y in zip(label, at.tolist(), strict=True)]
                        yield pa.RecordBatch.from_pydict({"unit": pa.array(names), "block": pa.array(np.full(len(data), k, np.int32)), "home": pa.array(np.full(len(data), not any(step))), "id": some.column("id"), "n": some.column("n"), "vector": some.column("vector")})

    return rows.mapInArrow(run, "unit string, block int, home boolean, id long, n long, vector binary")


def pairs_of(v: np.ndarray, home: np.ndarray, part: np.ndarray, block: int, budget: float, least: float, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a unit that this block is the first to find, verified: homes with homes and with visitors.

    lo, hi: the parts that meet here; equal for a part with itself.
    """
    r = v @ rotation(v.shape[1])
    spans = blocks(v.shape[1])
    share = [budget * (b - a) / v.shape[1] + SLACK for a, b in spans]
    a, b = spans[block]
    x = r[:, a:b]
    key = x[:, 1] if b - a > 1 else x[:, 0]
    order = np.argsort(key, kind="stable")
    width = np.sqrt(share[block])
    square = (x * x).sum(1)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    homes = order[home[order]]
    sorted_key = key[order]
    for s in range(0, len(homes), ROWS):
        i = homes[s : s + ROWS]
        near = order[np.searchsorted(sorted_key, key[i[0]] - width) : np.searchsorted(sorted_key, key[i[-1]] + width, side="right")]
        ok = square[i][:, None] + square[near][None, :] - 2 * (x[i] @ x[near].T) <= share[block] + SLACK
        # two homes once; a home and a visitor once; and only what these two parts have with each other
        ok &= ~(home[near][None, :] & (rank[near][None, :] <= rank[i][:, None]))
        if lo != hi:
            ok &= part[i][:, None] != part[near][None, :]
        p, q = np.nonzero(ok)
        p, q = i[p], near[q]
        if len(p):
            good = np.einsum("ij,ij->i", v[p], v[q]) >= least
            p, q = p[good], q[good]
            gap = (r[p] - r[q]) ** 2
            # the block that tells a pair is the first one within its share, by the same sum as above
            first = np.ones(len(p), bool)
            for k in range(block):
                c, d = spans[k]
                first &= gap[:, c:d].sum(1) > share[k]
            yield p[first], q[first]


def _unit(kind: str, budget: float, least: float):
    def run(table: pa.Table) -> pa.Table:
        rows = {c: np.array(table.column(c).to_pylist()) for c in ("home", "part", "id", "n")}
        v = unit_vectors(table.column("vector").to_pylist(), kind)
        block, lo, hi = (table.column(c)[0].as_py() for c in ("block", "lo", "hi"))
        count = np.zeros(len(v), np.int64)
        sets, edges = UnionFind(), []
        for p, q in pairs_of(v, rows["home"], rows["part"], block, budget, least, lo, hi):
            np.add.at(count, p, rows["n"][q])
            np.add.at(count, q, rows["n"][p])
            edges += [(a, b) for a, b in zip(rows["id"][p].tolist(), rows["id"][q].tolist(), strict=True) if sets.union(a, b)]
        at = np.flatnonzero(count)
        a = np.concatenate([rows["id"][at], [x for x, _ in edges]]).astype(np.int64)
        b = np.concatenate([np.zeros(len(at), np.int64), [y for _, y in edges]]).astype(np.int64)
        links = np.concatenate([count[at], np.zeros(len(edges), np.int64)])
        is_edge = np.arange(len(a)) >= len(at)
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=~is_edge), "links": pa.array(links, mask=is_edge)})

    return run


def near_vectors(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", most: int = 4096) -> DataFrame:
    """id, n_links, component, kept of every vector: vectors of one label with a cosine of `least` or more are linked."""
    spark = vectors.sparkSession
    ship(spark)
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "<f8" if element == "double" else "<f4"
    v = F.col("vector")
    sound = v.isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size(v) > 0)
    sound = sound & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{'double' if kind == '<f8' else 'float'}>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    base = base.withColumn("sound", F.coalesce(sound, F.lit(False)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [np.array(x, kind).tobytes() if ok else None for x, ok in zip(b.column("vector").to_pylist(), b.column("sound").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "label": b.column("label"), "vector": pa.array(data, pa.binary())})

    base = cut(base.mapInArrow(pack, "id long, label string, vector binary"), "vectors")
    good = base.where("vector is not null")
    nodes = cut(good.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("n")), "nodes")
    budget = 2 - 2 * least
    per_label = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    # more cells a dimension at a time, as labels grow: what is near in a cell stays about as much
    grid = 1
    while per_label > 25_000 * 6 ** (grid - 1) and grid < 4:
        grid += 1
    visits = _visits(nodes.select("id", "label", "n", "vector"), kind, budget, grid)
    full = cut(visits.groupBy("unit").count().where(F.col("count") > most).select(F.col("unit").alias("_unit"), F.ceil(F.col("count") / most).alias("k")), "full")
    dealt = visits.join(full, F.col("unit") == F.col("_unit"), "left").withColumn("k", F.coalesce("k", F.lit(1)).cast("int")).drop("_unit")
    dealt = dealt.withColumn("part", F.expr("cast(pmod(xxhash64(id, home), k) as int)"))
    dealt = dealt.withColumn("meet", F.explode(F.expr("transform(sequence(0, k - 1), j -> named_struct('lo', least(part, j), 'hi', greatest(part, j)))")))
    dealt = dealt.select("unit", "block", "home", "id", "n", "vector", "part", F.col("meet.lo").alias("lo"), F.col("meet.hi").alias("hi"))
    found = cut(dealt.groupBy("unit", "lo", "hi").applyInArrow(_unit(kind, budget, least), "a long, b long, links long"), "links")
    links = cut(found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links")), "counts")
    done = cut(components(found.where("b is not null").select("a", "b")), "components")
    own = good.join(nodes.select("label", "vector", F.col("id").alias("rep"), "n"), ["label", "vector"]).select("id", "rep", "n")
    own = own.join(links.withColumnRenamed("id", "rep"), "rep", "left").join(done.withColumnRenamed("node", "rep"), "rep", "left")
    out = own.select("id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    alone = base.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return out.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))

