"""Near-duplicate embeddings by collision-counting projections.

Unit vectors are projected on many random lines.  Two vectors at the cosine
threshold lie so close that they fall into each other's window on nearly every
line; unrelated ones do on few.  Along each sorted line the windows centred on
one vector after the other are runs of neighbours; the collisions are counted
per pair, and a pair whose count passes is verified by its exact cosine.  The
count that a pair must reach is calibrated: a pair at the threshold itself
misses it with a chance of ``MISS`` at most.

Only vectors of one label are compared.  Counting windows inside a label costs
the square of its rows, so a label with more than ``CELL_ROWS`` rows is first
dealt into cells by the sides of further random planes on which its vectors lie.
Every plane halves the cells, and as many tables of planes are drawn as keep the
chance of missing a pair at the threshold under ``MISS``; a pair that meets in
several tables counts in the first one.  A label of any size takes this one path;
small ones need no plane and one table.  A cell with too many rows (copies) is
split into blocks, and each pair of blocks is a task's work of its own.  What
leaves a task is a count per vector and a spanning forest, not pairs.

Defined cases: vectors or labels that are null, zero vectors, and vectors with
null or non-finite components link with nothing; vectors of different length are
not compared; rows that share a vec_id are one vector (the smallest by label and
embedding stands for it), a null vec_id is never linked and has a null
component_id; an empty table gives an empty result.  Other columns are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import broadcast_if_small, components, hash_key, ship
from judgeline.session import cut_lineage

ship(__name__)

THRESHOLD = 0.98
LINES = 32                # one-dimensional projections
WINDOW = 1.5              # half width, in deviations of a pair at the threshold
MISS = 1e-9               # chance of missing a pair at the threshold
CELL_ROWS = 16_384        # expected rows of a cell
BLOCK_ROWS = 1024         # rows of a block of a cell
PAIRS_AT_ONCE = 2_000_000
SEED = 20_240_501


def required_count(lines: int = LINES, window: float = WINDOW, miss: float = MISS) -> int:
    """Largest count that a pair at the threshold fails to reach with a chance
    below ``miss``: the lower tail of a binomial."""
    p = math.erf(window / math.sqrt(2))
    tail, count = 0.0, 0
    while count < lines:
        tail += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if tail > miss:
            return count
        count += 1
    return lines


def plan(rows: int, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, miss: float = MISS) -> tuple[int, int]:
    """(planes of a table, tables) for a label with so many rows."""
    planes = min(60, max(0, math.ceil(math.log2(max(1, rows) / cell_rows))))
    meet = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, 1 if planes == 0 else math.ceil(math.log(miss) / math.log(1 - meet))


def _directions(n: int, dim: int, seed: int) -> np.ndarray:
    found = np.random.default_rng([seed, dim]).standard_normal((n, dim))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _codes(unit: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """Cell of each vector in each table (rows x tables, int64)."""
    out = np.zeros((len(unit), tables), np.int64)
    if planes:
        bits = 1 << np.arange(planes, dtype=np.int64)
        for t in range(tables):
            out[:, t] = ((unit @ _directions(planes, unit.shape[1], SEED + 1 + t).T) > 0) @ bits
    return out


def _collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """Number of lines on which b's value lies in the window centred on a's
    (rows of a x rows of b); a and b are values by row and line."""
    counts = np.zeros(len(a) * len(b), np.uint8)
    rows = np.arange(len(a), dtype=np.int64) * len(b)
    for line in range(a.shape[1]):
        order = np.argsort(b[:, line], kind="stable")
        values = b[order, line]
        low = np.searchsorted(values, a[:, line] - half, "left")
        runs = np.searchsorted(values, a[:, line] + half, "right") - low
        shift = np.repeat(low - np.concatenate(([0], np.cumsum(runs)[:-1])), runs)
        counts[np.repeat(rows, runs) + order[np.arange(len(shift)) + shift]] += 1
    return counts.reshape(len(a), len(b))


def links(vectors_a: np.ndarray, vectors_b: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the pairs whose collisions pass and whose cosine,
    in double precision, reaches the threshold."""
    norm_a, norm_b = np.linalg.norm(vectors_a, axis=1), np.linalg.norm(vectors_b, axis=1)
    dim = vectors_a.shape[1]
    lines = _directions(LINES, dim, SEED)
    on_a, on_b = (vectors_a / norm_a[:, None]) @ lines.T, (vectors_b / norm_b[:, None]) @ lines.T
    # a pair at the threshold differs by sqrt(2 - 2 threshold), 1/sqrt(dim) of it along a line
    half = WINDOW * math.sqrt(max(0.0, 2 - 2 * threshold) / dim) if dim > 2 else 3.0
    need, found = required_count(), [(np.zeros(0, int), np.zeros(0, int))]
    step = max(1, PAIRS_AT_ONCE // max(1, len(vectors_b)))
    for at in range(0, len(vectors_a), step):
        i, j = np.nonzero(_collisions(on_a[at:at + step], on_b, half) >= need)
        i += at
        for k in range(0, len(i), 50_000):
            p, q = i[k:k + 50_000], j[k:k + 50_000]
            cosine = np.einsum("nd,nd->n", vectors_a[p], vectors_b[q]) / (norm_a[p] * norm_b[q])
            good = cosine >= threshold
            found.append((p[good], q[good]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Of n places linked by (i, j): the smallest place each one is connected with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            return root


def _matched(own: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one pair of blocks: n_links and root by vec_id.  ``side`` is 0 for
    rows of the first block, 1 for the second; a block with itself has 0 only."""
    own = own.sort_values("vec_id", kind="stable").reset_index(drop=True)
    side = own["side"].to_numpy()
    vectors = np.stack(own["embedding"].to_numpy()).astype(float)
    codes = np.stack(own["codes"].to_numpy())
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1) if own["i"].iloc[0] != own["j"].iloc[0] else first
    a, b = links(vectors[first], vectors[second], threshold) if len(first) and len(second) else ([], [])
    a, b = first[a], second[b]
    if second is first:
        a, b = a[a < b], b[a < b]
    t = int(own["table"].iloc[0])
    fresh = ~(codes[a, :t] == codes[b, :t]).any(axis=1)     # not met in an earlier table
    a, b = a[fresh], b[fresh]
    counts = np.bincount(np.concatenate((a, b)), minlength=len(own))
    ids = own["vec_id"].to_numpy()
    linked = counts > 0
    return pd.DataFrame({"vec_id": ids[linked], "links": counts[linked].astype(np.int64),
                         "root": ids[_forest(a, b, len(own))][linked]})


def find_links(vectors: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, links, root) by pair of blocks; ``vectors`` has vec_id (not null,
    each once), label and embedding (usable)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    vectors = vectors.withColumn("dim", F.size("embedding"))
    labels = vectors.groupBy("label", "dim").count()
    vectors = vectors.join(broadcast_if_small(cut_lineage(labels)), ["label", "dim"])

    def dealt(batches):
        for frame in batches:
            for (_, dim, rows), own in frame.groupby(["label", "dim", "count"], sort=False):
                planes, tables = plan(rows, threshold, cell_rows)
                unit = np.stack(own["embedding"].to_numpy()).astype(float)
                codes = _codes(unit, planes, tables)
                for t in range(tables):
                    yield own[["label", "dim", "vec_id", "embedding"]].assign(
                        table=t, cell=codes[:, t], codes=list(codes))

    schema = f"label {vectors.schema['label'].dataType.simpleString()}, dim int, vec_id {kind}, " \
             "embedding array<double>, table int, cell long, codes array<long>"
    cells = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")).mapInPandas(dealt, schema)
    keys = ["label", "dim", "table", "cell"]
    sizes = cells.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    cells = cells.join(broadcast_if_small(cut_lineage(sizes)), keys)
    own = F.pmod(hash_key(F.col("vec_id"), "block"), F.col("blocks")).cast("int")
    cells = cells.withColumn("own", own)
    pair = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"))))
    cells = cells.withColumn("pair", pair).select(
        *keys, F.col("pair.i").alias("i"), F.col("pair.j").alias("j"),
        F.when(F.col("own") == F.col("pair.i"), 0).otherwise(1).alias("side"), "vec_id", "embedding", "codes")
    return cells.groupBy(*keys, "i", "j").applyInPandas(
        lambda frame: _matched(frame, threshold), f"vec_id {kind}, links long, root {kind}")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``embeddings``."""
    rows = embeddings.select(embeddings["vec_id"].alias("vec_id"), embeddings["label"].alias("label"),
                             embeddings["embedding"].alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where("vec_id is not null and label is not null and embedding is not null") \
        .where(finite & F.exists("embedding", lambda x: x != 0))
    usable = usable.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")) \
        .select("vec_id", "v.label", "v.embedding")
    found = cut_lineage(find_links(cut_lineage(usable), threshold, cell_rows, block_rows))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    roots = components(found, "vec_id", "root").withColumnRenamed("id", "vec_id")
    return rows.select("vec_id").join(counts, "vec_id", "left").join(roots, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        (F.coalesce("root", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept"))
