"""Near-duplicate embeddings by Euclidean p-stable hashing.

Normalised vectors are projected on random directions; a projection, shifted and cut into steps of
one width, is one hash value, and a table's bucket is the combination of several of them. Vectors
that share a bucket in some table are candidates and confirmed by their exact cosine. How many
values make a bucket follows from the number of vectors, and how many tables from the chance to
miss a link at the threshold.

Equal vectors are one node. Each bucket's best connected node is compared with the others first,
which joins most of a group of copies; only buckets that still hold several components are compared
further, and only members outside the bucket's largest component with all the others. Links within
a component are counted without listing them: the members inside a ball of half the threshold's
angle around the component's centre are all linked with each other, so only the rest is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.graph import stars
from reviewloom.llm.text import stored

THRESHOLD = 0.95
WIDTH = 2.0  # of a step; vectors of unit length lie within 2 of each other
STRAY = 0.25  # unlike vectors that share a bucket with one, on average in each table
MISS = 1e-4  # chance that no table brings a pair at the threshold together
BLOCK = 1024  # rows that a task compares with as many others
SLACK = 1e-9  # angles and cosines this near a bound are settled exactly


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one hash value of two vectors at this distance is the same."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Hash values of a bucket and number of tables for ``n`` vectors."""
    far = agreement(math.sqrt(2))  # at a right angle
    near = agreement(math.sqrt(2 - 2 * threshold)) if threshold < 1 else 1.0
    values = max(1, math.ceil(math.log(max(n, 2) / STRAY) / -math.log(far)))
    hit = near**values
    return values, 1 if hit >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-hit)))


def scaled(values: np.ndarray) -> np.ndarray | None:
    """The vector times a power of two that keeps squares in range; None for one without a
    direction: zero, or with a component that is null or not finite."""
    if not len(values) or not np.isfinite(values).all() or not values.any():
        return None
    return np.ldexp(values, -np.frexp(np.abs(values).max())[1])


def unpacked(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of every row of ``x`` with every row of ``y``."""
    lengths = np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((y * y).sum(axis=1))
    return (x @ y.T) / lengths


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))


def alike(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` are linked with which of ``y``. Where the product of matrices comes close
    to the threshold the sum is taken again, so that a pair's verdict depends on the pair alone."""
    found = cosines(x, y)
    for i, j in zip(*np.nonzero(np.abs(found - threshold) < SLACK), strict=True):
        found[i, j] = exact_cosine(x[i], y[j])
    return found >= threshold


def row_cosines(xs: pd.Series, ys: pd.Series) -> np.ndarray:
    """Cosine of each packed vector with its neighbour; -1 where that is null or has no length."""
    found = np.full(len(xs), -1.0)
    sizes = np.array([len(x) for x in xs])
    given = ys.notna().to_numpy()
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero((sizes == size) & given)
        if len(at):
            x, y = unpacked(xs.iloc[at].tolist()), unpacked(ys.iloc[at].tolist())
            lengths = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
            np.divide((x * y).sum(axis=1), lengths, out=lengths, where=lengths > 0)
            found[at] = np.where(lengths == 0, -1.0, lengths)
    return found


def vector_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``node`` (digest, null without direction) and ``vec``, the scaled components."""
    schema = pa.schema([("vec_id", pa.int64()), ("node", pa.binary()), ("vec", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, packed = [], []
            for item in batch.column(1):
                value = None
                if item.is_valid:
                    value = scaled(item.values.cast(pa.float64()).to_numpy(zero_copy_only=False))
                raw = None if value is None else (value + 0.0).astype("<f8").tobytes()
                packed.append(raw)
                nodes.append(None if raw is None else xxhash.xxh3_128_digest(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(packed, pa.binary())],
                schema=schema)

    return vectors.select("vec_id", "embedding").mapInArrow(
        pack, "vec_id long, node binary, vec binary")


def bucket_members(nodes: DataFrame, values: int, tables: int, width: float) -> DataFrame:
    """``n`` and ``bucket`` for every node and table."""
    schema = pa.schema([("n", pa.int64()), ("buckets", pa.list_(pa.int64()))])

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            n, packed = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list = [None] * len(n)
            sizes = np.array([len(p) for p in packed])
            for size in np.unique(sizes).tolist():  # vectors of other lengths never meet
                if size not in drawn:
                    random = np.random.default_rng([20_240_301, size])
                    drawn[size] = (random.standard_normal((size // 8, values * tables)),
                                   random.uniform(0, width, values * tables))
                lines, shift = drawn[size]
                at = np.flatnonzero(sizes == size)
                x = unpacked([packed[k] for k in at])
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                steps = np.floor((x @ lines + shift) / width).astype("<i4")
                for k, row in zip(at.tolist(), steps.reshape(len(at), tables, values), strict=True):
                    out[k] = [xxhash.xxh64_intdigest(r.tobytes(), (size << 16) + t) - (1 << 63)
                              for t, r in enumerate(row)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.int64()))], schema=schema)

    found = nodes.select("n", "vec").mapInArrow(hash_all, "n long, buckets array<long>")
    return found.select("n", F.explode("buckets").alias("bucket"))


def linked_pairs(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes that are linked. Pairs of one ``a`` are dealt to blocks by
    ``b``, and ``a`` meets each block by a copy of its own, so a frequent ``a`` fills no task."""

    @F.pandas_udf("boolean")
    def verdict(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in series:
            found = row_cosines(x, y)
            for k in np.flatnonzero(np.abs(found - threshold) < SLACK).tolist():
                found[k] = exact_cosine(np.frombuffer(x.iloc[k], "<f8"),
                                        np.frombuffer(y.iloc[k], "<f8"))
            yield pd.Series(found >= threshold)

    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_k"))
    dealt = pairs.join(sizes, "a").withColumn("_s", F.pmod(F.xxhash64("b"), "_k").cast("int"))
    left = sizes.join(nodes.select(F.col("n").alias("a"), F.col("vec").alias("_x")), "a").select(
        "a", "_x", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_s"))
    right = nodes.select(F.col("n").alias("b"), F.col("vec").alias("_y"))
    return dealt.drop("_k").join(right, "b").join(left, ["a", "_s"]).filter(
        verdict("_x", "_y")).select("a", "b")


def _components(nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """``nodes`` with ``comp``, the smallest node number of their component."""
    return nodes.join(comps.select(F.col("b").alias("n"), F.col("a").alias("_c")), "n", "left"
                      ).withColumn("comp", F.coalesce("_c", "n")).drop("_c")


def _met(rows: DataFrame, key: str, few: str) -> DataFrame:
    """Rows dealt to blocks such that every row with ``few`` meets every row of its ``key`` in some
    task: ``_u`` numbers the blocks of the former, ``_v`` the blocks of all. ``_from`` says which
    side a row is on."""
    blocks = rows.groupBy(key).agg(
        F.ceil(F.count_if(few) / BLOCK).cast("int").alias("_ku"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("_kv")).filter("_ku > 0")
    dealt = rows.join(blocks, key)
    h = F.xxhash64("n")
    ahead = dealt.filter(few).select(
        "*", F.pmod(h, "_ku").cast("int").alias("_u"),
        F.explode(F.sequence(F.lit(0), F.col("_kv") - 1)).alias("_v"), F.lit(True).alias("_from"))
    behind = dealt.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_ku") - 1)).alias("_u"),
        F.pmod(h, "_kv").cast("int").alias("_v"), F.lit(False).alias("_from"))
    return ahead.unionByName(behind).drop("_ku", "_kv")


def _each_group(rows: DataFrame, keys: list[str], use, schema: str) -> DataFrame:
    """``use`` of the rows of every key, as a table, in the tasks that get the key. Groups are many
    and small, so they are taken from sorted rows one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the group that may go on
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            if held and tuple(c[0] for c in columns) != last:
                yield from use(pa.Table.from_batches(held)).to_batches()
                held = []
            for lo, hi in zip(starts[:-2], starts[1:-1], strict=True):
                yield from use(pa.Table.from_batches([*held, batch.slice(lo, hi - lo)])).to_batches()
                held = []
            held.append(batch.slice(starts[-2]))
            last = tuple(c[-1] for c in columns)
        if held:
            yield from use(pa.Table.from_batches(held)).to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def connecting_links(members: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links between different components in a bucket, as many as connect what is connected.

    ``members``: ``bucket``, ``n``, ``comp``. Members outside the largest component of their bucket
    meet all members; inside a task, pairs that a link has already joined are passed over, so it
    gives fewer links than it has rows.
    """
    per_comp = members.groupBy("bucket", "comp").agg(F.count("*").alias("_n"))
    largest = per_comp.groupBy("bucket").agg(
        F.max(F.struct("_n", "comp")).alias("_top"), F.count("*").alias("_c"))
    mixed = largest.filter("_c > 1").select("bucket", F.col("_top.comp").alias("_top"))
    rows = stored(members.join(mixed, "bucket").withColumn("_few", F.col("comp") != F.col("_top")
                                                           ).drop("_top"), "mixed")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        ahead = table["_from"].to_numpy()
        n, comp = (table[c].to_numpy().copy() for c in ("n", "comp"))
        x = unpacked(table["vec"].to_pylist())
        one, other, links = np.flatnonzero(ahead), np.flatnonzero(~ahead), []
        for i, row in zip(one, alike(x[one], x[other], threshold), strict=True):
            for j in other[row]:
                if comp[i] != comp[j]:
                    links.append((min(n[i], n[j]), max(n[i], n[j])))
                    comp[comp == comp[j]] = comp[i]
        a, b = zip(*links, strict=True) if links else ([], [])
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                    schema=schema)

    met = _met(rows, "bucket", "_few").join(nodes.select("n", "vec"), "n").select(
        "bucket", "_u", "_v", "_from", "n", "comp", "vec")
    return _each_group(met, ["bucket", "_u", "_v"], compare, "a long, b long")


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """``n`` and ``links``, the weight of the nodes linked with each node, for ``members`` (``n``,
    ``comp``, ``weight``, ``vec``) of components of two nodes or more.

    The ball's centre is the mean direction of one block of members, chosen by hash: it decides
    what is compared, never what counts as a link.
    """
    sizes = members.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).alias("_k"))
    sample = members.join(sizes, "comp").filter(F.pmod(F.xxhash64("n", F.lit(1)), "_k") == 0)

    def centre(table: pa.Table) -> pa.Table:
        x = unpacked(table["vec"].to_pylist())
        mean = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).sum(axis=0)
        return pa.table({"comp": table["comp"][:1], "_c": pa.array([mean.tobytes()], pa.binary())})

    reach = math.acos(min(1.0, threshold)) / 2 - SLACK

    @F.pandas_udf("boolean")
    def inside(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, c in series:
            yield pd.Series(np.arccos(np.minimum(row_cosines(x, c), 1.0)) <= reach)

    centres = _each_group(sample.select("comp", "vec"), ["comp"], centre, "comp long, _c binary")
    blocks = sizes.join(centres, "comp", "left").select(
        "comp", "_c", "_k", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_s"))
    # a centre has a copy for each block of its component
    salted = members.join(sizes, "comp").withColumn("_s", F.pmod(F.xxhash64("n"), "_k").cast("long"))
    marked = stored(salted.drop("_k").join(blocks.drop("_k"), ["comp", "_s"]).select(
        "n", "comp", "weight", "vec", inside("vec", "_c").alias("_in")), "balls")
    weights = marked.filter("_in").groupBy("comp").agg(F.sum("weight").alias("_all"))
    own = marked.filter("_in").join(weights, "comp").select(
        "n", (F.col("_all") - F.col("weight")).alias("links"))
    schema = pa.schema([("n", pa.int64()), ("links", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        ahead = table["_from"].to_numpy()
        n, weight, ball = (table[c].to_numpy() for c in ("n", "weight", "_in"))
        x = unpacked(table["vec"].to_pylist())
        one, other = np.flatnonzero(ahead), np.flatnonzero(~ahead)
        met = alike(x[one], x[other], threshold)
        met &= n[one][:, None] != n[other]
        # rows outside the ball are on both sides: their own counts are taken from theirs
        back = other[ball[other]]
        there = met[:, ball[other]].T
        return pa.Table.from_arrays([
            pa.array(np.r_[n[one], n[back]]),
            pa.array(np.r_[met @ weight[other], there @ weight[one]].astype("int64"))],
            schema=schema)

    rest = _each_group(_met(marked.withColumn("_few", ~F.col("_in")), "comp", "_few").select(
        "comp", "_u", "_v", "_from", "n", "weight", "vec", "_in"), ["comp", "_u", "_v"], count,
        "n long, links long")
    return own.unionAll(rest).groupBy("n").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame, *, threshold: float = THRESHOLD, miss: float = MISS,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two rows are linked if the cosine of their vectors is ``threshold`` or more, in double
    precision, at the chance ``miss`` of not finding a link at the threshold that no third vector
    joins. ``n_links`` counts the rows linked with a row directly, ``component_id`` is the smallest
    id reachable over links, and a row is kept if that is its own id.

    Needs ``vec_id`` (a whole number) and ``embedding`` (an array of numbers); other columns are
    not used. A vector that is null, empty, zero, or has a null or non-finite component is linked
    with nothing and kept; so are vectors of different lengths with each other. Rows that repeat a
    vector are linked with each other, also under one id. A null id is never a component's id
    unless all its ids are null; then its rows are kept. No rows in, no rows out.
    """
    rows = stored(vector_rows(vectors), "vectors")
    nodes = stored(
        rows.filter("node is not null").groupBy("node").agg(
            F.count("*").alias("weight"), F.min("vec_id").alias("vec_id"),
            F.first("vec").alias("vec")).withColumn("n", F.monotonically_increasing_id()), "nodes")
    values, tables = plan_tables(nodes.count(), threshold, miss)

    banded = bucket_members(nodes, values, tables, WIDTH)
    members = stored(banded, "buckets")
    shared = members.groupBy("bucket").agg(F.count("*").alias("_size")).filter("_size > 1")
    members = stored(members.join(shared, "bucket"), "members")
    degrees = members.groupBy("n").agg(F.sum("_size").alias("_degree"))
    centres = members.join(degrees, "n").groupBy("bucket").agg(
        F.min(F.struct(-F.col("_degree"), "n")).alias("_r")).select(
        "bucket", F.col("_r.n").alias("centre"))
    # a group: the nodes that share some bucket with its centre
    groups = members.join(centres, "bucket").select("centre", "n").distinct()
    spokes = groups.filter("n <> centre").select(
        F.least("centre", "n").alias("lo"), F.greatest("centre", "n").alias("hi"), "centre", "n")
    # two centres that share a bucket are one pair
    spokes = spokes.groupBy("lo", "hi").agg(F.min("centre").alias("a")).select(
        "a", F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b"))
    comps = stars(linked_pairs(spokes, nodes, threshold))
    rest = members.filter("_size > 2").select("bucket", "n")
    more = stored(connecting_links(_components(rest, comps), nodes, threshold), "links")
    if not more.isEmpty():
        comps = stars(comps.unionByName(more))

    # links inside components; a node that is alone is linked with its own copies only
    ends = comps.select(F.col("a").alias("n")).unionAll(comps.select("b")).distinct()
    counts = link_counts(_components(nodes.join(ends, "n").select("n", "weight", "vec"), comps),
                         threshold)
    labelled = _components(nodes.drop("vec"), comps)
    smallest = labelled.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    by_node = labelled.join(smallest, "comp").join(counts, "n", "left").select(
        "node", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    lone = F.col("node").isNull()
    return rows.drop("vec").join(by_node, "node", "left").select(
        "vec_id", F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
