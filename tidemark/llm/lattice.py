"""Near-duplicate vectors by E8 lattice hashing: projections, neighbouring cells, exact cosine."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import memory
from tidemark.llm.components import components
from tidemark.llm.frames import join_groups, settle

#: Tables of the index. Together their projections are one random rotation to TABLES x 8 dims.
TABLES = 8
#: Cells that a vector looks into beside its own, per table, and the width of a cell for unit
#: vectors whose projections have variance 1. With these, pairs of cosine 0.95 are found with
#: probability 0.95, pairs of 0.97 with 0.9995.
PROBES = 4
WIDTH = 0.8
SEED = 13
#: Pairs in a cell are first told apart by the signs of 64 projections. At cosine 0.95, 6.5 of
#: them differ on average, with a deviation of 2.4; of unrelated vectors 32.
SKETCH_BITS = 18
#: Vectors at home in a cell that one task holds at a time; more are dealt out in blocks.
BLOCK = 4096
#: Groups up to this size are compared side by side, larger ones each by matrices.
SMALL = 16
#: Pairs that a matrix comparison holds at once.
AT_ONCE = 1 << 21


def _minimal() -> np.ndarray:
    """The 240 shortest vectors of E8: what leads from a cell to its neighbours."""
    pairs = [
        [s if k == i else t if k == j else 0.0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for s in (1.0, -1.0)
        for t in (1.0, -1.0)
    ]
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + [list(s) for s in halves])


MINIMAL = _minimal()


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points whose components sum to an even number."""
    near = np.rint(y)
    off = y - near
    rows = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[rows]).argmax(axis=1)
    near[rows, worst] += np.where(off[rows, worst] < 0, -1.0, 1.0)
    return near


def nearest_point(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row: of the even integer points and those a half off."""
    a, b = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@functools.cache
def _projections(dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotation of unit vectors into the tables' blocks, scaled to cells, and the sketch's."""
    rng = np.random.default_rng([SEED, dims])
    full = max(dims, TABLES * 8)
    rotation = np.linalg.qr(rng.normal(size=(full, full)))[0][:dims, : TABLES * 8]
    return rotation * (np.sqrt(full) / WIDTH), rng.normal(size=(dims, 64))


def _mixed(points: np.ndarray, table: int, dims: int) -> np.ndarray:
    """A cell's key: a hash of its lattice point, the table in its last three bits."""
    codes = np.rint(2 * points).astype(np.int16).reshape(-1, 8)
    halves = np.ascontiguousarray(codes).view(np.uint64)
    key = np.full(len(codes), 0x9E3779B97F4A7C15 * (dims * TABLES + table + 1) & (1 << 64) - 1, np.uint64)
    for part in (halves[:, 0], halves[:, 1]):
        key = key ^ part
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            key = (key ^ (key >> np.uint64(shift))) * np.uint64(factor)
        key ^= key >> np.uint64(31)
    return ((key & ~np.uint64(7)) | np.uint64(table)).view(np.int64).reshape(points.shape[:-1])


def cells(unit: np.ndarray, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors: the cell of each in every table (n x TABLES), and the ``probes`` next
    nearest cells (n x TABLES x probes)."""
    n, dims = unit.shape
    # Row by row sums, so that a vector has the same cells in any batch.
    at = np.einsum("nd,dk->nk", unit, _projections(dims)[0])
    home, near = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, probes), np.int64)
    for t in range(TABLES):
        y = at[:, 8 * t : 8 * t + 8]
        point = nearest_point(y)
        home[:, t] = _mixed(point, t, dims)
        if probes:
            toward = np.einsum("nk,mk->nm", point - y, MINIMAL)
            # The neighbours of least distance, ties by their number.
            some = np.argsort(toward, axis=1, kind="stable")[:, :probes]
            near[:, t] = _mixed(point[:, None] + MINIMAL[some], t, dims)
    return home, near


def _sketch(unit: np.ndarray) -> np.ndarray:
    signs = np.einsum("nd,dk->nk", unit, _projections(unit.shape[1])[1]) > 0
    return np.packbits(signs, axis=1, bitorder="little").view(np.int64).ravel()


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors in double precision; null vectors have none."""
    lengths = np.array(column.value_lengths().fill_null(0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null is NaN
    starts = np.cumsum(lengths) - lengths
    for dims in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dims)
        yield rows, flat[starts[rows, None] + np.arange(dims)]


def _unit(v: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _digests(column: pa.Array) -> pa.Array:
    """16 bytes for each vector, equal for equal ones; null where no cosine is defined."""
    out: list[bytes | None] = [None] * len(column)
    for rows, v in _vectors(column):
        v = np.ascontiguousarray(v + 0.0)  # no negative zeros
        usable = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
        for i in np.flatnonzero(usable):
            out[rows[i]] = hashlib.blake2b(v[i], digest_size=16).digest()
    return pa.array(out, pa.binary())


def _posted(groups: DataFrame, probes: int) -> DataFrame:
    """(cell, gid, home, sketch): where each vector is at home, and where it looks."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.only()
        for batch in batches:
            gid = batch["gid"].to_numpy()
            for rows, v in _vectors(batch["v"]):
                unit = _unit(v)
                home, near = cells(unit, probes)
                each = np.concatenate([home[:, :, None], near], axis=2).reshape(len(rows), -1)
                width = each.shape[1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": each.ravel(),
                        "gid": np.repeat(gid[rows], width),
                        "home": np.tile(np.arange(width) % (1 + probes) == 0, len(rows)),
                        "sketch": np.repeat(_sketch(unit), width),
                    }
                )

    return groups.select("gid", "v").mapInArrow(post, "cell long, gid long, home boolean, sketch long")


def _dealt(posted: DataFrame, crowded: DataFrame, block: int) -> DataFrame:
    """Rows of a cell side by side, those at home there first (``stays``), in one task.

    A crowded cell has more slots: a vector at home stays in one of them and visits those
    before it, a vector that looks in visits all. So each pair with one at home meets once, and
    a task holds about a block at a time, however many visit.
    """
    slots = F.coalesce(F.ceil(F.col("homes") / block), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("gid"), slots)
    last = F.when(F.col("home"), own).otherwise(slots - 1)
    met = posted.join(crowded, "cell", "left").withColumn("own", own)
    met = met.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    met = met.withColumn("stays", F.col("home") & (F.col("slot") == F.col("own"))).drop("homes", "own")
    return met.repartition("cell", "slot").sortWithinPartitions("cell", "slot", F.desc("stays"))


def _pairs(
    group: np.ndarray, stays: np.ndarray, seen: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows that share a group, with i before j, i staying, j not yet ``seen``
    and ``near``; groups are runs of equal numbers."""
    n = len(group)
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    sizes = np.diff(edges)
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, n)):
        i = np.flatnonzero(small[:-step] & stays[:-step] & ~seen[step:] & (group[:-step] == group[step:]))
        i = i[near(i, i + step)]
        if len(i):
            yield i, i + step
    for begin, size in zip(edges[:-1][sizes > SMALL], sizes[sizes > SMALL]):
        rows = np.arange(begin, begin + size)
        hosts, fresh = rows[stays[rows]], rows[~seen[rows]]
        wide = max(1, AT_ONCE // max(1, len(hosts)))
        for k in range(0, len(fresh), wide):
            i, j = np.meshgrid(hosts, fresh[k : k + wide], indexing="ij")
            i, j = i.ravel(), j.ravel()
            i, j = i[i < j], j[i < j]
            kept = near(i, j)
            if kept.any():
                yield i[kept], j[kept]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of sorted rows with group number, ``stays`` and ``seen``. Of a group that goes
    on in the next batch, the rows that stay come again there, as seen."""
    kept: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        again = 0 if kept is None else kept.num_rows
        if kept is not None and again:
            table = pa.Table.from_batches([kept, batch]).combine_chunks()
            batch = table.to_batches()[0]
        cell, slot = batch["cell"].to_numpy(), batch["slot"].to_numpy()
        new = (cell[1:] != cell[:-1]) | (slot[1:] != slot[:-1])
        group = np.r_[0, np.cumsum(new)]
        stays = batch["stays"].to_numpy(zero_copy_only=False)
        seen = np.arange(len(group)) < again
        yield batch, group, stays, seen
        kept = batch.filter(pa.array((group == group[-1]) & stays))


def _candidates(dealt: DataFrame) -> DataFrame:
    """(cell, gid, home) of rows that have a partner by sketch in their cell."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.only()
        for batch, group, stays, seen in _walk(batches):
            sketch = batch["sketch"].to_numpy()
            found = np.zeros(len(group), bool)

            def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                return np.bitwise_count((sketch[i] ^ sketch[j]).view(np.uint64)) <= SKETCH_BITS

            for i, j in _pairs(group, stays, seen, near):
                found[i] = found[j] = True
            yield batch.select(["cell", "gid", "home"]).filter(pa.array(found))

    return dealt.mapInArrow(find, "cell long, gid long, home boolean")


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches over the links i-j."""
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _verified(dealt: DataFrame, least: float) -> DataFrame:
    """(gid, links, root): links by cosine, each pair in one cell only, and for each vector
    another that is in the same component (or itself)."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.only()
        for batch, group, stays, seen in _walk(batches):
            gid, copies = batch["gid"].to_numpy(), batch["copies"].to_numpy()
            size = len(gid)
            table = batch["cell"].to_numpy() & 7
            home, probe = np.empty((size, TABLES), np.int64), np.empty((size, TABLES, PROBES), np.int64)
            units: dict[int, np.ndarray] = {}
            length, place = np.empty(size, np.int64), np.empty(size, np.int64)
            for rows, v in _vectors(batch["v"]):
                unit = _unit(v)
                home[rows], probe[rows] = cells(unit)
                units[v.shape[1]] = unit
                length[rows], place[rows] = v.shape[1], np.arange(len(rows))

            def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                out = np.zeros(len(i), bool)
                for dims, unit in units.items():
                    for k in range(0, len(i), 1 << 16):
                        part = slice(k, k + (1 << 16))
                        a, b = i[part], j[part]
                        same = np.flatnonzero((length[a] == dims) & (length[b] == dims))
                        cosine = np.einsum("nd,nd->n", unit[place[a[same]]], unit[place[b[same]]])
                        out[k + same] = cosine >= least
                return out

            def meet(i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
                one, two = home[i, t], home[j, t]
                return (one == two) | (probe[i, t] == two[:, None]).any(axis=1) | (probe[j, t] == one[:, None]).any(axis=1)

            links, ends = np.zeros(size, np.int64), []
            for i, j in _pairs(group, stays, seen, near):
                # Only in the first table where the two meet, and there, where each looks into
                # the other's cell, at home of the lesser one.
                once = np.ones(len(i), bool)
                for t in range(TABLES - 1):
                    late = np.flatnonzero(once & (table[i] > t))
                    once[late[meet(i[late], j[late], t)]] = False
                mutual = (probe[i, table[i]] == home[j, table[i]][:, None]).any(axis=1) & (home[i, table[i]] != home[j, table[i]])
                once &= ~(mutual & (gid[i] > gid[j]))
                i, j = i[once], j[once]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                ends.append((i, j))
            if not ends:
                continue
            i, j = (np.concatenate(e) for e in zip(*ends))
            root = gid[_labels(size, i, j)]
            some = links > 0
            yield pa.RecordBatch.from_pydict({"gid": gid[some], "links": links[some], "root": root[some]})

    return dealt.mapInArrow(verify, "gid long, links long, root long")


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    *,
    cosine: float = 0.95,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``df``: id, n_links (other rows with a cosine of ``cosine`` or more,
    as far as the index finds them), component_id (least id that links reach) and kept (it has
    that id itself). No pair below ``cosine`` is linked.

    Every vector is at home in one cell of E8 per table and looks into its nearest neighbours.
    Cells compare 64-bit sketches; vectors move only for rows that have a partner by sketch, and
    their cosines are taken in double precision in blocks. No pair is written: rows add up what
    they find, pairs that meet in several cells count in the first, and components come from
    spanning links. Equal vectors are one entry with a count, whatever their number. Of distinct
    ones that are all near each other, each pair is computed, as the counts demand, in blocks.

    A vector that is null, empty, zero, or holds null or non-finite components links with
    nothing and is its own component; so do vectors of different lengths. Repeated rows are
    copies that link with each other. A null id is the least one only where there is no other,
    and is kept only there. The tables and cells suit cosines of 0.95 and more.
    """

    def with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("digest", _digests(batch["v"]))

    given = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("v"))
    schema = T.StructType([*given.schema.fields, T.StructField("digest", T.BinaryType())])
    marked = given.mapInArrow(with_digest, schema)
    rows = settle(marked.select("id", "digest"))
    distinct = marked.filter("digest IS NOT NULL").groupBy("digest")
    counted = distinct.agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("v").alias("v"))
    groups = settle(counted.withColumn("gid", F.monotonically_increasing_id()))

    homes = _posted(groups, 0).groupBy("cell").agg(F.count(F.lit(1)).alias("homes"))
    crowded = settle(homes.filter(F.col("homes") > block))
    found = settle(_candidates(_dealt(_posted(groups, PROBES), crowded, block)).distinct())
    carried = found.join(groups.select("gid", "copies", "v"), "gid")
    linked = settle(_verified(_dealt(carried, crowded, block), cosine))

    roots = components(linked.select(F.col("gid").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("gid").agg(F.sum("links").alias("links"))
    of_group = groups.select("gid", "digest", "copies", "least").join(links, "gid", "left")
    of_group = of_group.join(roots, F.col("gid") == F.col("node"), "left").select(
        "digest", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "gid").alias("root")
    )
    firsts = of_group.groupBy("root").agg(F.min("least").alias("component_id"))
    of_group = settle(of_group.join(firsts, "root").drop("root"))

    some = join_groups(rows.filter("digest IS NOT NULL"), of_group, "digest", "copies").select(
        "id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    none = rows.filter("digest IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    every = some.unionByName(none)
    return every.select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
