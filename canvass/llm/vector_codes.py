"""Operator 12: vector codes by Yinyang Lloyd.

A vector of whole numbers is cut into equal parts, and each part is replaced by the number of the nearest entry of
its codebook.  The entries of a codebook are clustered into groups once.  A vector keeps, for each part, its entry
and a lower bound a group on the distance to the group's other entries.  When entries move, each bound shrinks by
the largest move in its group; only groups whose bound no longer exceeds the distance to the own entry are
scanned.  Bounds are floating numbers rounded down; whoever is scanned is compared in whole numbers, so ties go
to the lower entry exactly, as they would without bounds.

Spark deals out the vectors, which are never shuffled: a round is a pass over them that writes their state as
Parquet, and sums by entry, added up in each task first.  The driver holds codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import spread_join
from ..storage import discard, saved

PARTS, ENTRIES, GROUPS, ROUNDS = 16, 64, 8, 2
SCALE = 256
#: Whole numbers are held within this, so that squared distances stay whole in 64 bits (embeddings lie far within).
MOST = 1 << 26
_FAR = np.iinfo(np.int64).max
_STATE = "point binary, code binary, bounds binary"


def kept(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(column: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of an Arrow column of lists, a row a vector, zeros behind shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    numbers = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)
    if (sizes == width).all():
        return numbers.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = numbers
    return out


def grouped(book: np.ndarray, groups: int) -> list[np.ndarray]:
    """The entries of one codebook in up to ``groups`` clusters: ascending entry numbers of each."""
    centres = book[np.linspace(0, len(book) - 1, min(groups, len(book))).astype(int)].astype(float)
    for _ in range(5):
        at = ((book[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        for g in range(len(centres)):
            if (at == g).any():
                centres[g] = book[at == g].mean(0)
    return [np.flatnonzero(at == g) for g in range(len(centres)) if (at == g).any()]


def assign(x: np.ndarray, own: np.ndarray, bounds: np.ndarray, book: np.ndarray, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(entries, squared distances, distances computed) for one part; ``bounds`` (vectors x groups) is renewed in place.

    ``own`` holds any entry of each vector, ``bounds`` lower bounds on distances to the other entries of each group.
    """
    group_of = np.empty(len(book), int)
    for g, members in enumerate(groups):
        group_of[members] = g
    mine = ((x - book[own]) ** 2).sum(1)
    fails = bounds <= np.sqrt(mine)[:, None] * (1 + 1e-9)
    best, entry, scanned, computed = mine.copy(), own.copy(), [], len(x)
    for g, members in enumerate(groups):
        rows = np.flatnonzero(fails[:, g])
        if not len(rows):
            continue
        distance = ((x[rows][:, None, :] - book[members][None]) ** 2).sum(2)
        computed += distance.size
        first = distance.argmin(1)  # members ascend, so the lower entry of a tie
        found, named = distance[np.arange(len(rows)), first], members[first]
        better = (found < best[rows]) | ((found == best[rows]) & (named < entry[rows]))
        best[rows[better]], entry[rows[better]] = found[better], named[better]
        scanned.append((g, rows, members, distance))
    for g, rows, members, distance in scanned:
        distance[members[None] == entry[rows][:, None]] = _FAR
        bounds[rows, g] = np.sqrt(distance.min(1))
    left = np.flatnonzero((entry != own) & ~fails[np.arange(len(x)), group_of[own]])  # the entry left is another of its group now
    bounds[left, group_of[own[left]]] = np.minimum(bounds[left, group_of[own[left]]], np.sqrt(mine[left]))
    return entry, best, computed


def _down(bounds: np.ndarray) -> np.ndarray:
    """As 16-bit floats that are no larger."""
    lower = np.minimum(bounds * 0.999, 65000.0)
    return np.where(lower < 0.001, 0.0, lower).astype(np.float16)


def _packed(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in raw], pa.binary())


class Books:
    """Codebooks (parts x entries x width of a part) with their groups, and how far each group has moved since the last."""

    def __init__(self, entries: np.ndarray, groups: list[list[np.ndarray]], moved: list[np.ndarray]) -> None:
        self.entries, self.groups, self.moved = entries, groups, moved

    @classmethod
    def first(cls, entries: np.ndarray, groups: int) -> Books:
        clusters = [grouped(book, groups) for book in entries]
        return cls(entries, clusters, [np.zeros(len(c)) for c in clusters])

    def after(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Books:
        """Each entry that holds parts becomes the floor of their mean, in whole numbers of any size."""
        entries = self.entries.copy()
        for (part, entry), (n, total) in sums.items():
            entries[part, entry] = [t // n for t in total]
        far = np.sqrt(((entries - self.entries) ** 2).sum(2))
        return Books(entries, self.groups, [np.array([far[p][g].max() for g in groups]) for p, groups in enumerate(self.groups)])


def _stepped(books: Books, points: np.ndarray, code: np.ndarray, bounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and error of ``points`` (vectors x parts x width); bounds are drift-adjusted, then renewed in place."""
    error = np.zeros(len(points), np.int64)
    code = code.copy()
    for p, book in enumerate(books.entries):
        np.maximum(bounds[p] - books.moved[p] * (1 + 1e-9), 0.0, out=bounds[p])
        code[:, p], distance, _ = assign(points[:, p], code[:, p].astype(int), bounds[p], book, books.groups[p])
        error += distance
    return code, error


def _split(bounds: np.ndarray, books: Books) -> list[np.ndarray]:
    sizes = np.cumsum([len(g) for g in books.groups])[:-1]
    return [np.ascontiguousarray(b, dtype=np.float64) for b in np.split(bounds, sizes, axis=1)]


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(b, kind) for b in column.to_pylist()])


def _points(column: pa.Array, width: int) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.int16 if len(b) == 2 * width else np.int32) for b in column.to_pylist()]).astype(np.int64)


def _narrow(points: np.ndarray) -> pa.Array:
    """Two bytes a number where a batch allows it, else four."""
    return _packed(points.astype(np.int16 if np.abs(points).max(initial=0) < 32768 else np.int32))


def _pass(books: Books, width: int, first: bool, last: bool):
    """A round over Arrow batches: of (vec_id, label, embedding) at first, then of (vec_id, label, state)."""
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if first:
                points, code, bounds = whole(batch.column(2), width), np.zeros((n, parts), np.uint8), np.zeros((n, sum(map(len, books.groups))))
            else:
                points, code, bounds = _points(batch.column(2), width), _unpacked(batch.column(3), np.uint8), _unpacked(batch.column(4), np.float16)
            held = _split(bounds, books)
            code, error = _stepped(books, points.reshape(n, parts, -1), code, held)
            if last:
                out = {"code": pa.array([c.tobytes().hex() for c in np.ascontiguousarray(code)], pa.string()), "error": pa.array(error)}
            else:
                out = {"point": _narrow(points), "code": _packed(code), "bounds": _packed(_down(np.concatenate(held, axis=1)))}
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *out.values()], names=["vec_id", "label", *out])

    return run


def _sums(shape: tuple[int, int, int]):
    """Counts and sums of the points by part and entry, a task's added up before they leave it."""
    parts, entries, wide = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, wide), np.int64)
        for batch in batches:
            if batch.num_rows:
                points = _points(batch.column(0), parts * wide).reshape(-1, wide)
                slot = (_unpacked(batch.column(1), np.uint8) + np.arange(parts) * entries).ravel()
                np.add.at(counts, slot, 1)
                np.add.at(sums, slot, points)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *(pa.array(sums[used, i]) for i in range(wide))], names=["slot", "n", *(f"s{i}" for i in range(wide))])

    return run


def _moved(books: Books, state: DataFrame) -> Books:
    parts, entries, wide = books.entries.shape
    names = [f"s{i}" for i in range(wide)]
    sums = state.select("point", "code").mapInArrow(_sums(books.entries.shape), "slot long, n long, " + ", ".join(f"{s} long" for s in names))
    rows = sums.groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in names)).collect()  # parts * entries rows at most
    return books.after({divmod(r["slot"], entries): (r["n"], [r[s] for s in names]) for r in rows})


def compressed(embeddings: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, groups: int = GROUPS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Saved (vec_id, label, code, error) of every vector kept, and the final codebooks (parts x entries x width of a part).

    Codebooks start as the parts of the ``entries`` smallest vec_ids (null last, ties by the vector), fewer where there are fewer; 256 at most.
    Vectors of unequal lengths are filled with zeros up to the longest, and that to a multiple of ``parts``.
    """
    vectors = embeddings.where(kept(F.col("embedding"))).select("vec_id", "label", "embedding")
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    if not seeds:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    longest = vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    width = max(1, -(-longest // parts)) * parts
    start = whole(pa.array([r["embedding"] for r in seeds], pa.list_(pa.float64())), width).reshape(len(seeds), parts, -1)
    books = Books.first(start.transpose(1, 0, 2), groups)
    state = vectors
    for k in range(rounds):
        after = saved(state.mapInArrow(_pass(books, width, k == 0, False), f"{kinds}, {_STATE}"), "codes")
        discard(state)
        state, books = after, _moved(books, after)
    done = saved(state.mapInArrow(_pass(books, width, rounds == 0, True), f"{kinds}, code string, error long"), "coded")
    discard(state)
    return done, books.entries


def report(embeddings: DataFrame) -> DataFrame:
    """The contract's rows.

    Vectors that are null or hold a null or a number that is not finite are left out; null ids and labels are values
    like others (null labels stand together), repeated rows are coded each, numbers beyond 2**26 / 256 count as that,
    lengths may differ (see :func:`compressed`), other columns are not read, no rows give no rows.
    """
    done, books = compressed(embeddings)
    rows = done.withColumn("_label", F.to_json(F.struct("label")))
    sums = saved(rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "labels")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return spread_join(rows, sums, "_label", counted="_n").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
