"""Operator 5: n-gram Jaccard join by count-vector R-trees, exact.

A document is the set of its distinct shingles.  Equal sets form a class and only classes are joined.

1. Each class deals itself to blocks by the shingles of its prefix: with a common order of shingles, two sets
   of similarity t share one of the first n - ceil(t n) + 1.  Shingles that very many prefixes hold come last
   in the order.  Only shingles that two classes hold make blocks, and blocks with the same members are one.
2. Shingles are hashed into groups; a class is the point of its group counts.  In each block an R-tree over
   the points bounds the overlap of two sets by the sum of coordinate minima; classes that may be similar are
   joined to families.  In a block larger than a tile some members stand for it first, and those that may match one
   of them need not meet among themselves; what is left is dealt out in pairs of tiles.
3. In each family (larger ones again by members that stand for it, and tiles) an R-tree gives each member the others that the bound leaves; those
   that no link has joined with it yet are verified on the shingles themselves.  Only links that join what was
   not joined are written, so copies never become all their pairs, neither as rows nor as comparisons.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.skew import spread_join
from ..storage import discard, saved
from ._words import NOT_SPACE, Words, in_batches, mix, slices

WORDS = 5
PERCENT = 80
COMMON = 500  # prefixes that hold a shingle, above which it comes last in the order
COMMON_KEPT = 500_000  # such shingles that are broadcast, 8 bytes each; the most common first
TILE = 2048  # classes of a block in one task at most, and words of a family's tile below
TILE_SHINGLES = 2_000_000
BROADCAST_ROWS = 1_000_000
GROUPS = (32, 1024)
PIVOTS = 3  # rounds in which members of a group larger than a tile stand for it


def _sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end; and the offsets."""
    counts = words.counts()
    h, at = words.windows(k)
    owner = words.of_text(at)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):  # the whole sequence as one
        whole = np.array([int(words.windows(1)[0][words.first[r]]) if counts[r] == 1 else _fold(words.hash[words.first[r] : words.first[r + 1]]) for r in short], np.uint64)
        h, owner = np.concatenate([h, mix(whole + counts[short].astype(np.uint64))]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(counts) + 1))


def _fold(hashes: np.ndarray) -> int:
    out = 0
    for x in hashes.tolist():
        out = (out * 0xD6E8FEB86659FD93 + x) % (1 << 64)
    return out


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _groups_of(n: int) -> int:
    """Number of groups of a set of n: a power of two near n / 8, in GROUPS."""
    return min(GROUPS[1], max(GROUPS[0], 1 << int(n // 8).bit_length()))


def _point(h: np.ndarray) -> bytes:
    """Group counts: one byte each where they fit, else two."""
    counts = np.bincount((h >> np.uint64(40)).astype(np.int64) % _groups_of(len(h)), minlength=_groups_of(len(h)))
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b"\1" + counts.astype("<u2").tobytes() if counts.max() < 65536 else b"\2" + counts.astype("<u4").tobytes()


def _counts(point: bytes) -> np.ndarray:
    if len(point) % 2 == 0:
        return np.frombuffer(point, np.uint8).astype(np.int32)
    return np.frombuffer(point, "<u2" if point[0] == 1 else "<u4", offset=1).astype(np.int32)


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(-1, groups).sum(0)


def _signer(common, k: int, percent: int, brief: bool):
    def sign(batches):
        last = common.value
        for batch in batches:
            n, key1, key2, point, prefix = [], [], [], [], []
            for _, _, data, offsets in slices(batch.column("text")):
                h, edges = _sets(Words(data, offsets, NOT_SPACE), k)
                sizes = np.diff(edges)
                place = np.searchsorted(last, h)
                place[place == len(last)] = 0
                late = last[place] == h if len(last) else np.zeros(len(h), bool)
                one = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(1)))])
                two = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
                n.append(sizes)
                key1.append((one[edges[1:]] - one[edges[:-1]]).view(np.int64))
                key2.append((two[edges[1:]] - two[edges[:-1]]).view(np.int64))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    own = h[a:b]
                    if late[a:b].any():
                        own = np.concatenate([own[~late[a:b]], own[late[a:b]]])
                    prefix.append(own[: prefix_length(b - a, percent)].view(np.int64) if b > a else own[:0].view(np.int64))
                    if not brief:
                        point.append(_point(h[a:b]))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in prefix])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *prefix])))
            if brief:
                yield pa.RecordBatch.from_arrays([lists], names=["prefix"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(key1)), pa.array(np.concatenate(key2)), pa.array(point, pa.binary()), lists], names=["doc_id", "n", "key1", "key2", "point", "prefix"])

    return sign


def signed(texts: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n (shingles), key1, key2 (hash of the set), point (group counts), prefix: saved, a row per row."""
    spark = texts.sparkSession
    none = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    first = in_batches(texts.select("text")).mapInArrow(_signer(none, k, percent, True), "prefix array<long>")
    held = first.select(F.explode("prefix").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > COMMON)
    common = np.array([r["h"] for r in held.orderBy(F.desc("n"), "h").limit(COMMON_KEPT).select("h").collect()], np.int64).view(np.uint64)
    sent = spark.sparkContext.broadcast(np.sort(common))
    return saved(texts.mapInArrow(_signer(sent, k, percent, False), "doc_id long, n long, key1 long, key2 long, point binary, prefix array<long>"), "signed")


class _Forest:
    """Which members of a task are joined already."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def whole(self) -> bool:
        """All are in one tree: nothing is left to join."""
        return bool((self.root == self.root[0]).all())

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Join i with ``others``; those that this joins to something new, one for each tree."""
        fresh = others[self.root[others] != self.root[i]]
        if not len(fresh):
            return fresh
        if len(fresh) == 1:
            a, b = sorted((int(self.root[i]), int(self.root[fresh[0]])))
            self.root[self.root == b] = a
            return fresh
        _, one = np.unique(self.root[fresh], return_index=True)
        trees = np.append(self.root[fresh[one]], self.root[i])
        self.root[np.isin(self.root, trees)] = trees.min()
        return fresh[one]


def _least_overlap(n1, n2, percent: int):
    """Smallest overlap at which sets of n1 and n2 are similar: 100 o >= percent (n1 + n2 - o)."""
    return -(-percent * (n1 + n2) // (100 + percent))


class RTree:
    """Points packed by size into leaves of 16, leaves into nodes of 16 and so on; a node has the largest count of each
    group below it and the range of sizes.

    Points of large sets have more groups; two points are compared in the groups of the coarser one.
    """

    LEAF = 16

    def __init__(self, sizes: np.ndarray, points: list[np.ndarray]) -> None:
        self.sizes, self.points = sizes, points
        self.width = np.array([len(p) for p in points])
        coarsest = int(self.width.min())
        self.levels = {g: np.array([_folded(p, min(g, len(p))) if len(p) >= g else np.zeros(g, np.int32) for p in points]) for g in np.unique(self.width).tolist()}
        self.coarsest = coarsest
        self.order = np.argsort(sizes, kind="stable")
        self.nodes = [(self.levels[coarsest][self.order], sizes[self.order], sizes[self.order])]
        while len(self.nodes[-1][1]) > 1:
            top, low, high = self.nodes[-1]
            starts = np.arange(0, len(low), self.LEAF)
            self.nodes.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def near(self, i: int, percent: int) -> np.ndarray:
        """Members whose overlap with member i may suffice, by the sum of coordinate minima; i is among them."""
        size, point = int(self.sizes[i]), self.points[i]
        own = _folded(point, self.coarsest)
        at = np.zeros(1, np.int64)
        for depth in range(len(self.nodes) - 1, 0, -1):
            top, low, high = self.nodes[depth]
            at = at[(low[at] * percent <= size * 100) & (size * percent <= high[at] * 100)]
            least = _least_overlap(size, np.maximum(low[at], -(-percent * size // 100)), percent)
            at = at[np.minimum(top[at], own).sum(1) >= least]
            at = (at[:, None] * self.LEAF + np.arange(self.LEAF)).ravel()
            at = at[at < len(self.nodes[depth - 1][1])]
        rows = self.order[at]
        n = self.sizes[rows]
        rows = rows[(n * percent <= size * 100) & (size * percent <= n * 100)]
        keep = []
        for g in np.unique(np.minimum(self.width[rows], len(point))).tolist():
            own_rows = rows[np.minimum(self.width[rows], len(point)) == g]
            bound = np.minimum(self.levels[g][own_rows], _folded(point, g)).sum(1)
            keep.append(own_rows[bound >= _least_overlap(size, self.sizes[own_rows], percent)])
        return np.concatenate(keep) if keep else rows


def _bounded(percent: int):
    return lambda n1, p1, n2, p2: _may_match(n1, _counts(p1), n2, _counts(p2), percent)


def _may_match(n1: int, p1: np.ndarray, n2: int, p2: np.ndarray, percent: int) -> bool:
    if n1 * percent > n2 * 100 or n2 * percent > n1 * 100:
        return False
    g = min(len(p1), len(p2))
    return bool(np.minimum(_folded(p1, g), _folded(p2, g)).sum() >= _least_overlap(n1, n2, percent))


def _grouped(batches, keys: list[str]):
    """Whole groups of a partition that is sorted by ``keys``, as tables; the last of a batch waits for the next."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
        columns = [table.column(k).to_numpy() for k in keys]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *edges.tolist()]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield table.slice(a, b - a)
        held = table.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])


def _other_tile(tile: np.ndarray, across: bool, i: int, rows: np.ndarray) -> np.ndarray:
    """In a task of two tiles only pairs across count: those within a tile are the tile's own task."""
    return rows[tile[rows] != tile[i]] if across else rows


def _block_join(percent: int):
    def join(batches):
        out: list[tuple[int, int]] = []
        for group in _grouped(batches, ["block", "t1", "t2"]):
            if group.num_rows < 2:
                continue
            ids, sizes, tile = (group.column(c).to_numpy() for c in ("id", "n", "tile"))
            points = [_counts(p) for p in group.column("point").to_pylist()]
            across = group.column("t1")[0].as_py() != group.column("t2")[0].as_py()
            if len(ids) == 2:
                if (not across or tile[0] != tile[1]) and _may_match(int(sizes[0]), points[0], int(sizes[1]), points[1], percent):
                    out.append((ids[0], ids[1]))
            else:
                tree, forest = RTree(sizes, points), _Forest(len(ids))
                for i in range(len(ids)):
                    if forest.whole():
                        break
                    forest.join(i, _other_tile(tile, across, i, tree.near(i, percent)))
                # Each member with the smallest of its tree: blocks of much the same members write the same pairs.
                least = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(least, forest.root, ids)
                out.extend((a, b) for a, b in zip(ids.tolist(), least[forest.root].tolist(), strict=True) if a != b)
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return join


def _shared(flag: np.ndarray, place: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many flagged shingles each of ``rows`` has."""
    n = sizes[rows]
    first = np.cumsum(n) - n
    at = np.repeat(starts[rows] - first, n) + np.arange(int(n.sum()))
    return np.add.reduceat(flag[place[at]], first)


def verified(ids: np.ndarray, sizes: np.ndarray, shingles: list[np.ndarray], percent: int, apart: np.ndarray | None = None) -> tuple[list[tuple[int, int]], int]:
    """(links that span each component, pairs compared) of one family.

    The R-tree over the members' points gives each member those that the bound leaves; of these only the ones
    that are not in its tree of the forest yet are compared on their shingles.  ``apart`` names sides: pairs within
    a side do not count.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    _, place = np.unique(np.concatenate(shingles), return_inverse=True)
    flag = np.zeros(int(place.max(initial=-1)) + 1, np.int32)
    tree, forest = RTree(sizes, [_counts(_point(s)) for s in shingles]) if len(ids) > RTree.LEAF else None, _Forest(len(ids))
    out, compared = [], 0
    for i in range(len(ids)):
        if forest.whole():
            break
        rows = np.arange(len(ids)) if tree is None else np.sort(tree.near(i, percent))
        rows = rows[(forest.root[rows] != forest.root[i]) & (sizes[rows] * percent <= sizes[i] * 100) & (sizes[i] * percent <= sizes[rows] * 100)]
        if apart is not None:
            rows = rows[apart[rows] != apart[i]]
        rows = rows[rows > i]  # the others have met i as their own turn came
        if not len(rows):
            continue
        own = place[starts[i] : ends[i]]
        flag[own] = 1
        both = _shared(flag, place, starts, sizes, rows)
        flag[own] = 0
        compared += len(rows)
        out.extend((ids[i], ids[j]) for j in forest.join(i, rows[100 * both >= percent * (sizes[i] + sizes[rows] - both)]).tolist())
    return out, compared


def _family_join(percent: int):
    def join(batches):
        for group in _grouped(batches, ["family", "t1", "t2"]):
            ids, sizes, tile = (group.column(c).to_numpy() for c in ("id", "n", "tile"))
            across = group.column("t1")[0].as_py() != group.column("t2")[0].as_py()
            shingles = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            yield _pairs(verified(ids, sizes, shingles, percent, tile if across else None)[0])

    return join


def _by_task(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(key, "t1", "t2").sortWithinPartitions(key, "t1", "t2", "n", "id")


class _Steps:
    """Saved tables of one join, deleted together when its result is written."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(saved(df, name))
        return self.tables[-1]

    def discard(self) -> None:
        discard(*self.tables)
        self.tables = []


def _led(steps: _Steps, members: DataFrame, payload: DataFrame, key: str, data: str, most: int, matches, rounds: int = PIVOTS) -> DataFrame | None:
    """Saved (key, id, weight, lead) of the members of groups whose weight adds up to more than ``most``; None without such.

    In each round a member that none leads stands for its group, and those that match it are led by it: a row a
    member, so linear work.  Members of one lead are in one tree already and need not meet.  ``members`` is saved and has
    key, id, weight; ``payload`` has id, n, data.
    """
    large = members.groupBy(key).agg(F.sum("weight").alias("_load"), F.count("*").alias("_n")).where((F.col("_load") > most) & (F.col("_n") > 1))
    large = steps.saved(large.select(key, "_n"), "large")
    if not large.limit(1).count():
        return None
    open_ = saved(spread_join(members, large, key, counted="_n").select(key, "id", "weight").join(payload, "id"), "open")
    names = [key, "id", "weight", "n", data]
    kinds = ", ".join(f"{c} {open_.schema[c].dataType.simpleString()}" for c in names)
    led = []

    def test(batches):
        for batch in batches:
            own, other = ((batch.column(n).to_pylist(), batch.column(d).to_pylist()) for n, d in (("n", data), ("_pn", "_pdata")))
            lead = [p if matches(*x) else None for p, *x in zip(batch.column("_pid").to_pylist(), *own, *other, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(lead, pa.int64())], names=[*names, "lead"])

    for k in range(rounds):
        first = open_.groupBy(key).agg(F.min_by(F.struct("id", "n", data), F.xxhash64("id", F.lit(k))).alias("p"), F.count("*").alias("_n"))
        pivots = saved(first.select(key, F.col("p.id").alias("_pid"), F.col("p.n").alias("_pn"), F.col(f"p.{data}").alias("_pdata"), "_n"), "pivots")
        tested = steps.saved(in_batches(spread_join(open_, pivots, key, known_small=False, counted="_n").drop("_n")).mapInArrow(test, f"{kinds}, lead long"), "tested")
        discard(open_, pivots)
        led.append(tested.where("lead is not null").select(key, "id", "weight", "lead"))
        open_ = tested.where("lead is null").drop("lead")
    return steps.saved(reduce(DataFrame.unionByName, led, open_.select(key, "id", "weight", F.lit(None).cast("long").alias("lead"))), "led")


def _tiled(steps: _Steps, members: DataFrame, led: DataFrame | None, key: str, most: int) -> DataFrame:
    """(key, id, tile, t1, t2) of members (key, id, weight): a group of at most ``most`` by weight is one task (0, 0).

    A larger one is cut into tiles, none of which holds members of two leads, and a member goes to every pair of tiles
    that holds its own, but not where both have its lead: a group that one member leads makes no task at all.
    """
    zero = F.lit(0).cast("long")
    sized = members.groupBy(key).agg(F.sum("weight").alias("_load"), F.count("*").alias("_n")).where((F.col("_n") > 1) & (F.col("_load") <= most))
    small = members.join(sized.select(key), key, "left_semi").select(key, "id", zero.alias("tile"), zero.alias("t1"), zero.alias("t2"))
    if led is None:
        return small
    rows = steps.saved(led.withColumn("_own", F.concat_ws("|", key, F.coalesce("lead", F.lit(-1)))), "large")
    groups = rows.groupBy(key, "lead", "_own").agg(F.sum("weight").alias("_load"), F.count("*").alias("_n"))
    groups = steps.saved(groups.select(key, "lead", "_own", "_n", F.ceil(F.col("_load") / F.lit(most)).cast("long").alias("_many")), "groups")
    name = F.xxhash64("_own", "_k")
    tiles = groups.select(key, "lead", "_own", F.explode(F.sequence(zero, F.col("_many") - 1)).alias("_k"))
    listed = tiles.groupBy(key).agg(F.collect_list(F.struct("lead", name.alias("tile"))).alias("_tiles")).join(groups.groupBy(key).agg(F.sum("_n").alias("_n")), key)
    own = spread_join(rows, groups.select("_own", "_many", "_n"), "_own", counted="_n").withColumn("_k", F.pmod(F.xxhash64("id"), F.col("_many")))
    own = steps.saved(own.select(key, "id", "lead", name.alias("tile")), "own")
    met = spread_join(own, steps.saved(listed, "tiles"), key, counted="_n").withColumn("_other", F.explode("_tiles"))
    met = met.where(F.col("lead").isNull() | F.col("_other.lead").isNull() | (F.col("lead") != F.col("_other.lead")))
    return small.unionByName(met.select(key, "id", "tile", F.least("tile", "_other.tile").alias("t1"), F.greatest("tile", "_other.tile").alias("t2")))


def _similar(percent: int):
    """Whether two sets of shingles, as sorted hashes, are similar."""

    def test(n1: int, one: bytes, n2: int, other: bytes) -> bool:
        if n1 * percent > n2 * 100 or n2 * percent > n1 * 100:
            return False
        both = len(np.intersect1d(np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64), assume_unique=True))
        return 100 * both >= percent * (n1 + n2 - both)

    return test


def _with_leads(links: DataFrame, led: DataFrame | None) -> DataFrame:
    return links if led is None else links.unionAll(led.where("lead <> id").select("id", "lead"))


def _shingler(k: int):
    def read(batches):
        for batch in batches:
            out, n = [], []
            for _, _, data, offsets in slices(batch.column("text")):
                h, edges = _sets(Words(data, offsets, NOT_SPACE), k)
                out.extend(h[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                n.append(np.diff(edges))
            yield pa.RecordBatch.from_arrays([batch.column("family"), batch.column("id"), pa.array(np.concatenate([np.zeros(0, np.int64), *n])), pa.array(out, pa.binary())], names=["family", "id", "n", "shingles"])

    return read


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a saved frame of a few numbers a row if it has at most BROADCAST_ROWS, else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def classes(texts: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members, links) of ``texts`` (doc_id long, text).

    members: doc_id, n_shingles, class_id (smallest doc_id with the same set; null for empty sets), a row per
    row.  links: a, b, class ids of verified pairs that span each component.
    """
    steps = _Steps()
    rows = signed(texts, k, percent)
    steps.tables.append(rows)
    keyed = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.struct("key1", "key2")).alias("_set"))  # empty sets are in no class
    own = steps.saved(keyed.where("n > 0").groupBy("_set").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("_n")), "sets")
    members = saved(spread_join(keyed, own, "_set", "left", counted="_n").select("doc_id", F.col("n").alias("n_shingles"), "class_id"), "members")
    chosen = _small(steps.saved(members.where("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct(), "classes"))

    # Blocks: shingles in the prefixes of two classes or more; those with equal members are one block.
    prefixes = rows.join(chosen, rows["doc_id"] == chosen["id"], "left_semi").select(F.col("doc_id").alias("id"), F.explode("prefix").alias("h"))
    shared = prefixes.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1").select("h")
    held = steps.saved(prefixes.join(shared, "h").select("h", "id").distinct(), "prefixes")  # a shingle has some thousands of prefixes: common ones come last
    names = held.groupBy("h").agg(F.count("*").alias("_n"), F.bit_xor(F.xxhash64("id")).alias("_x")).where("_n > 1")
    blocks = held.join(names.select("h", F.xxhash64("_n", "_x").alias("block")), "h").select("block", "id").distinct()
    points = rows.select(F.col("doc_id").alias("id"), "n", "point").dropDuplicates(["id"])
    ids = _small(steps.saved(held.select("id").distinct(), "ids"))
    points = points.join(ids, "id", "left_semi")
    dealt = steps.saved(blocks.withColumn("weight", F.lit(1).cast("long")), "blocks")
    points = steps.saved(points, "points")
    led = _led(steps, dealt, points, "block", "point", TILE, _bounded(percent))
    tasks = _tiled(steps, dealt, led, "block", TILE).join(points, "id").select("block", "t1", "t2", "tile", "id", "n", "point")
    possible = _with_leads(_by_task(tasks, "block").mapInArrow(_block_join(percent), "a long, b long"), led)
    families = components(steps.saved(possible.select("a", "b").distinct(), "possible")).select(F.col("node").alias("id"), F.col("component").alias("family"))

    # Verification on whole texts of the classes that have a family.
    wanted = _small(steps.saved(families, "families"))
    found = texts.join(wanted, texts["doc_id"] == wanted["id"]).select("family", "id", "text").mapInArrow(_shingler(k), "family long, id long, n long, shingles binary")
    found = steps.saved(found.dropDuplicates(["id"]), "shingles")
    sized = steps.saved(found.select("family", "id", F.col("n").alias("weight")), "families")
    led = _led(steps, sized, found.select("id", "n", "shingles"), "family", "shingles", TILE_SHINGLES, _similar(percent))
    work = _tiled(steps, sized, led, "family", TILE_SHINGLES).join(found.select("id", "n", "shingles"), "id").select("family", "t1", "t2", "tile", "id", "n", "shingles")
    links = saved(_with_leads(_by_task(work, "family").mapInArrow(_family_join(percent), "a long, b long"), led), "links")
    steps.discard()
    return members, links


def linked(texts: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: a row per row.  Texts without words link with nothing."""
    members, links = classes(texts, k, percent)
    reached = components(links)
    found = spread_join(members, saved(reached.withColumnRenamed("node", "class_id"), "reached"), "class_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def report(documents: DataFrame) -> DataFrame:
    """The contract's rows.  Rows that share an id count as one document if their texts agree."""
    return linked(_texts(documents))


def kept(documents: DataFrame) -> DataFrame:
    """One row of each component: the one with the smallest id, rows without an id last; documents without
    words all stay, repeated rows of one once.  Rows are linked by their own texts, whatever ids they share."""
    names = [f"_{c}" for c in documents.columns]
    # Saved, because every later reading must see the same numbers.
    rows = saved(documents.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = saved(linked(rows.select(F.col("row").alias("doc_id"), F.coalesce("_text", F.lit("")).alias("text"))), "linked")
    many = _small(saved(found.where("n_shingles > 0 and component_id <> doc_id").select("component_id").distinct(), "groups"))
    copies = found.where("n_shingles > 0").join(many, "component_id").select(F.col("doc_id").alias("member"), "component_id")
    # Ties of ids go by the row's content, so that the choice does not depend on the numbers.
    content = F.xxhash64(*[f.name for f in rows.schema if f.name != "row" and "map<" not in f.dataType.simpleString()])
    own = rows.select("row", F.col("_doc_id").cast("long").alias("id"), content.alias("content"))
    copies = own.join(copies, own["row"] == copies["member"]).select("component_id", F.struct(F.col("id").isNull().alias("last"), "id", "content", "row").alias("place"))
    wordless = ~F.coalesce(F.col("_text"), F.lit("")).rlike("[^ \\t\\n\\x0b\\x0c\\r]")
    blank = rows.where(wordless & F.col("_doc_id").isNotNull()).select("_doc_id", F.coalesce(F.length("_text"), F.lit(-1)).alias("_long"), F.xxhash64("_text").alias("_text"), F.struct(content.alias("content"), "row").alias("place"))
    gone = _others(copies, ["component_id"]).unionAll(_others(blank, ["_doc_id", "_long", "_text"]))
    gone = _small(saved(gone, "copies"))
    return rows.join(gone, "row", "left_anti").select(*names).toDF(*documents.columns)


def _others(members: DataFrame, key: list[str]) -> DataFrame:
    """The rows that are not first by place among those of the same key."""
    first = members.groupBy(*key).agg(F.min("place")["row"].alias("first"))
    same = [members[c].eqNullSafe(first[c]) for c in key]
    return members.join(first, same).where(F.col("place.row") != F.col("first")).select(F.col("place.row").alias("row"))
