"""Operator 5: the tree against all pairs, linear work in groups of near copies, hot keys."""

import numpy as np
import pytest

from canvass.llm import neardup
from canvass.operators import skew


def sets_of(rng, n, base, size):
    """Near copies: each has most of one set of shingles."""
    out = []
    for _ in range(n):
        own = base.copy()
        changed = rng.choice(len(base), rng.integers(0, max(2, len(base) // 12)), replace=False)
        own[changed] = rng.integers(0, 2**63, len(changed), dtype=np.uint64)
        out.append(np.unique(own[: rng.integers(size, len(base) + 1)]))
    return out


def parts(n, links):
    root = list(range(n))
    for a, b in links:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


@pytest.mark.parametrize("seed", range(6))
def test_tree_and_families_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    shingles = [s for size in (5, 30, 80, 300) for s in sets_of(rng, 40, rng.integers(0, 2**63, size, dtype=np.uint64), max(1, size * 9 // 10))]
    shingles = [shingles[i] for i in np.argsort([len(s) for s in shingles], kind="stable")]
    sizes = np.array([len(s) for s in shingles])
    want = [(i, j) for i in range(len(sizes)) for j in range(i) if 100 * (o := len(np.intersect1d(shingles[i], shingles[j]))) >= 80 * (sizes[i] + sizes[j] - o)]
    tree = neardup.RTree(sizes, [neardup._counts(neardup._point(s)) for s in shingles])
    near = [set(tree.near(i, 80).tolist()) for i in range(len(sizes))]
    assert len(tree.nodes) == 3 and all(i in near[i] and j in near[i] and i in near[j] for i, j in want)  # no pair is lost by the bound
    links, compared = neardup.verified(np.arange(len(sizes)), sizes, shingles, 80)
    assert parts(len(sizes), links) == parts(len(sizes), want) and set(links) <= {(j, i) for i, j in want} | set(want)
    assert compared <= sum(map(len, near))
    sides = np.arange(len(sizes)) % 2
    across, _ = neardup.verified(np.arange(len(sizes)), sizes, shingles, 80, sides)
    assert parts(len(sizes), across) == parts(len(sizes), [(i, j) for i, j in want if sides[i] != sides[j]])


def test_twenty_thousand_near_copies_are_linear_work():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    shingles = []
    for _ in range(20_000):
        own = base.copy()
        own[rng.integers(0, 100, 4)] = rng.integers(0, 2**63, 4, dtype=np.uint64)
        shingles.append(np.unique(own))
    sizes = np.array([len(s) for s in shingles])
    links, compared = neardup.verified(np.arange(20_000), sizes, shingles, 80)
    assert len(links) == 19_999 and compared < 3 * 20_000


def test_hot_sets_and_empty_texts_where_nothing_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "small", lambda table, most=0: False)
    rows = [(i, "one text that very many documents have in common") for i in range(2000)] + [(2000 + i, "") for i in range(2000)] + [(4000 + i, f"text number {i} of its own kind, {i * i}") for i in range(300)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == (5, 0) for i in range(2000)) and all(got[2000 + i] == (0, 2000 + i) for i in range(2000)) and all(got[4000 + i][1] == 4000 + i for i in range(300))
    assert len(got) == 4300


def plain_components(rows):
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids, root = sorted(sets), {i: i for i in sets}
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in ids}


@pytest.fixture
def group_of_copies():
    """A chain of near copies, each like the one before but not like the first, copies of one text, and others."""
    rng, rows = np.random.default_rng(3), []
    words = [f"w{k}" for k in range(120)]
    for i in range(150):
        words[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(words)))
    base = [f"y{k}" for k in range(90)]
    for i in range(150, 400):
        own = base.copy()
        own[int(rng.integers(0, 90))] = f"z{i}"
        rows.append((i, " ".join(own)))
    return rows + [(i, " ".join(f"q{int(k)}" for k in rng.integers(0, 30, 40))) for i in range(400, 450)]


@pytest.mark.parametrize("tile, shingles", [(2048, 2_000_000), (32, 3_000), (5, 400)])
def test_groups_larger_than_a_tile(spark, monkeypatch, group_of_copies, tile, shingles):
    monkeypatch.setattr(neardup, "TILE", tile)
    monkeypatch.setattr(neardup, "TILE_SHINGLES", shingles)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.report(spark.createDataFrame(group_of_copies, "doc_id long, text string")).collect()}
    assert got == plain_components(group_of_copies)


def test_copies_of_one_text_are_dealt_out_in_proportion(spark):
    rng, counts = np.random.default_rng(5), {}
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    for n in (500, 2000):
        rows = []
        for i in range(n):
            own = base.copy()
            own[int(rng.integers(0, 60))] = rng.integers(0, 2**63, dtype=np.uint64)
            rows.append((0, i, 60, bytearray(np.sort(own).tobytes())))
        data = spark.createDataFrame(rows, "family long, id long, n long, shingles binary")
        sized = data.select("family", "id", data["n"].alias("weight"))
        led = neardup._led(steps := neardup._Steps(), sized, data.select("id", "n", "shingles"), "family", "shingles", 600, neardup._similar(80))
        assert led.count() == n and led.where("lead is not null").count() == n
        counts[n] = neardup._tiled(steps, sized, led, "family", 600).count()
    assert counts == {500: 0, 2000: 0}  # all are led by one member: no pair of tiles is left
