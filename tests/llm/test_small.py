"""Small tables with nulls, empty and very long texts, ties, repeated rows, no rows and clashing extra columns."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from canvass.llm import decontaminate, fingerprints, language, licenses, mixing, neardup, pages, quality, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, pool=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def odd_documents(spark, extra=()):
    """Null, empty, blank, long, repeated and tied rows."""
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \t\n", "en", "b", 3), (4, "one", "en", "a", 3), (5, "one two three four", "de", "a", 3), (5, "one two three four", "de", "a", 3), (6, "ONE two three Four", "de", None, 3), (None, "no id at all here now", "en", "a", 1), (7, " ".join(words(30_000, 1, 5000)), "en", "b", 9), (8, "çé ퟿ 漢字 漢字 x", "fr", "c", 2)]
    return spark.createDataFrame([(*r, *[None] * len(extra)) for r in rows], DOCS + "".join(f", `{c}` string" for c in extra))


LABELS = "doc_id long, quality int, toxic int"


def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, None, 1), (5, 0, None), (5, 0, 1), (None, 1, 1), (7, 1, 0), (99, 0, 1)], LABELS)


def test_odd_rows_pass_through_every_operator(spark):
    docs, labels = odd_documents(spark), odd_labels(spark)
    bench = spark.createDataFrame([(1, "one two three four"), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    for df in (mixing.report(docs), fingerprints.report(docs), language.report(docs), decontaminate.report(docs, bench), neardup.report(docs), licenses.report(docs), toxicity.report(docs, labels), tokens.report(docs), quality.report(docs, labels)):
        assert df.count() == docs.count(), df.columns
    html = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<" * 1000)], "page_id long, url string, html string")
    assert pages.report(html).count() == 4


def test_no_rows(spark):
    docs, labels = odd_documents(spark).limit(0), odd_labels(spark).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (mixing.report(docs), fingerprints.report(docs), language.report(docs), decontaminate.report(docs, bench), neardup.report(docs), licenses.report(docs), toxicity.report(docs, labels), tokens.report(docs), quality.report(docs, labels), pages.report(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert df.count() == 0, df.columns


# 1


def test_mix_targets_by_hand(spark):
    sized = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate([("a", 100), ("b", 10), ("c", 190), (None, 100)])], "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    # weights 1, 2, 3, 1 of 400 words; b stops at 30, the other 370 go 1 : 3 : 1
    assert got == pytest.approx({"a": 74.0, "b": 30.0, "c": 222.0, None: 74.0})
    assert sum(got.values()) == pytest.approx(400)


def test_mix_meets_targets_and_reruns(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", rng.randrange(0, 400)) for i in range(6000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    once = mixing.decisions(sized, block=64).collect()
    again = mixing.decisions(sized.repartition(3), block=64).collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, again))
    taken, target = {}, {}
    for r in once:
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)


def test_flight_keeps_balance_and_leaves_two():
    import numpy as np

    rng = np.random.default_rng(5)
    pi, x = rng.random(300), np.stack([np.ones(300), rng.integers(0, 50, 300)], axis=1).astype(float)
    out = mixing.flight(pi, x, rng)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert np.allclose(out @ x, pi @ x, atol=1e-6)


@pytest.mark.parametrize("n", [2, 5, 10, 30, 300])
def test_inclusion_probabilities_hold_in_sources_of_any_size(n):
    import numpy as np

    rng = np.random.default_rng(n)
    pi, size = np.full(n, 0.3), np.sort(np.exp(rng.normal(5, 1.5, n)).round())[::-1]
    x = np.stack([np.ones(n), size], axis=1) / np.array([1.0, size.max()])
    taken = []
    for seed in range(2000):
        own = np.random.default_rng(seed)
        taken.append(mixing.landing(mixing.flight(pi, x, own), x, own))
    assert np.abs(np.mean(taken, axis=0) - pi).max() < 0.05
    assert set(np.unique(taken)) <= {0.0, 1.0}


def test_parallel_units_keep_their_words():
    import numpy as np

    # one, two and three rows of one document: 600 words in all, half of them wanted
    x = np.array([[1, 100], [2, 200], [3, 300]]) / np.array([3.0, 300.0])
    for seed in range(50):
        out = mixing.flight(np.full(3, 0.5), x, np.random.default_rng(seed))
        assert out @ [100, 200, 300] == pytest.approx(300) and ((out > 0) & (out < 1)).sum() <= 2
    mean = np.mean([mixing.landing(mixing.flight(np.full(3, 0.5), x, g), x, g) for g in map(np.random.default_rng, range(2000))], axis=0)
    assert np.abs(mean - 0.5).max() < 0.05


def test_repeated_rows_of_one_size(spark):
    rows = [(i // (1 + i % 3), "s", 100) for i in range(3000)] + [(None, "s", 50)] * 40 + [(i, "t", 100) for i in range(3000)]
    got = mixing.decisions(spark.createDataFrame(rows, "doc_id long, source string, size long"), block=128)
    for r in got.groupBy("source").agg(F.sum(F.col("copies") * F.col("rows") * F.col("size")).alias("n"), F.max("target").alias("target")).collect():
        assert abs(r["n"] - r["target"]) < 0.02 * r["target"]


def test_sources_with_odd_names_stay_apart(spark):
    rows = [(i, s, 10) for i, s in enumerate(["\0"] * 14 + [None] * 7)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    taken = {r["source"]: r["n"] for r in mixing.decisions(sized).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n")).collect()}
    target = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert all(abs(taken[s] - target[s]) < 10 for s in target)


def test_mix_by_hand(spark):
    # one source: target equals its size, so every document is taken once
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", "s"), (3, None, "s"), (3, None, "s")], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.report(docs).collect()) == [(1, 2, 3, 3.0, 2), (2, 1, 3, 3.0, 1), (3, 0, 3, 3.0, 0), (3, 0, 3, 3.0, 0)]
    # weights 1 and 2 of 9 words: a has 6 and wants 3, b has 3 and wants 6
    docs = spark.createDataFrame([(i, "w " * 3, "a") for i in (1, 2)] + [(3, "w w w", "b")], "doc_id long, text string, source string")
    assert sorted((r["source"], r["target"], r["n"]) for r in mixing.report(docs).groupBy("source", "target").agg(F.sum("taken").alias("n")).collect()) == [("a", 3.0, 3), ("b", 6.0, 6)]


def test_mixed_repeats_rows_and_keeps_clashing_columns(spark):
    docs = odd_documents(spark, ("copies", "size", "copy", "c0", "words"))
    got = mixing.mixed(docs)
    assert got.columns == [*docs.columns, "_copy"]
    taken = {(r["doc_id"], r["source"]): r["n"] for r in got.groupBy("doc_id", "source").agg(F.max("_copy").alias("n")).collect()}
    assert all(1 <= n <= 3 for n in taken.values())


def test_word_counts(spark):
    texts = [None, "", " \t", "a b\n\nc", "é\x0bx\x0c y", "  one"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[1] for r in df.select("i", mixing.words_in(F.col("t"))).orderBy("i").collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


# 2


def test_fingerprint_edits_follow_ids_across_buckets(spark):
    texts = [" ".join(words(random.Random(i).randrange(0, 60), i)) for i in range(50)]
    docs = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in fingerprints.report(docs, bucket_rows=5).collect()}
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        k = len(t) // 4
        assert got[3 * i]["edited_sha256"] == hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()
        assert got[3 * i]["n_chars"] == len(t)


def test_every_row_has_a_successor_whatever_its_id(spark):
    def rows_of(rows, **more):
        got = fingerprints.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **more).collect()
        return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in got)

    def by_hand(rows, order):
        rows = [rows[i] for i in order]
        return sorted((d is None, d or 0, len(t or ""), hashlib.sha256(fingerprints.edited(t or "", rows[(i + 1) % len(rows)][1] or "").encode()).hexdigest()) for i, (d, t) in enumerate(rows))

    two = [(None, "abcd efgh"), (None, "the quick brown fox")]
    assert rows_of(two) in (by_hand(two, [0, 1]), by_hand(two, [1, 0]))
    mixed = [(5, "five is here now"), (None, "nobody knows the id"), (-3, "minus three comes first"), (5, "five is here now"), (9, None)]
    assert rows_of(mixed, bucket_rows=1) == by_hand(mixed, [2, 0, 3, 4, 1])
    assert rows_of([(1, "alone in the table")]) == by_hand([(1, "alone in the table")], [0])
    many = [(None, " ".join(words(9, i))) for i in range(40)]
    assert len(rows_of(many, bucket_rows=4)) == 40


def test_likeness_estimates_the_share_of_phrases():
    import numpy as np

    texts = [" ".join(words(300, 5, 2000)), " ".join(words(300, 5, 2000)[:200] + words(100, 6, 2000)), " ".join(words(300, 7, 2000)), "", "ab"]
    names = []
    for t in texts:
        owners, parts = fingerprints.phrases(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        names.append(set(np.concatenate(parts).tolist()) if parts else set())
    sketch = fingerprints.sketches(pa.array(texts))
    for i in range(len(texts)):
        assert sketch[i].tolist() == sorted(names[i])[: fingerprints.KEEP]
        for j in range(len(texts)):
            exact = len(names[i] & names[j]) / len(names[i] | names[j]) if names[i] | names[j] else 1.0
            assert abs(fingerprints.likeness(sketch[i], sketch[j]) - exact) < 0.2


def test_phrases_do_not_depend_on_offset():
    import numpy as np

    shared = " ".join(words(400, 9, 3000))
    a, b = ("x y z " + shared).encode(), ("quite another beginning here " + shared).encode()
    names = []
    for t in (a, b):
        owners, parts = fingerprints.phrases(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        names.append(set(np.concatenate(parts).tolist()))
    assert len(names[0] & names[1]) > 0.85 * len(names[0])


def test_batches_do_not_change_a_fingerprint():
    texts = [" ".join(words(n, n)) for n in (0, 1, 2, 50, 900)] + ["aaaa" * 500, "é" * 9]
    together = fingerprints.sketches(pa.array(texts))
    for t, s in zip(texts, together, strict=True):
        assert fingerprints.sketches(pa.array(["zz", t]))[1].tolist() == s.tolist()
    assert fingerprints.likeness(together[4], together[4]) == 1.0 and fingerprints.likeness(together[0], together[4]) == 0.0


# 3


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    got = language.report(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["n_chars"] > 60]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_unknown(spark):
    rows = [(i, f"{' '.join(words(20, i))} the and of", "en", None, 0) for i in range(9)] + [(50, "123 !!", None, None, 0), (51, None, "en", None, 0)]
    rows += [(52, "½ ²", None, None, 0), (53, "③ ④", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r["lang_pred"] for r in language.report(docs).collect()}
    assert got[50] == got[51] == got[52] == got[53] == "und" and got[0] == "en"
    assert {r["doc_id"] for r in language.accepted(docs.withColumn("rejected", F.lit("x"))).collect()} <= set(range(9))


def test_language_ties_go_to_the_first_and_are_rejected(spark):
    dicts = {"b": b"one two three four", "a": b"one two three four"}
    long = "one two three four " * 60_000
    df = spark.createDataFrame([(1, "one two"), (2, long)], "i int, t string").select("i", language.predicted(F.col("t"), dicts).alias("p"))
    for r in df.collect():
        assert (r["p"]["lang"], r["p"]["rejected"], r["p"]["score"]) == ("a", True, 0.5)


# 4


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng.choice([0, 1, 3, 10, 25]), 100 + i, 30))) for i in range(12)] + [(77, None), (None, " ".join(words(11, 900, 30))), (None, " ".join(words(12, 901, 30)))]
    docs = []
    for i in range(60):
        text = words(rng.randrange(0, 60), i, 30)
        if i % 3 == 0:
            text[5:5] = items[rng.randrange(12) if i % 9 else rng.choice([13, 14])][1].upper().split()
        docs.append((i, rng.choice([" ", ", ", "-"]).join(text) if i % 11 else None))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(decontaminate.brute_force(docs, items))
    assert sorted(map(tuple, decontaminate.report(d, b).collect())) == want
    many = decontaminate.contamination(d, b, block_windows=7).select("doc_id", decontaminate.n_hit(), F.size("items"))
    assert sorted(map(tuple, many.collect())) == [(r[0], r[2], r[3]) for r in want]
    clashing = d.withColumns({"spans": F.lit(1), "c0": F.lit(2), "row": F.create_map(F.lit(1), F.lit("m"))}).unionAll(d.withColumns({"spans": F.lit(1), "c0": F.lit(2), "row": F.create_map(F.lit(1), F.lit("m"))}))
    for block in (7, decontaminate.BLOCK_WINDOWS):
        kept = decontaminate.clean(clashing, b, block_windows=block)
        assert kept.columns == clashing.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(2 * [r[0] for r in want if not r[5]])
        cut = decontaminate.remove_spans(d, b, block_windows=block)
        assert {r["doc_id"]: r["n_words"] for r in decontaminate.report(cut, b).collect()} == {r[0]: r[1] - r[2] for r in want}


def test_decontamination_sql_counts_items_without_id(spark, tmp_path):
    from canvass.llm import queries

    from ..oracle import difference

    text = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, f"x {text} y"), (2, "nothing here"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, text), (None, "nothing"), (4, text), (5, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for t in ("documents", "benchmark"):
        part = next((tmp_path / f"{t}.parquet").glob("part-*.parquet"))
        spark.read.parquet(f"{tmp_path}/{t}.parquet").coalesce(1).toPandas().to_parquet(tmp_path / f"one-{t}.parquet")
        assert part
    folder = tmp_path / "whole"
    folder.mkdir()
    for t in ("documents", "benchmark"):
        (tmp_path / f"one-{t}.parquet").rename(folder / f"{t}.parquet")
    assert difference(spark, queries.op4_decontaminate, queries.ORACLE_SQL["op4_decontaminate"], str(folder)) == ""


# 5


def classes_by_hand(rows, k=5, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def near_copies(seed, groups=12, pool=300):
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = words(rng.randrange(3, 120), 1000 * seed + g, pool)
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(50)}"
            rows.append((i, " ".join(own).upper() if rng.random() < 0.3 else "\t".join(own)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "a b"), (i + 3, "A  B")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    assert sorted(map(tuple, neardup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == classes_by_hand(rows)


def test_jaccard_join_with_small_tiles_and_common_shingles(spark, monkeypatch):
    for name, value in (("TILE", 4), ("TILE_SHINGLES", 300), ("COMMON", 3), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(neardup, name, value)
    rows = near_copies(7, groups=8)
    assert sorted(map(tuple, neardup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == classes_by_hand(rows)


def test_one_of_each_group_stays(spark):
    rows = near_copies(5, groups=6)
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, n string")
    got = neardup.kept(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted({c for _, n, c in classes_by_hand(rows)})


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b, c, near = (" ".join(words(60, seed, 5000)) for seed in (71, 72, 73, 74))
    rows = [(1, a, "x"), (1, a, "x"), (2, near, "x"), (None, near + " more", "y"), (None, b, "x"), (None, b, "x"), (3, a, "x"), (3, c, "x"), (4, "", "x"), (4, "", "x"), (4, None, "x"), (5, "", "x"), (None, "", "x"), (None, "", "x")]
    want = [(1, a, "x"), (2, near, "x"), (None, b, "x"), (3, c, "x"), (4, "", "x"), (4, None, "x"), (5, "", "x"), (None, "", "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(5)
    got = neardup.kept(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_bound_never_falls_below_the_overlap():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (3, 40, 900, 9000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(0.85 * n)], rng.integers(0, 2**63, n // 4).astype(np.uint64)]))
        p, q = neardup._counts(neardup._point(a)), neardup._counts(neardup._point(b))
        g = min(len(p), len(q))
        assert np.minimum(neardup._folded(p, g), neardup._folded(q, g)).sum() >= len(np.intersect1d(a, b))


# 6


def test_licences_equal_exact_search(spark):
    rng = random.Random(6)
    names = sorted(licenses.TEMPLATES)
    docs, want = [], {}
    for i in range(60):
        text = words(rng.randrange(0, 200), i, 50)
        hidden = rng.sample(names, rng.randrange(0, 3))
        for n in hidden:
            place = rng.randrange(len(text) + 1)
            text[place:place] = ["\n", licenses.TEMPLATES[n].upper() if i % 2 else licenses.TEMPLATES[n], "\n"]
        docs.append((i, " ".join(text)))
        flat = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", docs[-1][1].lower()))
        want[i] = {n for n in names if f" {' '.join(re.findall(r'[a-z0-9]+', licenses.TEMPLATES[n].lower()))} " in f" {flat} "}
    got = {r["doc_id"]: set(filter(None, r["licences"].split("|"))) for r in licenses.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(want[i] <= got[i] for i in want)
    # A licence with one clause more or less may be contained, too; nothing else is found.
    kin = {"BSD-2-Clause-full", "BSD-3-Clause-full"}
    assert all(got[i] - want[i] <= (kin if want[i] & kin else set()) for i in want)


def test_damaged_licences_are_found_and_fragments_are_not(spark):
    text = licenses.TEMPLATES["BSD-3-Clause-full"].split()
    damaged = [w if i % 60 else "changed" for i, w in enumerate(text)]
    docs = [(1, " ".join(words(500, 1) + damaged + words(300, 2))), (2, " ".join(text[: len(text) // 2])), (None, " ".join(text)), (None, " ".join(text)), (3, None), (4, "")]
    got = licenses.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = sorted((r["doc_id"] or 0, "BSD-3-Clause-full" in r["licences"].split("|")) for r in got)
    assert found == [(0, True), (0, True), (1, True), (2, False), (3, False), (4, False)]
    assert [len(tables) for *_, tables in licenses.Matcher(licenses.TEMPLATES).plans][-1] > 100


def test_bands_guarantee_their_probability():
    for s, r in ((0.3, 1), (0.5, 2), (0.8, 3)):
        b = licenses.bands_for(s, r)
        assert 1 - (1 - s**r) ** b >= licenses.PROBABILITY > 1 - (1 - s**r) ** (b - 1)


# 7


def test_grammar_factors():
    m = toxicity.compose(toxicity.insult(), toxicity.threat(), toxicity.target(), toxicity.negation(), toxicity.reported())
    O, I, T, G, N, R = range(6)
    run = lambda symbols: round(toxicity.clause_score(m, symbols, [2.0 if s in (I, T) else 0.0 for s in symbols]), 6)
    assert run([O, I, O]) == 2.0
    assert run([G, I]) == 2.4
    assert run([N, O, I]) == 0.8 and run([N, O, O, O, I]) == 2.0
    assert run([R, I]) == 1.2
    assert run([T]) == 0.0 and run([G, T]) == 2.4


def test_threat_counts_before_and_after_its_target():
    m = toxicity.compose(toxicity.insult(), toxicity.threat(), toxicity.target(), toxicity.negation(), toxicity.reported())
    O, I, T, G, N, R = range(6)
    run = lambda symbols: round(toxicity.clause_score(m, symbols, [2.0 if s in (I, T) else 0.0 for s in symbols]), 6)
    assert run([O, O, T, G]) == run([G, T]) == 2.4
    assert run([N, T, G]) == 0.96 and run([T, I]) == 2.0 and run([T, I, G]) == 4.8
    f = toxicity.Grammar({}).features(pa.array(["I will kill you", "you, I will kill", "I will kill. You know", "a fine day"]))
    assert f[0, 0] == f[1, 0] > 0 and not f[2:].any()


def toxic_sentences(seed, n=600):
    """Insults are toxic unless they are negated or reported; the words between are the same."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        filler, kind, bad = words(12, 1000 * seed + i, 60), i % 20, rng.choice(["moronic", "idiotic", "scummy"])
        clause = ["you", "are", bad] if kind < 3 else ["they", "are", bad, bad] if kind < 6 else {6: ["you", "are", "not", bad], 7: ["he", "said", bad]}.get(kind, [("you", "they")[kind % 2], "are", *filler[:2]])
        rows.append((i, " ".join([*filler[:6], ".", *clause, ".", *filler[6:]]), int(kind < 6)))
    return rows


def test_factors_are_learned_and_each_transducer_counts(spark):
    import numpy as np

    train = spark.createDataFrame(toxic_sentences(1), "doc_id long, text string, y int")
    grammar, link = toxicity.fitted(train)
    assert grammar.factors["negation"] < toxicity.PRIORS["negation"] and grammar.factors["reported"] < toxicity.PRIORS["reported"]
    held = toxic_sentences(2)
    texts, y = pa.array([t for _, t, _ in held]), np.array([v for *_, v in held])

    def loss(factors):
        other = toxicity.Grammar({})
        other.__dict__.update(grammar.__dict__)
        other.set_factors(factors)
        f = other.features(texts)
        w = np.array(toxicity.logistic(f, y.astype(float)))
        p = np.clip(1 / (1 + np.exp(-(f @ w[:-1] + w[-1]))), 1e-9, 1 - 1e-9)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    own = loss(grammar.factors)
    for name in ("negation", "reported"):
        assert loss(grammar.factors | {name: 1.0}) > own + 0.02
    base = toxicity.Grammar({"moronic": 2.0})
    for name, text in (("negation", "you are not moronic"), ("reported", "he said moronic"), ("target", "you moronic"), ("again", "moronic moronic"), ("threat", "kill you")):
        changed = toxicity.Grammar({"moronic": 2.0}, toxicity.PRIORS | {name: toxicity.PRIORS[name] / 2})
        assert base.features(pa.array([text]))[0, 0] != changed.features(pa.array([text]))[0, 0]


def test_scores_by_brute_force_and_clashing_columns(spark):
    rows = toxic_sentences(3, 300) + [(900, None, 0), (901, "", 0), (902, "!" * 50_000, 0)]
    docs = spark.createDataFrame([(d, t, "x", 1.0) for d, t, _ in rows], "doc_id long, text string, _score string, score double")
    labels = spark.createDataFrame([(d, y, y) for d, _, y in rows[:300]], "doc_id long, quality int, toxic int")
    grammar, link = toxicity.fitted(toxicity.training_rows(docs, labels, "toxic", 5, 0, toxicity.SAMPLE_DOCUMENTS))
    for r in toxicity.report(docs, labels).collect():
        text = next(t for d, t, _ in rows if d == r["doc_id"]) or ""
        total = most = 0.0
        for clause in re.split(r"[.!?;:\n]", text.lower()):
            own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", clause)
            listed = [(toxicity.INSULT, max((w for k, h, v in grammar.stems for x, w in zip(h, v) if len(c) >= k and int(toxicity._hashes([c[:k]])[0]) == int(x)), default=0.0)) for c in own]
            marks = {w: s for ws, s in ((toxicity.TARGETS, toxicity.TARGET), (toxicity.NEGATIONS, toxicity.NEGATION), (toxicity.REPORTS, toxicity.REPORT), (toxicity.THREATS, toxicity.THREAT)) for w in ws.split()}
            symbols = [s if w else marks.get(c, toxicity.OTHER) for c, (s, w) in zip(own, listed)]
            weights = [grammar.threat_weight if s == toxicity.THREAT else w for s, (_, w) in zip(symbols, listed)]
            score = toxicity.clause_score(grammar.machine, symbols, weights) if any(weights) else 0.0
            total, most = total + score, max(most, score)
        n = max(1, len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))
        import math

        z = sum(a * b for a, b in zip([math.log1p(total), math.log1p(100 * total / n), math.log1p(most), math.log1p(total / math.sqrt(n)), 1.0], link))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-6)
        assert r["predicted"] == int(r["score"] >= 0.5)
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_toxicity_held_out(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = [r for r in toxicity.report(docs, labels).join(labels, "doc_id").collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    found = sum(r["toxic"] and r["predicted"] for r in got)
    assert found >= 0.9 * sum(r["toxic"] for r in got)
    assert found >= 0.95 * sum(r["predicted"] for r in got)


# 8

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=1>Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div id=wrap><div class="sidebar"><p>Related words that are long enough to look like text, really long.</p></div>
<article><h1>Head &amp; line</h1><p>First   paragraph with <b>bold</b> and <a href=x>a link</a>,<br>second line.<p>Tiny.
<ul><li>One<li>Two</ul><form><input value=q><button>Send</button></form><p>Last&nbsp;one &lt;here&gt;.</p></article>
<section class="comments"><p>A reader says something at length about this, as readers do.</p></section></div><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert pages.main_text(PAGE) == "Head & line\nFirst paragraph with bold and a link, second line.\nTiny.\nOne\nTwo\nLast one <here>."
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<script>x</script>") == ""


def test_main_text_without_article_element():
    long = "This is a sentence that goes on for a while, as text does, and has few tags. " * 3
    links = "".join(f"<p><a href={i}>go</a></p>" for i in range(12))
    html = f"<body><div>{links}</div><div><p>{long}</p><p>Short.</p><p>{long}</p></div><div>{links}</div></body>"
    assert pages.main_text(html) == "\n".join([long.strip(), "Short.", long.strip()])


LONG = "This is a sentence that goes on for a while, as text does, and has few tags. " * 3


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_main_text_outside_the_innermost_container(outer):
    p, long = f"<p>{LONG}</p>", LONG.strip()
    links = "<div>" + "".join(f"<p><a href={i}>go on</a></p>" for i in range(12)) + "</div>"

    def page(inside):
        return pages.main_text(f"<body>{links}<{outer}>{inside}</{outer}>{links}</body>").split("\n")

    assert page(f"<h1>Heading</h1><div class=body>{p}{p}</div>") == ["Heading", long, long]
    assert page(f"<p>{LONG}lead</p><div>{p * 4}</div><ul><li>One<li>Two</ul>") == [f"{LONG}lead", *[long] * 4, "One", "Two"]
    assert page(f"<section>{p * 6}</section><section>{p * 2}</section>") == [long] * 8


def test_main_text_keeps_what_only_looks_like_boilerplate():
    p, long = f"<p>{LONG}</p>", LONG.strip()
    ad, menu = f'<div class="ad">{LONG}</div>', '<ul class="nav-links"><li><a href=1>Home</a></ul>'
    inside = f'<article><h2 id="side-effects">Effects</h2>{p}<section id="related-work">{p}</section><section id="legal-copyright">{p}</section></article>'
    want = "\n".join(["Effects", long, long, long])
    for page in (
        f"<body>{ad}{inside}</body>",
        f'<body><div class="layout with-sidebar">{menu}{inside}<div class="sidebar">{p}</div></div></body>',
        f"<body><form action=x>{menu}{inside}{ad}</form></body>",
        f"<html><head><title>t</title><body>{menu}{inside}</body>",
        f"<head><meta charset=utf-8><title>t</title>{inside}",
        f'<div class="sidebar">{inside}</div><div class="comments-area"><article>{LONG}</article></div>',
        inside.replace("<article>", '<article><div class="content no-sidebar">').replace("</article>", "</div></article>"),
    ):
        assert pages.main_text(page) == want
    assert pages.main_text(f'<body><form><div class="page with-sidebar">{menu}<h1>Head</h1>{p}{p}</div></form></body>') == "\n".join(["Head", long, long])
    assert pages.main_text(f'<article>{p}<form>Your name</form><div class="social-share">Tell them</div></article><section class="comments-area">{p * 9}</section>') == long
    for name in ("entry-header", "header"):
        assert pages.main_text(f'<body>{menu}<article><div class="{name}"><h1>Head</h1></div>{p}{p}</article></body>') == "\n".join(["Head", long, long])
    assert pages.main_text(f'<body><div class="page has-sidebar">{inside}</div></body>') == want
    assert pages.main_text(f"<nav>{LONG}</nav><footer>{LONG}</footer>") == pages.main_text(f"<p hidden>{LONG}</p>") == ""


@pytest.mark.parametrize("html", ["<b>" * 330_000, "<div>x" * 160_000, "<a " * 330_000, "<b>" * 100_000 + "<p>y" * 100_000, "<!--" * 200_000, "<b>" * 100_000 + "</i>" * 100_000])
def test_main_text_takes_linear_time(html):
    import time

    start = time.process_time()
    pages.main_text(html)
    assert time.process_time() - start < 20


TEMPLATES = [
    "<html><head><title>t</title></head><body><nav>{menu}</nav><main><h1>{h}</h1>{body}</main><footer>{menu}</footer></body></html>",
    "<body><div id=header>{menu}</div><div class='wrap two-col'><div class=sidebar><p>{side}</p></div><article class=post><header><h1>{h}</h1></header><div class=entry-content>{body}</div></article></div><div class=comments><p>{side}</p></div>",
    "<form><div class=menu>{menu}</div><article><h1>{h}</h1><section>{body}</section></article><aside>{side}</aside></form>",
    "<body><div class=cookie-banner>{side}</div><article><h1>{h}</h1>{body}<div class=share>{menu}</div></article><section class=related><p>{side}</p></section></body>",
]


def test_main_text_of_page_templates():
    rng = random.Random(12)
    menu = "<ul>" + "".join(f"<li><a href={i}>Item {i}</a></li>" for i in range(8)) + "</ul>"
    for page in TEMPLATES:
        for _ in range(5):
            blocks = [" ".join(words(rng.randrange(12, 80), rng.random(), 900)) for _ in range(rng.randrange(3, 9))]
            html = page.format(menu=menu, h="A head &amp; more", side="Something at length beside the text. " * 3, body="".join(f"<p>{b}</p>" for b in blocks))
            assert pages.main_text(html) == "\n".join(["A head & more", *blocks]), page


def test_main_text_of_all_pages(spark, sf_dir):
    import html as H

    for r in pages.report(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(H.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


# 9


def test_token_counts_equal_plain_dynamic_programming():
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁ab": -1.0, "abc": -4.0, "c": -6.0, "bc": -2.0, "漢": -3.0}
    counter = tokens.TrieCounter(pieces)

    def plain(word):
        text, best = "▁" + word, [(0.0, 0)]
        for end in range(1, len(text) + 1):
            options = [(best[end - 1][0] + tokens.UNKNOWN_SCORE, best[end - 1][1] - 1)]
            options += [(best[b][0] + pieces[text[b:end]], best[b][1] - 1) for b in range(end) if text[b:end] in pieces]
            best.append(max(options))
        return -best[-1][1]

    rng = random.Random(9)
    sample = sorted({"".join(rng.choice("abcx漢é") for _ in range(rng.randrange(1, 12))) for _ in range(400)})
    assert counter.count_words(sample).tolist() == [plain(w) for w in sample]


def test_long_words_count_as_short_ones_do(monkeypatch):
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁ab": -1.0, "abc": -4.0, "bc": -2.0}
    rng = random.Random(10)
    sample = sorted({"".join(rng.choice("abcx") for _ in range(rng.randrange(1, 90))) for _ in range(80)})
    counter = tokens.TrieCounter(pieces)
    mixed = counter.count_words(sample).tolist()
    assert mixed == [counter.count_long(w) for w in sample]
    monkeypatch.setattr(tokens, "LONG", 10**9)
    assert counter.count_words(sample).tolist() == mixed
    assert counter.count_long("ab" * 500_000) == 500_000


def test_token_counts_of_all_documents(spark, sf_dir):
    pieces = tokens.vocabulary()
    known: dict = {}

    def plain(word):
        text, best = "▁" + word, [(0.0, 0)]
        for end in range(1, len(text) + 1):
            options = [(best[end - 1][0] + tokens.UNKNOWN_SCORE, best[end - 1][1] - 1)]
            options += [(best[b][0] + pieces[text[b:end]], best[b][1] - 1) for b in range(max(0, end - longest), end) if text[b:end] in pieces]
            best.append(max(options))
        return -best[-1][1]

    longest = max(map(len, pieces))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    off = total = 0
    for r in tokens.report(docs).collect():
        own = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        for w in own:
            if w not in known:
                known[w] = plain(w)
        off += abs(r["n_tokens"] - sum(known[w] for w in own))
        total += r["n_tokens"]
        assert r["n_words"] == len(own)
    # sums of the same scores in another order may differ in their last bit, which can turn a tie
    assert off <= 0.0005 * total


def test_token_counts_of_texts(spark):
    docs = spark.createDataFrame([(1, "hello world hello"), (2, None), (3, "x" * 3000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in tokens.report(docs).collect()}
    assert got[1]["n_words"] == 3 and got[1]["n_tokens"] >= 3 and got[2]["n_tokens"] == 0 and got[3]["n_words"] == 1


# 10


def test_quality_held_out(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = [r for r in quality.report(docs, labels).join(labels, "doc_id").collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    assert sum(r["quality"] == r["predicted"] for r in got) >= 0.95 * len(got)


def test_quality_scores_by_brute_force_and_clashing_columns(spark):
    import numpy as np

    rng = random.Random(21)
    rows = [(i, " ".join(words(rng.randrange(1, 300), i)) + (" !!! ###" * rng.randrange(5, 40) if i % 2 else "."), i % 2) for i in range(80)] + [(900, None, 0), (901, "", 0), (902, "?", 0)]
    docs = spark.createDataFrame([(d, t, "x", 1.0) for d, t, _ in rows], "doc_id long, text string, _score string, attention double")
    labels = spark.createDataFrame([(d, 1 - y, y) for d, _, y in rows[:80]], "doc_id long, quality int, toxic int")
    model = quality.fitted(quality.training_rows(docs, labels, "quality", 4, 2, quality.SAMPLE_DOCUMENTS))
    w = model.w
    for r in quality.report(docs, labels).collect():
        x, _ = quality.encode(pa.array([next(t for d, t, _ in rows if d == r["doc_id"])], pa.string()))
        h = [np.tanh((p - model.mean) / model.scale @ w["E"] + w["e"]) for p in x]
        gate = np.array([(np.tanh(v @ w["V"]) / (1 + np.exp(-(v @ w["U"])))) @ w["a"] for v in h])
        alpha = np.exp(gate - gate.max()) / np.exp(gate - gate.max()).sum()
        z = sum(a * v for a, v in zip(alpha, h)) @ w["c"] + w["b"][0]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
        assert r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    one = labels.where("quality = 1")
    assert {x["score"] for x in quality.report(docs, one).collect()} == {1.0}
    got = quality.scored(docs, model, docs.columns)
    assert got.columns == ["c0", "c1", "c2", "c3", "score", "attention"] and got.count() == docs.count()


def test_attention_gradient():
    import numpy as np

    rng = np.random.default_rng(0)
    x, edges, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = quality.Attention()
    g = model._gradient(x, edges, y)

    def loss():
        p = model._forward(x, edges)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k in model.w:
        at = tuple(0 for _ in model.w[k].shape)
        old = model.w[k][at]
        model.w[k][at] = old + 1e-5
        up = loss()
        model.w[k][at] = old - 1e-5
        down = loss()
        model.w[k][at] = old
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6
