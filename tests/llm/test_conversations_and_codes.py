"""Operators 11, 12 and 13 against plain Python, on small tables with nulls, ties, repeated rows, no rows and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.llm import chat_format, prefix_trie, vector_codes
from canvass.operators import skew

TURNS = "conv_id long, turn long, role string, text string"


def by_conversation(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}


def plain_trie(own, rebuild=True):
    """Rows of the contract from {conv_id: [(role, text), ...]}, node by node."""
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:] if rebuild else turns
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, ids in members.items():
        below, stack = [], [node]
        while stack:
            below.append(stack.pop())
            stack += children[below[-1]]
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        up = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), up, len(ids), len(children[node]), sum(not children[n] for n in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(df):
    assert df.columns == TRIE
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_turns():
    rows = [(1, 2, "user", "b"), (1, None, None, None), (1, 1, "user", "é漢" * 5), (2, 0, "user", "b"), (None, 0, "user", "lost"), (7, 3, "user", "same"), (7, 3, "user", "same"), (7, 3, "assistant", "tie")]
    rows += [(10 + i, t, "user" if t % 2 else "assistant", f"hello {t}") for i in range(12) for t in range(i)]  # copies that end one after another
    rows += [(40, t, "user", "x" * (t % 7)) for t in range(75)] + [(41, t, "user", "x" * (t % 7)) for t in range(60)]  # long, with repeated blocks
    return rows + [(50, 0, "user", "word " * 40_000)]


def test_trie_against_every_node(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert trie_rows(prefix_trie.report(df)) == plain_trie(by_conversation(rows))
    assert trie_rows(prefix_trie.tree(df)) == plain_trie(by_conversation(rows), rebuild=False)


def test_trie_where_names_are_too_many_to_broadcast(spark, monkeypatch):
    rows = odd_turns() + [(100 + i, 0, "user", "hot") for i in range(300)]
    monkeypatch.setattr(prefix_trie, "SMALL_ROWS", 0)
    monkeypatch.setattr(skew, "small", lambda table, most=0: False)
    assert trie_rows(prefix_trie.report(spark.createDataFrame(rows, TURNS).repartition(5))) == plain_trie(by_conversation(rows))


def test_trie_of_random_conversations_and_other_columns(spark):
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["a", "b"])) for c in range(-12, 40) for t in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("n", "name", "_at", "depth", "pos")})
    assert trie_rows(prefix_trie.report(df)) == plain_trie(by_conversation(rows))


def test_trie_without_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.report(empty).collect() == [] and prefix_trie.tree(empty).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1000) if zlib.crc32(str(c).encode()) % 9 and c % 5)  # its base is not there, its only turn goes
    got = prefix_trie.report(spark.createDataFrame([(c, 0, "user", "gone")], TURNS)).collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"], r["ends_sha256"]) for r in got] == [(c, 0, 1, 1, hashlib.sha256(str(c).encode()).hexdigest())]


def test_names_are_dense(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(400)], "i int, v int").repartition(6)
    pairs = {(r["v"], r["name"]) for r in prefix_trie.numbered(df.withColumn("w", F.col("v")), "w").collect()}
    assert sorted(n for _, n in pairs) == list(range(1, 9)) and len(pairs) == 8


# 12


def plain_codes(vectors, entries=64, rounds=2):
    """{position: (code, error)} and codebooks, every distance computed."""
    x = np.array([[int(np.floor(np.float64(np.float32(v)) * 256)) for v in vec] for _, vec in vectors]).reshape(len(vectors), 16, -1)
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, vectors[i][1]))[:entries]
    books = x[order].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2).sum(1)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(16):
            for e in np.unique(code[:, p]):
                own = x[code[:, p] == e, p]
                books[p, e] = own.sum(0) // len(own)
    code, error = nearest()
    return code, error, hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def check_codes(spark, rows):
    got = vector_codes.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    code, error, digest = plain_codes([r[:2] for r in kept])
    total = defaultdict(int)
    for (_, _, label), e in zip(kept, error, strict=True):
        total[label] += int(e)
    want = sorted(((i, bytes(c.astype(np.uint8)).hex(), int(e), total[label], digest) for (i, _, label), c, e in zip(kept, code, error, strict=True)), key=repr)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_codes_against_all_distances(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(9, 32))
    rows = [(i, [float(x) for x in (centres[i % 9] + rng.normal(size=32) * 0.2).astype(np.float32)], None if i % 11 == 0 else i % 3) for i in range(700)]
    rows += [(5, None, 1), (6, [None] * 32, 1), (7, [float("nan")] * 32, 1), (8, [float("inf")] * 32, 1), (None, [0.5] * 32, None)]
    rows += [(1000 + i, rows[0][1], 9) for i in range(300)]  # one very common vector
    check_codes(spark, rows)


def test_codes_with_ties_and_few_vectors(spark):
    rng = np.random.default_rng(13)
    check_codes(spark, [(i, [float(x) for x in rng.integers(-2, 3, 16) / 256], i % 2) for i in range(200)])  # a handful of values: ties everywhere
    check_codes(spark, [(i, [float(i)] * 16, None) for i in range(5)])


def test_codes_without_rows_and_of_other_lengths(spark):
    kind = "vec_id long, embedding array<float>, label int, code string, point string, error string"
    assert vector_codes.report(spark.createDataFrame([], kind)).collect() == []
    assert vector_codes.report(spark.createDataFrame([(1, None, 1, "", "", "")], kind)).collect() == []
    rows = [(1, [1.0] * 20, 1, "", "", ""), (2, [], 1, "", "", ""), (3, [1e30] * 3, 2, "", "", ""), (3, [1e30] * 3, 2, "", "", "")]
    got = {(r["vec_id"], r["code"], r["error"]) for r in vector_codes.report(spark.createDataFrame(rows, kind)).collect()}
    assert {g[0] for g in got} == {1, 2, 3} and all(g[2] == 0 for g in got)  # each is an entry of its own


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 4), st.integers(1, 12), st.booleans())
def test_bounds_lose_no_nearest_entry(seed, width, groups, coarse):
    rng = np.random.default_rng(seed)
    x = rng.integers(-4 if coarse else -500, 5 if coarse else 500, (60, width))
    books = vector_codes.Books.first(x[None, :20].copy(), groups)
    own, bounds = np.zeros(60, int), np.zeros((60, len(books.groups[0])))
    for _ in range(6):
        np.maximum(bounds - books.moved[0] * (1 + 1e-9), 0, out=bounds)
        own, error, computed = vector_codes.assign(x, own, bounds, books.entries[0], books.groups[0])
        distance = ((x[:, None] - books.entries[0][None]) ** 2).sum(2)
        assert (own == distance.argmin(1)).all() and (error == distance.min(1)).all() and computed <= 60 * 21
        bounds = vector_codes._down(bounds).astype(float)
        sums = {(0, int(e)): (int((own == e).sum()), x[own == e].sum(0).tolist()) for e in np.unique(own)}
        books = books.after(sums)


def test_bounds_spare_distances():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(20, 4)) * 4000).astype(int).repeat(50, 0) + rng.integers(-20, 20, (1000, 4))
    books = vector_codes.Books.first(x[None, ::16].copy(), 8)
    bounds = np.zeros((1000, len(books.groups[0])))
    own, _, first = vector_codes.assign(x, np.zeros(1000, int), bounds, books.entries[0], books.groups[0])
    _, _, again = vector_codes.assign(x, own, bounds, books.entries[0], books.groups[0])
    assert again < 0.5 * first


# 13

CONTROLS = [*chat_format.TEMPLATE.controls, "\\", "<", "[", "]", "/s>", "INST]", " ", "\n", "x", "é", "[\\INST]", "<\\\\/s>"]


def plain_chat(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in own.items():
        turns.sort()
        learned = "".join(t for _, _, role, t in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    rng = random.Random(13)
    text = lambda: "".join(rng.choice(CONTROLS) for _ in range(rng.randrange(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "[/TURN] [SAYS] "]), rng.choice([None, text()])) for c in range(80) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "no conversation"), (200, None, "user", "first"), (200, 0, "assistant", "then"), (201, 0, "assistant", "word " * 60_000)]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(0) for c in ("segments", "loss", "_h")}).repartition(4)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.report(df).collect()}
    probe = [(-7, i, role, chat_format.PROBE[1]) for i, role in enumerate(("user", "assistant"))]
    assert got == plain_chat(rows + probe)


def test_texts_hold_no_control_string_and_segments_add_up(spark):
    rng = random.Random(31)
    rows = [(c, 0, "user", "".join(rng.choice(CONTROLS) for _ in range(10))) for c in range(300)]
    made = chat_format.formatted(spark.createDataFrame(rows, TURNS)).collect()
    for r, (_, _, _, text) in zip(sorted(made, key=lambda r: r["conv_id"]), rows, strict=True):
        opened, body, closed = (s["text"] for s in r["segments"])
        assert (opened, closed) == ("[INST] ", " [/INST]") and not any(c in body for c in chat_format.TEMPLATE.controls)
        assert chat_format.TEMPLATE.unescaped(body) == text and [s["loss"] for s in r["segments"]] == [False] * 3


def test_machine_tells_turns_out_of_order(spark):
    chats = {1: ["system", "user", "assistant", "user", "assistant"], 2: ["assistant", "user"], 3: ["user", "system", "assistant"], 4: ["user", "tool", "assistant"], 5: ["user", "user", "assistant"]}
    df = spark.createDataFrame([(c, i, r, "t") for c, roles in chats.items() for i, r in enumerate(roles)], TURNS)
    got = {r["conv_id"]: (r["n_out_of_order"], r["complete"]) for r in chat_format.report(df).collect()}
    assert got == {1: (0, True), 2: (1, False), 3: (2, True), 4: (2, True), 5: (1, True), -7: (0, True)}


def test_chat_without_rows(spark):
    got = chat_format.report(spark.createDataFrame([], TURNS)).collect()
    assert [r["conv_id"] for r in got] == [-7] and got[0]["loss_chars"] == len(chat_format.PROBE[1])


@pytest.mark.parametrize("role", ["user", "assistant", "system", "other", ""])
def test_repeated_rows_are_turns_of_their_own(spark, role):
    got = chat_format.report(spark.createDataFrame([(1, 0, role, "t"), (1, 0, role, "t")], TURNS)).where("conv_id = 1").collect()
    assert got[0]["n_turns"] == 2 and got[0]["loss_chars"] == (2 if role == "assistant" else 0)
