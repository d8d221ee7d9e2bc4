"""Operator 4: find words of documents that lie inside a window of a benchmark item.

The benchmark's windows become a table of hashes, words and items in the shared folder, of which a block of at
most ``block_windows`` windows and BLOCK_BYTES is broadcast, sorted, so that a task looks up all windows of a
run of documents at once; every hit is verified against the window's words.  A larger benchmark is dealt into
blocks by a hash of window and item, so that an item of any size is split and no window is left out; blocks
are built, sent and used one after the other.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import saved
from ._words import LETTERS_DIGITS, Words, in_batches, slices

WINDOW = 10
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 64_000_000

_HITS = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k, h, words, item) of each distinct window of each item, saved: length, hash, words joined by a space."""

    def read(batches):
        for batch in batches:
            for row, _, data, offsets in slices(batch.column("text")):
                words = Words(data, offsets, LETTERS_DIGITS)
                counts = words.counts()
                out: list[tuple] = []
                for k in np.unique(np.minimum(counts[counts > 0], window)).tolist():
                    h, at = words.windows(k)
                    owner = words.of_text(at)
                    own = np.minimum(counts[owner], window) == k
                    out.extend((k, x, words.plain(i, k), row + r) for x, i, r in zip(h[own].view(np.int64).tolist(), at[own].tolist(), owner[own].tolist(), strict=True))
                if out:
                    k, h, plain, rows = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(h, pa.int64()), pa.array(plain, pa.binary()), batch.column("item").take(pa.array(rows))], names=["k", "h", "words", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("text").isNotNull())
    return saved(in_batches(items).mapInArrow(read, "k int, h long, words binary, item string").distinct(), "windows")


class Index:
    """A block of windows as arrays, sorted by length and hash."""

    def __init__(self, block: pa.Table) -> None:
        k, h = block.column("k").to_numpy(), block.column("h").to_numpy().view(np.uint64)
        order = np.lexsort((h, k))
        self.hash, k, block = h[order], k[order], block.take(order).combine_chunks()
        self.words, self.items = (block.column(c).chunk(0) if block.num_rows else pa.array([], pa.string()) for c in ("words", "item"))
        edges = np.flatnonzero(np.diff(k, prepend=-1, append=-1))
        self.lengths = [(int(k[a]), a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def scan(self, words: Words) -> tuple[list[tuple[int, int, int]], dict[int, set[str | None]]]:
        """Verified hits as (text, first word, last word), and the items of each text."""
        spans, items = [], defaultdict(set)
        for k, first, last in self.lengths:
            table = self.hash[first:last]
            h, at = words.windows(k)
            place = np.searchsorted(table, h)
            place[place == len(table)] = 0
            hit = np.flatnonzero(table[place] == h)
            for i, e, key, row in zip(at[hit].tolist(), (place[hit] + first).tolist(), h[hit].tolist(), words.of_text(at[hit]).tolist(), strict=True):
                plain, found = words.plain(i, k), False
                while e < last and self.hash[e] == key:
                    if self.words[e].as_py() == plain:
                        found = True
                        items[row].add(self.items[e].as_py())
                    e += 1
                if found:
                    begin = i - int(words.first[row])
                    spans.append((row, begin, begin + k - 1))
        return spans, items


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [{"first": a, "last": b} for a, b in out]


def _scanner(index, keep: list[str], text: str, only_hits: bool = False):
    def scan(batches):
        for batch in batches:
            counts, spans, items = [], defaultdict(list), defaultdict(set)
            for row, _, data, offsets in slices(batch.column(text)):
                words = Words(data, offsets, LETTERS_DIGITS)
                counts.extend(words.counts().tolist())
                found, owners = index.value.scan(words)
                for r, first, last in found:
                    spans[row + r].append((first, last))
                for r, x in owners.items():
                    items[row + r] |= x
            rows = sorted(spans) if only_hits else range(batch.num_rows)
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            columns = [batch.column(c).take(pa.array(rows, pa.int64())) if only_hits else batch.column(c) for c in keep]
            columns += [pa.array([counts[r] for r in rows], pa.int64()), pa.array([_merged(spans[r]) if r in spans else [] for r in rows], kind), pa.array([_sorted(items[r]) if r in items else [] for r in rows], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "spans", "items"])

    return scan


def _sorted(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda x: (x is None, x))


def contamination(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``documents``: ``keep``, n_words, spans (word places, from 0) and items.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window.  Null or
    empty texts have no words and no hits; items without words or with a null text have no windows.  Items
    without an id hit like others; all of them are one null in ``items``.  An empty benchmark hits nothing.
    Repeated rows each get their own result.  ``keep`` holds no column called as one of the result.
    """
    spark = documents.sparkSession
    own = documents.select(*keep, *[] if text in keep else [text])
    windows = windows_of(benchmark, window)
    size = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("words") + F.length(F.coalesce("item", F.lit("")))), F.lit(0)).alias("bytes")).first()
    blocks = 1 + max(size["n"] // block_windows, size["bytes"] // BLOCK_BYTES)
    if blocks == 1:
        return in_batches(own).mapInArrow(_scanner(spark.sparkContext.broadcast(Index(windows.toArrow())), list(keep), text), _schema(own.select(*keep)))
    # Several blocks: rows get numbers in the shared folder, each block scans the texts, and only its hits are kept.
    row = "row"
    while row in own.columns:
        row = f"_{row}"
    numbered = saved(own.withColumn(row, F.monotonically_increasing_id()), "rows")
    parts = []
    for b in range(blocks):
        sent = spark.sparkContext.broadcast(Index(windows.where(F.pmod(F.xxhash64("h", "item"), F.lit(blocks)) == b).toArrow()))
        rows = numbered.select(row, text)
        parts.append(saved(in_batches(rows).mapInArrow(_scanner(sent, [row], text, only_hits=b > 0), _schema(rows.select(row))), "hits"))
        sent.destroy()
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionAll(part)
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    hits = hits.groupBy(row).agg(F.max("n_words").alias("n_words"), _union_spans(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"), items.alias("items"))
    return numbered.select(*keep, row).join(hits, row).drop(row)


def _schema(keep: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema) + f", {_HITS}"


def _union_spans(spans):
    """Sorted spans joined where they touch."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def add(done, span):
        top = F.element_at(done, -1)
        joined = F.struct(top["first"].alias("first"), F.greatest(top["last"], span["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (span["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, add)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest of :func:`contamination`."""
    found = contamination(documents, benchmark)
    return found.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def _with_spans(documents: DataFrame, benchmark: DataFrame, window: int, block_windows: int) -> DataFrame:
    """``documents`` with its columns called c0, c1, ... and the columns of :func:`contamination`."""
    names = [f"c{i}" for i in range(len(documents.columns))]
    return contamination(documents.toDF(*names), benchmark, window=window, block_windows=block_windows, text=names[documents.columns.index("text")], keep=tuple(names))


def remove_spans(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``documents`` with the words of each hit cut from the text; separators around a cut stay.

    Null texts stay null and empty ones empty; texts of any length are cut whole; hits that overlap or touch are one cut;
    repeated rows are cut alike, rows and items without an id like others; other columns are as they were, whatever they
    are called; no rows give no rows, an empty benchmark cuts nothing.
    """
    place = documents.columns.index("text")
    names = [f"c{i}" for i in range(len(documents.columns))]

    def cut(batches):
        for batch in batches:
            column = batch.column(names[place])
            texts, spans = column.to_pylist(), batch.column("spans").to_pylist()
            for row, _, data, offsets in slices(column):
                words = Words(data, offsets, LETTERS_DIGITS)
                for r in range(len(offsets) - 1):
                    if own := spans[row + r]:
                        raw, at, out = data[offsets[r] : offsets[r + 1]].tobytes(), 0, []
                        for s in own:
                            out.append(raw[at : int(words.start[words.first[r] + s["first"]] - offsets[r])])
                            at = int(words.end[words.first[r] + s["last"]] - offsets[r])
                        texts[row + r] = b"".join([*out, raw[at:]]).decode()
            columns = [pa.array(texts, pa.string()) if i == place else batch.column(c) for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, documents.schema, strict=True))
    return in_batches(_with_spans(documents, benchmark, window, block_windows)).mapInArrow(cut, schema).toDF(*documents.columns)


def clean(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``documents`` in which no benchmark window occurs, with all their columns whatever they are called.

    Null and empty texts stay, repeated rows stay or go together, no rows give no rows, and an empty benchmark
    keeps all.
    """
    found = _with_spans(documents, benchmark, window, block_windows)
    return found.where(F.size("spans") == 0).select(*[f"c{i}" for i in range(len(documents.columns))]).toDF(*documents.columns)


def brute_force(documents: list[tuple], benchmark: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The contract in plain Python, for tests: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    import re

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    out = []
    for doc_id, text in documents:
        own, hit, items = words(text), set(), set()
        for item_id, item in benchmark:
            theirs = words(item)
            k = min(window, len(theirs))
            for i in range(len(theirs) - k + 1 if k else 0):
                for j in range(len(own) - k + 1):
                    if own[j : j + k] == theirs[i : i + k]:
                        hit |= set(range(j, j + k))
                        items.add(item_id if item_id is None else str(item_id))
        out.append((doc_id, len(own), len(hit), len(items), hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest(), bool(hit)))
    return out
