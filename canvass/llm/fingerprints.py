"""Operator 2: document fingerprints by locally consistent parsing.

A text's bytes are cut into short phrases at places that depend on a few neighbours only: deterministic coin
tossing gives every symbol a label that differs from its left neighbour's, and phrases begin at local maxima
of the labels; runs of one symbol are one symbol first.  Phrases get names (hashes of their symbols), the
names are the next level's text, and so on.  Equal substrings thus share all phrases but those near their
ends, wherever they stand.  A fingerprint is the bottom of the set of phrase names from level ``FROM_LEVEL`` up.
All texts of a batch are parsed at once with numpy.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._words import in_batches, mix, powers, slices

FROM_LEVEL, LEVELS = 1, 9
KEEP = 64
BUCKET_ROWS = 4096
SLICE = 1_000_000
ROWS_AT_ONCE = 1000
MOST_HOT = 10_000
MOST_RANGES = 100_000
_SHIFT = np.uint64(0x9E3779B97F4A7C15)


def _labels(x: np.ndarray, left: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing: twice the place of the lowest bit in which a symbol and its left neighbour differ, plus that bit."""
    differ = x ^ left
    differ[first] = 1  # the first symbol of a text has no neighbour
    lowest = differ & (~differ + np.ones(1, x.dtype))
    place = np.bitwise_count(lowest - np.ones(1, x.dtype))
    bit = (x & lowest) != 0
    return (place * 2 + bit).astype(np.uint8)


def _left(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x[:1], x[:-1]])


def _parse(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of phrases, and the place of each text's first phrase.  No text is empty."""
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    # Runs of a symbol become one symbol that knows its length.
    head = np.flatnonzero(first | (symbols != _left(symbols)))
    length = np.diff(head, append=len(symbols))
    run = symbols[head]
    first = first[head]
    labels = _labels(run, _left(run), first)
    for _ in range(2 if run.dtype == np.uint8 else 3):
        labels = _labels(labels, _left(labels), first)
    names = run + _SHIFT * length.astype(np.uint64)
    # A phrase begins at a local maximum, but no phrase is a single symbol unless its text is.
    begins = np.zeros(len(run), bool)
    begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    begins[:-1] &= ~first[1:]
    begins |= first
    at = np.flatnonzero(begins)
    # The name of a phrase is the polynomial of its symbols, taken from running sums.
    up, down = powers(len(run))
    total = np.zeros(len(run) + 1, np.uint64)
    np.cumsum(names * up[: len(run)], out=total[1:])
    total = total[np.append(at, len(run))]
    name = mix((total[1:] - total[:-1]) * down[at])
    return name, np.searchsorted(at, np.flatnonzero(first))


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By level from FROM_LEVEL up: the texts, and the names of their phrases, each text's in order of place."""
    rows = np.flatnonzero(np.diff(offsets) > 0)
    owners, names = [], []
    symbols, starts = data, offsets[:-1][rows]
    for level in range(1, LEVELS + 1):
        if not len(starts):
            break
        symbols, starts = _parse(symbols, starts)
        counts = np.diff(starts, append=len(symbols))
        owner = np.repeat(rows, counts)
        if level >= FROM_LEVEL:
            owners.append(owner)
            names.append(mix(symbols + np.uint64(level)))
            deeper = counts > 1
        else:
            deeper = np.ones(len(counts), bool)
        if not deeper.all():  # a text that has become one phrase is done
            symbols, rows, counts = symbols[np.repeat(deeper, counts)], rows[deeper], counts[deeper]
        starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return owners, names


def bottoms(data: np.ndarray, offsets: np.ndarray, keep: int) -> list[np.ndarray]:
    """The ``keep`` smallest distinct phrase names of each text, in order."""
    texts = len(offsets) - 1
    owners, names = phrases(data, offsets)
    if not owners:
        return [np.zeros(0, np.uint64)] * texts
    owner, name = np.concatenate(owners), np.concatenate(names)
    counts = np.bincount(owner, minlength=texts)
    # Names are uniform, so nearly always the smallest are under this bound; where not, all of the text's are sorted.
    bound = (np.minimum(1.0, 2.0 * keep / np.maximum(counts, 1)) * (2.0**64 - 2048)).astype(np.uint64)
    low = (name <= bound[owner]) | (counts[owner] <= 2 * keep)
    out, cuts = _distinct(owner[low], name[low], texts)
    sketch = [out[x : min(y, x + keep)] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    short = np.flatnonzero((np.diff(cuts) < keep) & (counts > 2 * keep))
    if len(short):
        again = np.isin(owner, short)
        out, cuts = _distinct(owner[again], name[again], texts)
        for r in short.tolist():
            sketch[r] = out[cuts[r] : min(cuts[r + 1], cuts[r] + keep)]
    return sketch


def _distinct(owner: np.ndarray, name: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    new = np.ones(len(name), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
    owner, name = owner[new], name[new]
    return name, np.searchsorted(owner, np.arange(texts + 1))


def sketches(column: pa.Array) -> list[np.ndarray]:
    """The KEEP smallest phrase names of each text, in order."""
    return [s for _, _, data, offsets in slices(column, SLICE) for s in bottoms(data, offsets, KEEP)]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the phrase sets behind two sketches; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    whole = np.union1d(a, b)
    if len(a) == KEEP or len(b) == KEEP:
        whole = whole[:KEEP]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, whole, assume_unique=True).sum() / len(whole))


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex of the sketch; '' for null and empty texts) of every row."""

    def read(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([written(s) for s in sketches(batch.column("text"))], pa.string())], names=["doc_id", "fingerprint"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return in_batches(documents.select("doc_id", "text")).mapInArrow(read, f"doc_id {kind}, fingerprint string")


def _text():
    return F.coalesce("text", F.lit(""))


def _hot(documents: DataFrame, bucket_rows: int) -> list[int]:
    """Ids that more than ``bucket_rows`` rows have, the most frequent ``MOST_HOT`` of them."""
    counts = documents.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
    return [r["id"] for r in counts.orderBy(F.desc("n"), "id").limit(MOST_HOT).collect()]


def _hash(hot: list[int]):
    """The hash that places a row among those of its id: of its text for rows without an id and for hot ids, else null."""
    spread = F.col("doc_id").isNull() | F.col("doc_id").cast("long").isin(hot) if hot else F.col("doc_id").isNull()
    return F.when(spread, F.xxhash64(_text()))


def _heads(documents: DataFrame, bucket_rows: int, hot: list[int]) -> list[tuple[bool, int, int]]:
    """The first place of each range of about ``bucket_rows`` rows, in order: three numbers for each range.

    A place is (no id, id, 0), with the hash of the text where rows are placed by it: those of hot ids, and
    (no id, 0, hash) those without an id, which stand last.  Only the texts of such rows are read here.
    """
    ids = documents.where("doc_id is not null").select(F.lit(False).alias("none"), F.col("doc_id").cast("long").alias("id"), F.coalesce(_hash(hot), F.lit(0)).alias("hash"))
    others = documents.where("doc_id is null").select(F.lit(True).alias("none"), F.lit(0).cast("long").alias("id"), F.xxhash64(_text()).alias("hash"))
    found = []
    for rows in (ids, others):
        ranges = min(MOST_RANGES, 1 + rows.count() // bucket_rows)
        dealt = rows.repartitionByRange(ranges, "none", "id", "hash").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("none", "id", "hash")).alias("head"))
        found += [tuple(r["head"]) for r in dealt.select("head").collect()]
    return sorted(found)


def _in_order(documents: DataFrame, bucket_rows: int) -> DataFrame:
    """(bucket, doc_id, text, tail), in order of doc_id in each bucket, a bucket in each partition.

    Buckets are ranges of ids; each ends in a copy (tail) of the row that follows it, the last in the first
    row of all, so every row finds its successor without a global sort.  Rows without an id stand last, by a
    hash of their texts, and so do rows of an id that more than a bucket has among themselves: no id makes a task of its own.
    """
    hot = _hot(documents, bucket_rows)
    found = _heads(documents, bucket_rows, hot)
    heads = documents.sparkSession.sparkContext.broadcast(found)

    def deal(batches):
        cuts = heads.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            places = [(True, 0, h) if i is None else (False, i, h or 0) for i, h in zip(ids, batch.column("hash").to_pylist(), strict=True)]
            bucket = np.array([max(bisect_right(cuts, p) - 1, 0) for p in places], np.int64)
            first = np.array([cuts[b] == p for b, p in zip(bucket.tolist(), places, strict=True)], bool)
            for own, number, tail in ((np.ones(len(ids), bool), bucket, False), (first, (bucket - 1) % max(1, len(cuts)), True)):
                part = batch.filter(pa.array(own))
                yield pa.RecordBatch.from_arrays([pa.array(number[own], pa.int64()), *part.columns, pa.array([tail] * part.num_rows, pa.bool_())], names=["bucket", "doc_id", "text", "hash", "tail"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"), _hash(hot).alias("hash"))
    placed = in_batches(rows).mapInArrow(deal, "bucket long, doc_id long, text string, hash long, tail boolean")
    order = ["bucket", "tail", F.col("doc_id").asc_nulls_last(), F.col("hash"), F.col("text")]
    return placed.repartitionById(max(1, len(found)), F.col("bucket").cast("int")).sortWithinPartitions(*order).drop("hash")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many, or all, of the text that follows."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _compare(batches):
    held = None  # the last row so far: its successor comes with the next batch
    for batch in (whole.slice(i, ROWS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, ROWS_AT_ONCE)):
        table = pa.Table.from_batches([batch] if held is None else [held, batch])
        held = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0]
        own = table.column("text")
        texts, bucket, tail = own.to_pylist(), table.column("bucket").to_numpy(), table.column("tail").to_numpy(zero_copy_only=False)
        rows = [i for i in range(len(texts) - 1) if not tail[i] and bucket[i] == bucket[i + 1]]
        if not rows:
            continue
        changed = pa.array([edited(texts[i], texts[i + 1]) for i in rows], pa.string())
        before, after = sketches(own), sketches(changed)
        yield pa.RecordBatch.from_arrays([
            table.column("doc_id").combine_chunks().take(pa.array(rows)),
            pc.utf8_length(own.combine_chunks().take(pa.array(rows))).cast(pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed.to_pylist()]),
            pa.array([written(before[i]) for i in rows]),
            pa.array([written(s) for s in after]),
            pa.array([likeness(before[i], s) for i, s in zip(rows, after, strict=True)], pa.float64()),
            pa.array([likeness(before[i], before[i + 1]) for i in rows], pa.float64()),
        ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def report(documents: DataFrame, *, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The contract's rows, one for each row of ``documents``; no rows give no rows.

    Null texts count as empty; rows with one id stand in order of their texts (where more than ``bucket_rows`` rows have
    it, in order of a hash of them), rows without an id last, in an order that depends on their texts alone.  A single
    row follows itself.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _in_order(documents, bucket_rows).mapInArrow(_compare, schema)
