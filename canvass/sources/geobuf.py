"""Properties of features in Geobuf files, by the public geobuf.proto."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Field numbers of the public schema.
KEYS, COLLECTION, FEATURE = 1, 4, 5
FEATURES = 1
FEATURE_ID, FEATURE_INT_ID, VALUES, PROPERTIES = 11, 12, 13, 14
TEXT, REAL, POSITIVE, NEGATIVE, FLAG, JSON = 1, 2, 3, 4, 5, 6


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message: ints for varints, bytes for everything else."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = varint(data, at)
        out.append(value)
    return out


def value_text(data: bytes) -> str | None:
    for number, value in fields(data):
        if number in (TEXT, JSON):
            return value.decode()
        if number == REAL:
            return repr(struct.unpack("<d", value)[0])
        if number in (POSITIVE, NEGATIVE):
            return str(value if number == POSITIVE else -value)
        if number == FLAG:
            return "true" if value else "false"
    return None


def features(data: bytes) -> Iterator[tuple[str | None, dict[str, str | None]]]:
    """(id, properties) of each feature; a property is a pair of places in the tables of keys and values."""
    top = list(fields(data))
    keys = [v.decode() for n, v in top if n == KEYS]
    messages = [v for n, v in top if n == FEATURE] + [f for n, v in top if n == COLLECTION for m, f in fields(v) if m == FEATURES]
    for message in messages:
        own = list(fields(message))
        values = [value_text(v) for n, v in own if n == VALUES]
        pairs = [i for n, v in own if n == PROPERTIES for i in packed(v)]
        ids = [v.decode() if n == FEATURE_ID else str((v >> 1) ^ -(v & 1)) for n, v in own if n in (FEATURE_ID, FEATURE_INT_ID)]
        yield (ids[0] if ids else None), {keys[k]: values[v] for k, v in zip(pairs[::2], pairs[1::2], strict=True)}


def features_of(files: DataFrame) -> DataFrame:
    """path, id, properties of every feature of ``files`` (path, content), decoded on the executors file by file."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(p, i, props) for p, content in zip(frame["path"], frame["content"], strict=True) for i, props in features(bytes(content))]
            yield pd.DataFrame(rows, columns=["path", "id", "properties"])

    return files.select("path", "content").mapInPandas(read, "path string, id string, properties map<string,string>")


def geobuf_features(spark: SparkSession, path: str) -> DataFrame:
    """:func:`features_of` all files of a folder."""
    return features_of(spark.read.format("binaryFile").load(path))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def encoded(rows: list[tuple[str, dict[str, object]]]) -> bytes:
    """A feature collection of (id, properties): texts, whole numbers, flags and other numbers; None is left out."""
    keys: dict[str, int] = {}
    out = []
    for id_, properties in rows:
        values, pairs = [], []
        for key, value in properties.items():
            if value is None:
                continue
            pairs += [keys.setdefault(key, len(keys)), len(values)]
            if isinstance(value, bool):
                values.append(_field(FLAG, int(value)))
            elif isinstance(value, int):
                values.append(_field(POSITIVE if value >= 0 else NEGATIVE, abs(value)))
            elif isinstance(value, float):
                values.append(_varint(REAL << 3 | 1) + struct.pack("<d", value))
            else:
                values.append(_field(TEXT, str(value).encode()))
        feature = _field(FEATURE_ID, id_.encode()) + b"".join(_field(VALUES, v) for v in values)
        out.append(_field(FEATURES, feature + _field(PROPERTIES, b"".join(map(_varint, pairs)))))
    return b"".join(_field(KEYS, k.encode()) for k in keys) + _field(COLLECTION, b"".join(out))
