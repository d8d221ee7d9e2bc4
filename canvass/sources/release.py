"""Release sinks: deterministic exports and manifests by content."""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir


def csv_lines(df: DataFrame) -> Column:
    """Each row as one line of CSV: minimal quoting, blank for null."""

    def cell(c: str) -> Column:
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(",", *[cell(c) for c in df.columns])


def write_csv(df: DataFrame, order: list[str], folder: str, parts: int = 1, bom: bool = True) -> None:
    """A folder of ``parts`` CSV files that follow one another in ``order``, each with a header: written by Spark.

    Blank stands for null, quotes are doubled, lines end in a line break, and with ``bom`` a file begins with
    a byte order mark.  The rows of all files together are the same on every run.
    """
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    names = [("\ufeff" if bom and i == 0 else "") + c for i, c in enumerate(df.columns)]
    texts = dealt.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).toDF(*names)
    texts.write.mode("overwrite").options(header=True, quote='"', escape='"', lineSep="\n", emptyValue="", encoding="UTF-8").csv(folder)


def _parts(lines: DataFrame, order: list[str], parts: int | None) -> tuple[str, int]:
    """Folder of text files that follow one another in ``order``, written and sorted by executors, and their number of lines."""
    spark = lines.sparkSession
    folder, seen = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}", Observation()
    keys = [*order, "line"]  # the line itself settles ties, so any dealing gives the same bytes
    dealt = lines.repartitionByRange(parts, *keys) if parts else lines.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).select("line").observe(seen, F.count("*").alias("n")).write.option("lineSep", "\n").text(folder)
    return folder, seen.get["n"]


def _store(place: str):
    """The store of a URI and the place in it; called on executors.  Characters that a URI may not hold are escaped."""
    from pyarrow import fs as stores

    return stores.FileSystem.from_uri(quote(place, safe=":/%"))


def _stitched(spark: SparkSession, pieces: list[tuple[str, bytes | str]], path: str, between: bytes | None = None) -> dict[str, object]:
    """Write ``path`` from pieces, each ("bytes", b) or ("file", place) or ("folder", place), in order; a task streams them.

    ``between`` replaces the line end between the lines of a folder, the last one having none.  The driver gets the size and the hash.  A
    task that runs again writes the file anew.
    """

    def copy(batches):
        for _ in batches:  # a row that only starts the task
            pass
        from pyarrow import fs as stores

        def chunks():
            for kind, piece in pieces:
                if kind == "bytes":
                    yield piece
                    continue
                store, at = _store(piece)
                names = [at] if kind == "file" else sorted(f.path for f in store.get_file_info(stores.FileSelector(at)) if f.path.rsplit("/", 1)[-1].startswith("part-"))
                held = b""  # a line end that waits for the next line
                for name in names:
                    with store.open_input_stream(name) as stream:
                        while data := stream.read(1 << 20):
                            if kind == "folder" and between is not None:
                                data = held + data
                                held = b"\n" if data.endswith(b"\n") else b""
                                data = data[: len(data) - len(held)].replace(b"\n", between)
                            yield data

        digest, size = hashlib.sha256(), 0
        store, at = _store(path)
        store.create_dir(at.rsplit("/", 1)[0])
        with store.open_output_stream(at) as out:
            for data in chunks():
                digest.update(data)
                size += len(data)
                out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([digest.hexdigest()])], names=["bytes", "sha256"])

    row = spark.range(1, numPartitions=1).mapInArrow(copy, "bytes long, sha256 string").first()
    return {"path": path.rsplit("/", 1)[-1], "bytes": row["bytes"], "sha256": row["sha256"]}


def export_csv(df: DataFrame, order: list[str], path: str, bom: bool = True, parts: int | None = None) -> dict[str, object]:
    """One sorted CSV file at a URI, byte for byte the same on every run and for any number of ``parts``; its manifest entry.

    Executors sort and write the lines; one task joins the files.  Blank stands for null, quotes are minimal, lines end
    in a line break.
    """
    lines = df.select(*[F.col(f"`{c}`") for c in order], csv_lines(df).alias("line"))
    folder, rows = _parts(lines, order, parts)
    head = (b"\xef\xbb\xbf" if bom else b"") + (",".join(df.columns) + "\n").encode()
    entry = _stitched(df.sparkSession, [("bytes", head), ("folder", folder)], path)
    _delete(df.sparkSession, folder)
    return entry | {"rows": rows}


def export_json(df: DataFrame, order: list[str], path: str, parts: int | None = None) -> dict[str, object]:
    """A JSON array of the rows at a URI, a record a line, fields in order of name; its manifest entry.  As :func:`export_csv`."""
    lines = df.select(*[F.col(f"`{c}`") for c in order], F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])).alias("line"))
    folder, rows = _parts(lines, order, parts)
    entry = _stitched(df.sparkSession, [("bytes", b"[\n"), ("folder", folder), ("bytes", b"\n]\n" if rows else b"]\n")], path, b",\n")
    _delete(df.sparkSession, folder)
    return entry | {"rows": rows}


def _delete(spark: SparkSession, folder: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def feature_json(properties: Column, kind: Column, coordinates: Column) -> Column:
    """A GeoJSON feature as text."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(kind.alias("type"), coordinates.alias("coordinates")).alias("geometry")))


# The zip format; every entry dates from 1 January 1980 and may be read by all (mode 0644).
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_DATE, _MODE, _UTF8, _DEFLATED, _MOST = 0x21, 0o644 << 16, 0x800, 8, 0xFFFFFFFF


def stable_zip(spark: SparkSession, files: list[str], path: str) -> dict[str, object]:
    """A zip at a URI of the files at URIs: names sorted, times and modes fixed, so the same files give the same bytes.

    Executors compress a file each; the directory is made of the sizes and checksums that they report, and one task joins
    the pieces.  Entries and archive must stay under 4 GB, and names apart.
    """
    folder = f"{shared_dir(spark)}/zip-{uuid.uuid4().hex}"
    names = sorted((f.rsplit("/", 1)[-1], f) for f in files)
    if len({n for n, _ in names}) < len(names):
        raise ValueError("two files of one name")

    def pack(batches):
        for batch in batches:
            out = []
            for place, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (store, at), (shared, piece) = _store(file), _store(f"{folder}/{place:08d}")
                squeeze, crc, size, packed = zlib.compressobj(9, zlib.DEFLATED, -15), 0, 0, 0
                shared.create_dir(piece.rsplit("/", 1)[0])
                with store.open_input_stream(at) as stream, shared.open_output_stream(piece) as to:
                    while data := stream.read(1 << 20):
                        crc, size = zlib.crc32(data, crc), size + len(data)
                        packed += to.write(squeeze.compress(data))
                    packed += to.write(squeeze.flush())
                out.append((place, crc, size, packed))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["place", "crc", "size", "packed"])

    jobs = spark.createDataFrame([(i, f) for i, (_, f) in enumerate(names)], "place long, file string").repartition(max(1, len(names)))
    made = {r["place"]: r for r in jobs.mapInArrow(pack, "place long, crc long, size long, packed long").collect()}
    pieces: list[tuple[str, bytes | str]] = []
    directory, at = b"", 0
    for place, (name, _) in enumerate(names):
        r, raw = made[place], name.encode()
        if max(r["size"], r["packed"], at) > _MOST:
            raise ValueError(f"{name} does not fit a zip of this kind")
        common = struct.pack("<HHHHHIIIHH", 20, _UTF8, _DEFLATED, 0, _DATE, r["crc"], r["packed"], r["size"], len(raw), 0)
        pieces += [("bytes", _LOCAL + common + raw), ("file", f"{folder}/{place:08d}")]
        directory += _CENTRAL + struct.pack("<H", 3 << 8 | 20) + common + struct.pack("<HHHII", 0, 0, 0, _MODE, at) + raw
        at += len(_LOCAL + common + raw) + r["packed"]
    pieces.append(("bytes", directory + _END + struct.pack("<HHHHIIH", 0, 0, len(names), len(names), len(directory), at, 0)))
    entry = _stitched(spark, pieces, path)
    _delete(spark, folder)
    return entry


def _lines(content: Column) -> Column:
    """Line ends of a file, byte by byte (a byte is a character of ISO 8859-1)."""
    text = F.decode(content, "ISO-8859-1")
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long")


def manifest(spark: SparkSession, folder: str, magic: bytes | None = None) -> DataFrame:
    """path (below ``folder``), category (its first folder), bytes, lines, sha256 of every file, read by the executors.

    With ``magic`` also whether a file begins with these bytes.  Files are read whole, so each must stay under
    the 2 GB of a binary value; that is what a release's assets are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    place = F.regexp_replace("path", r"^.*" + folder.rstrip("/").split("/")[-1].replace(".", r"\.") + "/", "")
    category = F.when(place.contains("/"), F.substring_index(place, "/", 1)).otherwise("")
    found = files.select(place.alias("path"), category.alias("category"), F.col("length").alias("bytes"), _lines(F.col("content")).alias("lines"), F.sha2("content", 256).alias("sha256"), F.substring("content", 1, len(magic or b"")).alias("_head"))
    return (found if magic is None else found.withColumn("right_kind", F.col("_head") == F.lit(magic))).drop("_head")


def build_id(assets: DataFrame, path: str, sha: str) -> DataFrame:
    """The first 16 hex digits over all (path, hash) pairs in order of path: one small row an asset."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), F.col(sha).alias("s"))))
    text = F.array_join(F.transform(pairs, lambda x: F.concat(x["p"], F.lit(":"), x["s"])), "\n")
    return assets.agg(F.substring(F.sha2(text, 256), 1, 16).alias("build_id"), F.count("*").alias("n_assets"))


def unzipped(archives: DataFrame) -> DataFrame:
    """path, name, content of each file in ``archives`` (path, content), unpacked by executors; folders are left out."""

    def read(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as packed:
                    for entry in packed.infolist():
                        if not entry.is_dir():
                            yield pd.DataFrame({"path": [path], "name": [entry.filename], "content": [packed.read(entry)]})

    return archives.select("path", "content").mapInPandas(read, "path string, name string, content binary")


def extracted(spark: SparkSession, archives: str, folder: str) -> str:
    """``folder``, into which executors unpack the files of ``archives`` unless it is whole already, as its _SUCCESS tells."""
    done = f"{folder.rstrip('/')}/_SUCCESS"
    at = spark._jvm.org.apache.hadoop.fs.Path(done)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at):
        return folder

    def put(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, content in zip(names, batch.column(1).to_pylist(), strict=True):
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"{name} leads out of the folder")
                store, to = _store(f"{folder.rstrip('/')}/{name}")
                store.create_dir(to.rsplit("/", 1)[0])
                with store.open_output_stream(to) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    unzipped(spark.read.format("binaryFile").load(archives)).select("name", "content").mapInArrow(put, "name string").count()
    fs.create(at, True).close()
    return folder


def feature_collection(features: DataFrame, keys: list[str], feature: str) -> DataFrame:
    """keys, json: a GeoJSON document of the features of each group, in order of their text."""
    listed = F.array_join(F.array_sort(F.collect_list(feature)), ",")
    return features.groupBy(*keys).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), listed, F.lit("]}")).alias("json"))


def reset(spark: SparkSession, folder: str, root: str) -> None:
    """Empty an output folder in any store, but only one below ``root``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, top = hadoop.Path(folder), hadoop.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    inner, outer = (fs.makeQualified(p).toUri().normalize().toString().rstrip("/") for p in (at, top))
    if not inner.startswith(f"{outer}/"):
        raise ValueError(f"{folder} is not below {root}")
    fs.delete(at, True)
    fs.mkdirs(at)
