"""Image files (S2) and the per-file image sink.

A folder is listed by a task, and its names are dealt over the tasks that read
the files: the driver has neither names nor a task for every few files, as it
has with Spark's ``binaryFile`` source.  Decoding is pluggable; a file that
fails to decode gives a row with NULL pixels and an error message instead of
failing the task.  The built-in codec is a tiny raw format (header + HWC uint8
bytes); real codecs (JPEG/PNG) plug in as decoders.  Files are written by a data
source with a commit.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from itertools import islice
from urllib.parse import quote

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

RAW_MAGIC = b"LFR1"
_HEADER = struct.Struct("<4sIIB")

DECODED_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("c", T.IntegerType()),
    T.StructField("pixels", T.BinaryType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


def to_uri(path: str) -> str:
    """A filesystem URI for pyarrow from a Spark path (``/x``, ``file:/x`` or
    ``scheme://…``)."""
    if "://" in path:
        return path
    if path.startswith("file:"):
        path = path[len("file:"):]
    return "file://" + path


def encode_raw(pixels: np.ndarray) -> bytes:
    """HWC uint8 array → raw file bytes."""
    a = np.asarray(pixels, dtype=np.uint8)
    if a.ndim == 2:
        a = a[:, :, None]
    h, w, c = a.shape
    return _HEADER.pack(RAW_MAGIC, h, w, c) + a.tobytes()


def decode_raw(data: bytes):
    """Raw file bytes → (h, w, c, HWC uint8 bytes)."""
    magic, h, w, c = _HEADER.unpack_from(data, 0)
    if magic != RAW_MAGIC:
        raise ValueError("not a raw image file")
    body = data[_HEADER.size:]
    if len(body) != h * w * c:
        raise ValueError(f"expected {h * w * c} bytes, got {len(body)}")
    return h, w, c, bytes(body)


FRAME_ROWS, FRAME_BYTES = 4096, 1 << 24      # rows of an output frame, and bytes of the files in it
LIST_ROWS = 10_000                           # names in a batch of a listing


def _children(files, root: str):
    """(name, whether it is a folder) of all that is in a folder.  A local
    folder is never held as a whole."""
    from pyarrow import fs as pafs

    if isinstance(files, pafs.LocalFileSystem):
        with os.scandir(root) as found:
            for e in found:
                yield e.name, e.is_dir()
    else:
        for info in files.get_file_info(pafs.FileSelector(root)):
            yield info.base_name, info.type == pafs.FileType.Directory


def _file_names(files, root: str, pattern: str | None, below: str = ""):
    """Paths below ``root`` of the files that Spark's file sources find there:
    none that are hidden, and of its folders those of partitions (``key=value``)."""
    for name, folder in _children(files, f"{root}/{below}".rstrip("/")):
        if name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"):
            continue
        if folder:
            if "=" in name:
                yield from _file_names(files, root, pattern, f"{below}{name}/")
        elif pattern is None or re.fullmatch(pattern, name, re.DOTALL):
            yield below + name


def _store(uri: str):
    """(filesystem, path) of a URI as Hadoop writes it, where names aren't quoted."""
    from pyarrow import fs as pafs

    return (pafs.LocalFileSystem(), uri[len("file:"):]) if uri.startswith("file:/") else pafs.FileSystem.from_uri(uri)


def _folder(spark: SparkSession, path: str) -> str | None:
    """The full name of a folder that the tasks can list; None for a file, a
    pattern, a missing path, and stores that only Spark's readers know."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    if re.search(r"[*?\[\]{}\\]", path):
        return None
    at = hadoop.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        uri = store.makeQualified(at).toString().rstrip("/")
        _store(uri)
        return uri if store.getFileStatus(at).isDirectory() else None
    except Exception:
        return None


def _decoded(decoder, path: str, content: bytes) -> tuple:
    try:
        h, w, c, px = decoder(content)
        return path, h, w, c, px, "success", None
    except Exception as e:  # a bad file is a row, not a failed task
        return path, None, None, None, None, "error", f"{type(e).__name__}: {e}"


def read_images(spark: SparkSession, path: str, decoder=decode_raw, glob: str | None = None) -> DataFrame:
    """(path, h, w, c, pixels, status, error_message) per file.

    One task lists the folder, and its names are shuffled to four read tasks
    for each core.  Files are those that Spark's file sources would read: not
    hidden, not empty, with a name that ``glob`` matches.  Spark's
    ``binaryFile`` source lists on the driver what is no folder that pyarrow
    can open: patterns in ``path``, single files, and other stores.
    """
    import pandas as pd

    def frame(rows):
        return pd.DataFrame(rows, columns=[f.name for f in DECODED_SCHEMA.fields])

    uri = _folder(spark, path)
    if uri is None:
        reader = spark.read.format("binaryFile")
        if glob:
            reader = reader.option("pathGlobFilter", glob)

        def run(batches):
            for pdf in batches:
                yield frame([_decoded(decoder, p, x) for p, x in zip(pdf["path"], pdf["content"])])

        return reader.load(path).select("path", "content").mapInPandas(run, DECODED_SCHEMA)

    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern() if glob else None

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            files, root = _store(uri)
            names = _file_names(files, root, pattern) if batch.num_rows else iter(())
            while part := list(islice(names, LIST_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["name"])

    def read(batches):
        files, root = _store(uri)
        for pdf in batches:
            rows, held = [], 0
            for name in pdf["name"]:
                with files.open_input_stream(f"{root}/{name}", compression=None) as f:
                    content = f.read()
                if content:
                    rows.append(_decoded(decoder, f"{uri}/{name}", content))
                    held += len(content)
                if len(rows) >= FRAME_ROWS or held >= FRAME_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)

    names = spark.range(0, 1, 1, 1).mapInArrow(listed, "name string")
    return names.repartition(4 * spark.sparkContext.defaultParallelism, "name").mapInPandas(read, DECODED_SCHEMA)


class _ImageWriter(DataSourceArrowWriter):
    """Files of a job appear together, or not at all.

    A task writes into a folder of its attempt and, when all its files are
    whole, moves them into the job's folder; a killed attempt leaves nothing
    there, and a repeated one puts the same names there.  The commit renames
    the job's folder to the target; an abort removes it.
    """

    def __init__(self, path: str, encoder, suffix: str):
        from pyarrow import fs as pafs

        self.uri, self.encoder, self.suffix = to_uri(path.rstrip("/")), encoder, suffix
        self.root = pafs.FileSystem.from_uri(self.uri)[1]
        self.job = f"{self.root}.writing-{uuid.uuid4().hex}"

    def _files(self):
        from pyarrow import fs as pafs

        return pafs.FileSystem.from_uri(self.uri)[0]

    def write(self, batches):
        files, attempt = self._files(), f"{self.job}/{uuid.uuid4().hex}"
        files.create_dir(f"{self.job}/files", recursive=True)
        files.create_dir(attempt)
        names = []
        for batch in batches:
            for k in range(batch.num_rows):
                key, h, w, c, px = (batch.column(x)[k].as_py() for x in range(5))
                names.append(quote(key, safe="") + self.suffix)
                with files.open_output_stream(f"{attempt}/{names[-1]}") as f:
                    f.write(self.encoder(np.frombuffer(px, np.uint8).reshape(h, w, c)))
        for name in names:
            files.move(f"{attempt}/{name}", f"{self.job}/files/{name}")
        files.delete_dir(attempt)
        return WriterCommitMessage()

    def commit(self, messages):
        from pyarrow import fs as pafs

        files = self._files()
        files.create_dir(f"{self.job}/files", recursive=True)
        if files.get_file_info(self.root).type != pafs.FileType.NotFound:
            files.delete_dir(self.root)
        files.move(f"{self.job}/files", self.root)
        files.delete_dir(self.job)

    def abort(self, messages):
        from pyarrow import fs as pafs

        files = self._files()
        if files.get_file_info(self.job).type != pafs.FileType.NotFound:
            files.delete_dir(self.job)


def write_image_files(df: DataFrame, key: str, pixels: str, h: str, w: str, c: str, out_dir: str,
                      encoder=encode_raw, suffix: str = ".raw", overwrite: bool = False) -> None:
    """One file per row named by its key (so a generated batch never
    overwrites itself), by a data source writer on the executors.

    ``out_dir`` appears whole when all tasks have succeeded; a failed job
    leaves it as it was.  It must be on a filesystem that every executor can
    reach (pyarrow resolves the URI).  A folder with files in it is replaced
    only with ``overwrite``.
    """
    from pyarrow import fs as pafs

    files, root = pafs.FileSystem.from_uri(to_uri(out_dir.rstrip("/")))
    if not overwrite and files.get_file_info(root).type != pafs.FileType.NotFound \
            and any(True for _ in _children(files, root)):
        raise FileExistsError(out_dir)

    class ImageFiles(DataSource):
        @classmethod
        def name(cls):
            return "image_files"

        def writer(self, schema, overwrite):
            return _ImageWriter(self.options["path"], encoder, suffix)

    spark = df.sparkSession
    spark.dataSource.register(ImageFiles)
    px = F.col(pixels)
    if isinstance(df.schema[pixels].dataType, T.ArrayType):
        px = F.unhex(F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
    df.select(F.col(key).cast("string").alias("key"), *[F.col(n).cast("int").alias(a) for n, a in (
        (h, "h"), (w, "w"), (c, "c"))], px.alias("pixels")) \
        .write.format("image_files").mode("append").save(out_dir.rstrip("/"))


def load_images(df: DataFrame, path_col: str, decoder=decode_raw) -> DataFrame:
    """S2 by path: open and decode the file named in ``path_col`` of each row
    (any filesystem pyarrow can reach), adding h, w, c, pixels, status and
    error_message.  Used after joins/filters so that only the rows that
    passed are read — a ``binaryFile`` scan would read every file's bytes.
    """
    from pyarrow import fs as pafs

    cols = df.columns
    out_schema = T.StructType(list(df.schema.fields) + [f for f in DECODED_SCHEMA.fields if f.name != "path"])

    def run(batches):
        cache = {}
        for pdf in batches:
            extra = {k: [] for k in ("h", "w", "c", "pixels", "status", "error_message")}
            for p in pdf[path_col]:
                try:
                    uri = to_uri(p)
                    head = "/".join(uri.split("/", 3)[:3])          # scheme://authority
                    if head not in cache:                           # one filesystem client per store
                        fs_, path = pafs.FileSystem.from_uri(uri)
                        cache[head] = (fs_, len(uri) - len(path))
                    fs_, offset = cache[head]
                    with fs_.open_input_stream(uri[offset:]) as f:
                        h, w, c, px = decoder(f.read())
                    vals = (h, w, c, px, "success", None)
                except Exception as e:  # unreadable or undecodable: an error row
                    vals = (None, None, None, None, "error", f"{type(e).__name__}: {e}")
                for k, v in zip(extra, vals):
                    extra[k].append(v)
            out = pdf[cols].copy()
            for k, v in extra.items():
                out[k] = v
            yield out

    return df.mapInPandas(run, out_schema)
