"""A Python data source that reads one JSON document in byte ranges.

``{"annotations": [{...}, ...], "images": [{...}, ...], ...}`` has no line ends
to split at, and from a place in its middle one can't tell a bracket from a
character of a string.  So it is read in two steps over the same byte ranges:

1. ``outline``: each task scans one range and reports, for each of the three
   states it may start in (outside strings, in a string, in a string after a
   backslash), the state at its end, how many open brackets it closes, and the
   offsets of brackets that it leaves open.  That is a few numbers for a
   range, however long the document; in order they give every range its state
   and its stack of open brackets.
2. ``elements``: each task parses the elements of top-level arrays that begin
   in its range, and reads on to the end of the last one.

Rows are (section, element): the name of the top-level array and the element
as JSON text, ready for ``from_json``.  A document that isn't valid where it is
looked at (brackets that don't match, elements that aren't JSON) is an error.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .images import to_uri

RANGE_BYTES = 4 << 20
READ_ON = 1 << 16                  # bytes read at a time beyond a range
NAME_BYTES = 1 << 12               # longest name of a section, with white space
OUT, IN, ESCAPED = 0, 1, 2

_OUTLINE = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("state", T.IntegerType()), T.StructField("end_state", T.IntegerType()),
                         T.StructField("closed", T.LongType()), T.StructField("opened", T.ArrayType(T.LongType()))])
_ELEMENTS = T.StructType([T.StructField("section", T.StringType()), T.StructField("element", T.StringType())])
_NAME = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.S)


def _open(path: str):
    from pyarrow import fs as pafs

    filesystem, name = pafs.FileSystem.from_uri(to_uri(path))
    return filesystem.open_input_file(name)


def _sizes(path: str) -> list:
    """(file, bytes) of a file, or of the JSON files of a folder."""
    from pyarrow import fs as pafs

    filesystem, name = pafs.FileSystem.from_uri(to_uri(path))
    info = filesystem.get_file_info(name)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    return sorted((f"{path.rstrip('/')}/{f.base_name}", f.size)
                  for f in filesystem.get_file_info(pafs.FileSelector(name))
                  if f.is_file and f.base_name[0] not in "._")


def scan(data: np.ndarray, state: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(state at the end, places of brackets outside strings, +1 or -1 of each)."""
    slash = data == 0x5C
    # a backslash that follows an even run of them escapes the next byte
    run_start = slash & ~np.concatenate([[False], slash[:-1]])
    at = np.arange(len(data))
    first = np.maximum.accumulate(np.where(run_start, at, -1))
    odd = slash & ((at - first) % 2 == 0)
    if state == ESCAPED and len(data):
        # the first byte is escaped; the run that it begins, if any, starts one later
        end = int(np.argmin(slash)) if not slash.all() else len(data)
        odd[:end] = slash[:end] & (at[:end] % 2 == 1)
    escaped = np.concatenate([[state == ESCAPED], odd[:-1]])[:len(data)]
    quote = (data == 0x22) & ~escaped
    inside = (np.cumsum(quote) + (state != OUT)) % 2 == 1
    kind = np.where((data == 0x7B) | (data == 0x5B), 1, np.where((data == 0x7D) | (data == 0x5D), -1, 0))
    places = np.flatnonzero((kind != 0) & ~inside)
    if not len(data):
        return state, places, kind[places]
    end = (ESCAPED if odd[-1] else IN) if inside[-1] else OUT
    return end, places, kind[places]


def unmatched(places: np.ndarray, signs: np.ndarray) -> tuple[int, np.ndarray]:
    """(brackets closed that were open before, places of those left open)."""
    if not len(places):
        return 0, places
    depth = np.cumsum(signs)
    closed = max(0, -int(depth.min()))
    later = np.minimum.accumulate(depth[::-1])[::-1]
    return closed, places[(signs > 0) & (later >= depth)]


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int, size: int, state: int = OUT, stack: tuple = ()):
        self.file, self.start, self.end, self.size, self.state, self.stack = file, start, end, size, state, stack


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.step = options["path"], int(options.get("rangeBytes", RANGE_BYTES))
        self.outline = json.loads(options["outline"]) if "outline" in options else None

    def partitions(self):
        found = []
        for file, size in _sizes(self.path):
            for start in range(0, size, self.step):
                state, stack = self.outline[f"{file}:{start}"] if self.outline is not None else (OUT, ())
                found.append(_Range(file, start, min(start + self.step, size), size, state, tuple(stack)))
        return found

    def read(self, part: _Range):
        if part is None:
            return
        with _open(part.file) as f:
            yield from (_outline(f, part) if self.outline is None else _elements(f, part))


def _outline(f, part: _Range):
    data = np.frombuffer(f.read_at(part.end - part.start, part.start), np.uint8)
    rows = []
    for state in (OUT, IN, ESCAPED):
        end, places, signs = scan(data, state)
        closed, opened = unmatched(places, signs)
        rows.append((part.file, part.start, state, end, closed, (opened + part.start).tolist()))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
        pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=_OUTLINE.names)


def _section(f, bracket: int) -> str:
    before = f.read_at(min(bracket, NAME_BYTES), max(0, bracket - NAME_BYTES))
    name = _NAME.search(before)
    if not name:
        raise ValueError(f"no name before the array at byte {bracket}")
    return json.loads(b'"' + name.group(1) + b'"')


def _elements(f, part: _Range):
    raw = f.read_at(part.end - part.start, part.start)
    data = np.frombuffer(raw, np.uint8)
    state, places, signs = scan(data, part.state)
    depth = len(part.stack) + np.cumsum(signs)            # after each bracket
    if len(depth) and depth.min() < 0:
        raise ValueError(f"{part.file}: unmatched bracket")
    begins = places[(signs > 0) & (depth == 3)]
    ends = places[(signs < 0) & (depth == 2)] + 1
    arrays = places[(signs > 0) & (depth == 2)]
    if len(ends) > len(begins) or (len(begins) and len(ends) and ends[0] <= begins[0]):
        ends = ends[1:]                                   # of an element that begins in an earlier range
    if len(begins) > len(ends):
        # read on to the end of the last element
        open_now, at = int(depth[-1]), part.end
        while open_now > 2:
            more = f.read_at(min(READ_ON, part.size - at), at)
            if not more:
                raise ValueError(f"{part.file}: the document ends inside an element")
            state, where, sign = scan(np.frombuffer(more, np.uint8), state)
            after = open_now + np.cumsum(sign)
            done = np.flatnonzero(after <= 2)
            if len(done):
                more, open_now = more[:where[done[0]] + 1], 2
            elif len(after):
                open_now = int(after[-1])
            raw, at = raw + more, at + len(more)
        ends = np.append(ends, len(raw))
    names, elements = [], []
    opened = [(a, _section(f, part.start + int(a))) for a in arrays]
    current = _section(f, part.stack[1]) if len(part.stack) > 1 else None
    for b, e in zip(begins.tolist(), ends.tolist()):
        while opened and opened[0][0] < b:
            current = opened.pop(0)[1]
        names.append(current)
        elements.append(raw[b:e].decode("utf-8"))
        if len(names) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(elements)], names=_ELEMENTS.names)
            names, elements = [], []
    if names:
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(elements)], names=_ELEMENTS.names)


class JsonDocument(DataSource):
    """``spark.read.format("json_document")`` with the options ``path``,
    ``rangeBytes`` and, for elements, ``outline``."""

    @classmethod
    def name(cls):
        return "json_document"

    def schema(self):
        return _ELEMENTS if "outline" in self.options else _OUTLINE

    def reader(self, schema):
        return _Reader(self.options)


def read_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(section, element) of the documents at ``path``."""
    spark.dataSource.register(JsonDocument)
    source = spark.read.format("json_document").option("path", path).option("rangeBytes", range_bytes)
    found = {(r["file"], r["start"], r["state"]): r for r in source.load().collect()}   # three short rows a range
    outline, stack, state = {}, [], OUT
    starts = sorted({k[:2] for k in found})
    for k, (file, start) in enumerate(starts):
        outline[f"{file}:{start}"] = (state, stack)
        r = found[file, start, state]
        if r["closed"] > len(stack):
            raise ValueError(f"{file}: unmatched bracket")
        stack, state = stack[:len(stack) - r["closed"]] + r["opened"], r["end_state"]
        if k + 1 == len(starts) or starts[k + 1][0] != file:
            if stack or state != OUT:
                raise ValueError(f"{file}: the document ends early")
    return source.option("outline", json.dumps(outline)).load()
