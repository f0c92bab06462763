"""SentencePiece unigram encoding and decoding.

The pieces of a vocabulary file are put in a double-array trie over bytes, in
which the white-space marker of a piece is the space it stands for.  Texts get
a space in front and are encoded by Viterbi search for the pieces with the
greatest sum of log scores; characters without a piece become byte pieces.
Decoding joins the pieces' bytes and takes the first space off.

No piece continues over the start of a run of spaces, so a text is searched
unit by unit (spaces and the word after them), each distinct unit once.  The
units of a batch advance together, one byte at a time, in NumPy.

Scores: a unigram vocabulary's own log scores, or, for a vocabulary that only
ranks its pieces, log scores by Zipf's law from the ranks.  Nothing is trained.

Defined results: a null text has null ids and decodes to null, an empty one
has none and decodes to the empty string.  Every text is restored exactly; a
literal white-space marker is kept apart from a space by its byte pieces.
Equal scores: the piece that starts first wins.  Repeated rows are encoded
each.  Extra columns are carried along; one named like an output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0      # below the least score of a piece
SLICE = 1 << 20             # bytes of text encoded together
CACHED = 150_000            # units kept by a task
TOGETHER = 8_000            # units searched together
LONG = 96                   # bytes from which a unit is searched alone
_UNIT = re.compile(rb" *[^ ]+| +")


def vocabulary_path(name: str = DEFAULT_VOCABULARY, folder: str = "/opt/tokenizers") -> str:
    return f"{folder}/{name}"


def read_vocabulary(path: str, scores: str = "auto") -> dict:
    """Pieces, log scores and byte ids of a vocabulary file.

    ``scores``: "own" takes the file's log scores, "rank" makes them by Zipf's
    law from the order of its scores, "auto" does so if these are whole numbers.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, byte_ids, pieces = [], np.full(256, -1, np.int32), []
    for i in range(sp.vocab_size()):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            ids.append(i)
            pieces.append(sp.id_to_piece(i).replace(MARKER, " ").encode())
    own = np.array([sp.get_score(i) for i in ids], np.float64)
    if scores == "rank" or scores == "auto" and (own == np.round(own)).all():
        ranks = np.empty(len(own))
        ranks[np.lexsort((ids, -own))] = np.arange(1, len(own) + 1)
        log = -np.log(ranks)
        own = log - np.log(np.exp(log).sum())
    return {"ids": np.array(ids, np.int32), "pieces": pieces, "scores": own, "byte_ids": byte_ids,
            "size": sp.vocab_size()}


def double_array(pieces: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) over the bytes of the pieces.

    The child of state s by byte c is base[s] + c + 1 if check of it is s;
    value is the index of the piece that ends in a state, or -1.
    """
    children: list = [{}]
    ends = [-1]
    for k, p in enumerate(pieces):
        s = 0
        for c in p:
            if c not in children[s]:
                children[s][c] = len(children)
                children.append({})
                ends.append(-1)
            s = children[s][c]
        ends[s] = k
    base, check, value = [0], [-1], [-1]
    place, queue = {0: 0}, [0]
    hole = 257          # lone children fill holes from the left
    tail = 0            # larger families are tried from the last one's place on

    def taken(slot: int) -> bool:
        while slot >= len(check):
            base.append(0)
            check.append(-1)
            value.append(-1)
        return check[slot] >= 0

    for node in queue:
        kids = list(children[node])
        state = place.pop(node)
        value[state] = ends[node]
        if not kids:
            continue
        if len(kids) == 1:
            while taken(hole):
                hole += 1
            at = hole - kids[0] - 1
        else:
            at = tail
            while any(taken(at + c + 1) for c in kids):
                at += 1
            tail = at
        base[state] = at
        for c in kids:
            slot = at + c + 1
            taken(slot)
            check[slot] = state
            place[children[node][c]] = slot
            queue.append(children[node][c])
    taken(len(check) + 260)     # so that no lookup leaves the arrays
    return tuple(np.array(x, np.int32) for x in (base, check, value))


def build(vocabulary: dict) -> dict:
    """Trie and tables that the tasks use (about a megabyte)."""
    pieces = vocabulary["pieces"]
    base, check, value = double_array(pieces)
    table = [b""] * vocabulary["size"]
    for i, p in zip(vocabulary["ids"], pieces):
        table[i] = p
    for c, i in enumerate(vocabulary["byte_ids"]):
        if i >= 0:
            table[i] = bytes([c])
    lengths = np.array([len(p) for p in table], np.int64)
    return {
        "base": base, "check": check, "value": value, "scores": vocabulary["scores"], "ids": vocabulary["ids"],
        "byte_ids": vocabulary["byte_ids"], "longest": max(map(len, pieces), default=0),
        "unknown": float(vocabulary["scores"].min()) - UNKNOWN_PENALTY,
        "units": not any(re.search(rb"[^ ] ", p) for p in pieces),
        "bytes": np.frombuffer(b"".join(table), np.uint8), "lengths": lengths,
    }


def _character_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts at each place (0 inside one)."""
    n = np.ones(len(data), np.int64)
    n[data >= 0xC0] = 2
    n[data >= 0xE0] = 3
    n[data >= 0xF0] = 4
    n[(data & 0xC0) == 0x80] = 0
    return n


def search_one(model: dict, unit: bytes) -> list:
    """Viterbi search of one unit: ids."""
    base, check, value = model["base"], model["check"], model["value"]
    n = len(unit)
    best, origin, piece = [-np.inf] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    width = _character_lengths(np.frombuffer(unit, np.uint8)).tolist()
    for i in range(n):
        if not width[i]:
            continue
        state, alone = 0, False
        for j in range(i, min(n, i + model["longest"])):
            nxt = int(base[state]) + unit[j] + 1
            if check[nxt] != state:
                break
            state = nxt
            k = int(value[state])
            if k >= 0:
                s = best[i] + model["scores"][k]
                if s > best[j + 1]:
                    best[j + 1], origin[j + 1], piece[j + 1] = s, i, k
                alone |= j + 1 - i == width[i]
        if not alone and best[i] + model["unknown"] > best[i + width[i]]:
            e = i + width[i]
            best[e], origin[e], piece[e] = best[i] + model["unknown"], i, -1
    out, e = [], n
    while e:
        s = origin[e]
        out.append([int(model["ids"][piece[e]])] if piece[e] >= 0 else [int(model["byte_ids"][c]) for c in unit[s:e]])
        e = s
    return [i for part in reversed(out) for i in part]


def search(model: dict, units: list) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi search of many short units together: (flat ids, ids of each)."""
    base, check, value, scores = model["base"], model["check"], model["value"], model["scores"]
    count = len(units)
    size = np.array([len(u) for u in units], np.int64)
    first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(units), np.uint8)
    width = _character_lengths(data)
    most = int(size.max())
    best = np.full((count, most + 1), -np.inf)
    best[:, 0] = 0.0
    origin, piece = np.zeros((count, most + 1), np.int32), np.full((count, most + 1), -1, np.int32)
    for i in range(most):
        who = np.flatnonzero(size > i)
        who = who[width[first[who] + i] > 0]
        if not len(who):
            continue
        here = first[who] + i
        alone = np.zeros(count, bool)
        row, state = who, np.zeros(len(who), np.int64)
        for j in range(i, min(most, i + model["longest"])):
            inside = size[row] > j
            row, state = row[inside], state[inside]
            nxt = base[state] + data[first[row] + j] + 1
            known = check[nxt] == state
            row, state = row[known], nxt[known]
            if not len(row):
                break
            k = value[state]
            hit = k >= 0
            r, k = row[hit], k[hit]
            s = best[r, i] + scores[k]
            better = s > best[r, j + 1]
            r2 = r[better]
            best[r2, j + 1], origin[r2, j + 1], piece[r2, j + 1] = s[better], i, k[better]
            alone[r[width[first[r] + i] == j + 1 - i]] = True
        left = ~alone[who]
        r, e = who[left], i + width[here[left]]
        s = best[r, i] + model["unknown"]
        better = s > best[r, e]
        r, e = r[better], e[better]
        best[r, e], origin[r, e], piece[r, e] = s[better], i, -1
    found = []
    row, e = np.arange(count), size.copy()
    while len(row):
        s = origin[row, e].astype(np.int64)
        found.append((row, s, e, piece[row, e]))
        row, e = row[s > 0], s[s > 0]
    row, s, e, k = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((e, row))
    row, s, e, k = row[order], s[order], e[order], k[order]
    n = np.where(k >= 0, 1, e - s)
    at = np.repeat(np.cumsum(n) - n, n)
    byte = np.repeat(first[row] + s, n) + (np.arange(len(at)) - at)
    ids = np.where(np.repeat(k >= 0, n), np.repeat(model["ids"][k], n), model["byte_ids"][data[byte]])
    return ids.astype(np.int32), np.bincount(row, n, count).astype(np.int64)


class Encoder:
    """Encodes batches of texts; keeps the ids of units already searched."""

    def __init__(self, model: dict):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict = {}
        self.flat, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, units: list) -> None:
        if len(self.index) + len(units) > CACHED:
            self._forget()
        short = sorted((u for u in units if len(u) < LONG), key=len)
        parts, counts, order = [], [], []
        for at in range(0, len(short), TOGETHER):
            some = short[at:at + TOGETHER]
            ids, n = search(self.model, some)
            parts.append(ids)
            counts.append(n)
            order += some
        for u in units:
            if len(u) >= LONG:
                ids = np.array(search_one(self.model, u), np.int32)
                parts.append(ids)
                counts.append(np.array([len(ids)]))
                order.append(u)
        n = np.concatenate(counts)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(n) - n])
        self.counts = np.concatenate([self.counts, n])
        self.flat = np.concatenate([self.flat, *parts])
        for u in order:
            self.index[u] = len(self.index)

    def __call__(self, texts: list) -> tuple[np.ndarray, list]:
        """Flat ids of the texts, and how many each has."""
        units, per_text = [], []
        for t in texts:
            own = (_UNIT.findall(b" " + t) if self.model["units"] else [b" " + t]) if t else []
            units += own
            per_text.append(len(own))
        if not units:
            return np.empty(0, np.int32), [0] * len(texts)
        distinct = dict.fromkeys(units)
        new = [u for u in distinct if u not in self.index]
        if len(self.index) + len(new) > CACHED:
            self._forget()
            new = list(distinct)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
        n = self.counts[at]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(self.starts[at] - (ends - n), n) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[np.cumsum([0] + per_text)]
        return ids, np.diff(bounds).tolist()


def _slices(column, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes."""
    at, size = 0, 0
    for k in range(len(column)):
        size += len(column[k].as_buffer()) if column[k].is_valid else 0
        if size >= limit:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(column):
        yield at, len(column)


def _with(batch, name: str, array):
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [array], names=names + [name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, model: dict, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``: ids of the pieces of each text (array<int>)."""
    def run(batches):
        encoder = Encoder(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            for a, b in _slices(column, SLICE):
                texts = [v.as_buffer().to_pybytes() if v.is_valid else None for v in column.slice(a, b - a)]
                ids, n = encoder(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + n), pa.int32()), pa.array(ids),
                                                 mask=pa.array([t is None for t in texts]))
                yield _with(batch.slice(a, b - a), out, lists)
    return docs.mapInArrow(run, _schema(docs, out, T.ArrayType(T.IntegerType())))


def join_pieces(model: dict, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces of many texts, and the bytes of each text."""
    lengths = model["lengths"]
    n = lengths[ids]
    ends = np.cumsum(n)
    starts = np.cumsum(lengths) - lengths
    data = model["bytes"][np.repeat(starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return data, bounds


def decode(encoded: DataFrame, model: dict, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the text of the ids."""
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                lists = part.column(part.schema.get_field_index(ids))
                counts = np.diff(lists.offsets.to_numpy())
                data, bounds = join_pieces(model, lists.flatten().to_numpy(), np.where(lists.is_valid(), counts, 0))
                texts = [data[a + 1:b].tobytes().decode("utf-8", "replace") if ok else None
                         for a, b, ok in zip(bounds, bounds[1:], lists.is_valid().to_pylist())]
                yield _with(part, out, pa.array(texts, pa.string()))
    return encoded.mapInArrow(run, _schema(encoded, out, T.StringType()))
