"""Personal data: candidate spans judged by gradient-boosted trees.

Base patterns find e-mail addresses, IP addresses, card and telephone numbers
that pass their tests; these are always reported.  Beside them, high-recall
generators propose overlapping spans: digit groups with any separators,
addresses with a written-out "at", account-like identifiers.  Boosted trees
judge each by its format and context, and spans above a calibrated threshold
are added, the most probable first, if they overlap nothing reported already.

The trees are trained here.  Positive examples are base matches and variants
of them in their own context (separators changed, country code left out, "at"
written out, digits as an account).  Negative examples are ordinary numbers —
amounts in groups of thousands, dates, spans of years, lists, plain counts,
versions, book numbers — set between words of the corpus and, where no format
could be taken for a telephone number, in the contexts of base matches too; and
candidates that are part of a longer word, a version or too long.  Any other
candidate may be personal data and has no label.  The sample is bounded: the
``SAMPLE_DOCS`` documents whose ids have the least hashes, and of their
candidates the ``SAMPLE`` with the least hashes.  A quarter of it is held out
and sets the threshold: the least at which ``PRECISION`` of the held-out spans
above it are positive ones.

Scans are linear in the text: possessive patterns, and addresses are found
from their "@" outwards.

Defined results: null and empty texts have no spans (the digest is that of the
empty string).  Repeated rows are scanned each.  Without candidates of both
kinds there are no trees and only base matches are found.  Extra columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone", "other")
SAMPLE_DOCS = 20_000
SAMPLE = 40_000
PRECISION = 0.95             # wanted of added spans on held-out candidates
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGITS = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,2}+[0-9])++")
_AT = re.compile(r" ?(?:@|\[at\]|\(at\)) ?", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]++)++", re.I)
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?![A-Za-z0-9])")
_CUES = re.compile(r"phone|tel|call|fax|mobile|mail|contact|card|visa|credit|account|iban|ssn|address|\bip\b", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2(?:19|20)[0-9]{2}")
_YEAR = re.compile(r"1[5-9][0-9]{2}|20[0-9]{2}")
_THOUSANDS = re.compile(r"[0-9]{1,3}([ .])[0-9]{3}(?:\1[0-9]{3})*")
_VERSION = re.compile(r"version|licen[cs]e|chapter|section|page|isbn|\bv\.?$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _local_start(text: str, at: int, floor: int) -> int:
    i = at
    while i > floor and text[i - 1] in _LOCAL:
        i -= 1
    return i


def emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = _local_start(text, at, end)
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    for m in _CHAIN.finditer(text):
        if m[0].count(".") < 3:
            continue
        at, parts = m.start(), m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for m in _CARD.finditer(text):
        if 13 <= len(m[0]) <= 40:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list:
    """(kind, start, end) by kind, then start."""
    return [(k, s, e) for k, find in enumerate((emails, ips, cards, phones)) for s, e in find(text)]


def candidates(text: str):
    """Overlapping (start, end) of what may be personal data."""
    for m in _DIGITS.finditer(text):
        if len(m[0]) >= 7 and len(_digits(m[0])) >= 7:
            yield m.span()
    done = 0
    for m in _AT.finditer(text):
        start, done = _local_start(text, m.start(), done), m.end()
        host = _HOST.match(text, m.end()) if start < m.start() else None
        if host:
            yield start, host.end()
    for m in _ACCOUNT.finditer(text):
        yield m.span()


def features(body: str, before: str, after: str) -> list:
    """Format of a span and its context, as numbers."""
    d = _digits(body)
    parts = re.findall(r"[0-9]+", body)
    groups = [len(g) for g in parts]
    between = set(re.findall(r"[^0-9A-Za-z]+", body[1:-1]))
    letters = sum(c.isalpha() for c in body)
    return [
        len(body), len(d), letters, len(groups), max(groups, default=0), min(groups, default=0),
        groups[-1] if groups else 0, body.count("-"), body.count("."), body.count(" "), body.count("/"),
        body.count("("), float(body[:1] == "+"), float("@" in body or "at]" in body.lower() or "at)" in body.lower()),
        float(13 <= len(d) <= 19 and luhn(d)), float(len(groups) == 4 and max(groups) <= 3),
        float(letters > 0 and body[-1:].isalpha()), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(bool(_CUES.search(before))), float(bool(_VERSION.search(before))),
        float(sum(c.isdigit() for c in before) > 3), float(sum(c.isdigit() for c in after) > 3),
        float(bool(_DATE.fullmatch(body))), sum(bool(_YEAR.fullmatch(p)) for p in parts), len(between),
        float(bool(_THOUSANDS.fullmatch(body))), float(body[:1] == "0"), groups[0] if groups else 0,
        float(bool(_CUES.search(before[-16:]))),
    ]


N_FEATURES = len(features("", "", ""))


def _context(text: str, start: int, end: int) -> tuple:
    return text[start:end], text[max(0, start - 40):start], text[end:end + 20]


def variants(kind: int, body: str) -> list:
    """Other ways to write a base match."""
    if kind == 0:
        user, host = body.split("@", 1)
        return [f"{user} [at] {host}", f"{user}(at){host}"]
    if kind == 2:
        d = _digits(body)
        return [" ".join(d[i:i + 4] for i in range(0, len(d), 4)), ".".join(d[i:i + 4] for i in range(0, len(d), 4))]
    if kind == 3:
        rest = re.sub(r"^\+[0-9]+[ .-]*", "", body)
        groups = re.findall(r"[0-9]+", rest)
        return [v for v in (rest, " ".join(groups), ".".join(groups), "-".join(groups), "00" + body[1:])
                if len(_digits(v)) >= 7]
    return []


def accounts(digits: str) -> list:
    """Digits written as account numbers of all lengths, repeated to fill them."""
    d = (digits * 4)[:30]
    return ["DE" + " ".join([d[:2], *(d[i:i + 4] for i in range(2, 2 + 4 * k, 4))]) for k in range(2, 8)]


def ordinary(seed: int) -> tuple[list, list]:
    """Numbers that are no personal data, made from the digits of ``seed``:
    (such as never look like telephone numbers, such as may)."""
    d = f"{seed:020d}"[-20:]
    year, month, day = 1900 + int(d[:3]) % 130, 1 + int(d[3:5]) % 12, 1 + int(d[5:7]) % 28
    lead = str(1 + int(d[7:10]) % (10, 100, 999)[int(d[0]) % 3])
    never = [
        f"{lead} {d[10:13]} {d[13:16]}", f"{lead}.{d[10:13]}.{d[13:16]}", f"{lead} {d[10:13]} {d[13:16]} {d[16:19]}",
        f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", f"{day}/{month:02d}/{year}",
        f"{year}/{month:02d}/{day:02d}", f"{year}-{year + int(d[8]) + 1}", f"{year}-{year + 1} {year + 9}",
        f"{year} {year + 4} {year + 8}", f"{year}/{year + 1}", f"{d[1]}00/{d[2]}00/{d[3]}00",
        f"{d[1]}0 {d[2]}0 {d[3]}0 {d[4]}0", f"{d[9:11]}.{d[11:13]}.{d[13]}.{d[14:17]}.{d[17]}",
        f"978-{d[9]}-{d[10:12]}-{d[12:18]}-{d[18]}", f"{year}-{month:02d}-{day:02d} {d[9]}.{d[10:12]}"]
    may = ["1" + d[10:16], "2" + d[10:18], "3" + d[9:19], f"{lead}00{d[10:14]}", f"{d[9:13]}-{d[13:17]}"]
    return ([x for x in never if _seven(x)], [x for x in may if _seven(x)])


def _seven(x: str) -> bool:
    return len(_digits(x)) >= 7


ORDINARY = 1                 # places in a text where ordinary numbers are set


def ruled_out(body: str, before: str, after: str) -> bool:
    """Whether a candidate can't be personal data: part of a longer word, a
    version or page, a date, or more digits than telephone numbers have that
    are neither a card nor an account."""
    if before[-1:].isalnum() or after[:1].isalnum() or _VERSION.search(before.rstrip()) or _DATE.fullmatch(body):
        return True
    d = _digits(body)
    return len(d) > 15 and not any(c.isalpha() for c in body) and not (len(d) <= 19 and luhn(d))


def _examples(batches):
    """(features, label, part) of training candidates."""
    for batch in batches:
        rows, label, part = [], [], []
        for value in batch.column(0):
            text = value.as_py() or ""
            base = base_spans(text)
            for k, s, e in base:
                body, before, after = _context(text, s, e)
                every = [body, *variants(k, body)]
                if k >= 2:
                    every += accounts(_digits(body))
                group = xxhash.xxh64_intdigest(body.encode("utf-8", "replace")) >> 1
                for v in ordinary(group)[0]:
                    rows.append(features(v, before, after))
                    label.append(0)
                    part.append(group)
                for v in every:
                    if any(c.isalpha() for c in v):      # letters tell an account or address without any context
                        rows.append(features(v, " ", " "))
                        label.append(1)
                        part.append(group)
                    for y, x in ((1, (v, before, after)), (0, (v, before + "a", after)), (0, (v, "Version ", after))):
                        rows.append(features(*x))
                        label.append(y)
                        part.append(group)
            held = _Taken(base)
            for k in range(ORDINARY if " " in text else 0):
                seed = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), k) >> 1
                at = text.find(" ", seed % len(text))
                before, after = text[max(0, at - 39):at + 1], text[at:at + 20]
                if at > 0 and not _CUES.search(before) and not held.overlaps(at - 39, at + 20):
                    for v in sum(ordinary(seed), []):
                        rows.append(features(v, before, after))
                        label.append(0)
                        part.append(seed)
            for s, e in candidates(text):
                body, before, after = _context(text, s, e)
                if not held.overlaps(s, e) and ruled_out(body, before, after):
                    rows.append(features(body, before, after))
                    label.append(0)
                    part.append(xxhash.xxh64_intdigest(body.encode("utf-8", "replace")) >> 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.float64())), pa.array(label, pa.int32()), pa.array(part, pa.int64())],
            names=["x", "y", "part"])


class _Taken:
    """Disjoint groups of reported spans, searched by halving."""

    def __init__(self, spans: list):
        self.starts, self.ends = [], []
        for s, e in sorted((s, e) for _, s, e in spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start

    def add(self, start: int, end: int) -> None:
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def _binned(x: np.ndarray, cuts: list) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1) \
        if len(x) else np.zeros(x.shape, int)


def boost(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> dict:
    """Gradient-boosted trees with logistic loss over binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b = _binned(x, cuts)
    start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    f, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        tests = []
        for depth in range(DEPTH):
            width = 2 ** depth
            best = [(0.0, 0, BINS + 1)] * width                  # by default all rows go left
            for j in range(x.shape[1]):
                at = node * (BINS + 1) + b[:, j]
                gs = np.bincount(at, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(at, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                gain = gs ** 2 / (hs + ridge) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + ridge) \
                    - gs[:, -1:] ** 2 / (hs[:, -1:] + ridge)
                for k in range(width):
                    c = int(np.argmax(gain[k]))
                    if gain[k, c] > best[k][0] + 1e-9:
                        best[k] = (float(gain[k, c]), j, c)
            feature, cut = np.array([t[1] for t in best]), np.array([t[2] for t in best])
            tests.append((feature, cut))
            node = node * 2 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = RATE * np.bincount(node, g, 2 ** DEPTH) / (np.bincount(node, h, 2 ** DEPTH) + ridge)
        trees.append((tests, leaf))
        f = f + leaf[node]
    return {"cuts": cuts, "start": start, "trees": trees}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    b = _binned(x, model["cuts"])
    f = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for tests, leaf in model["trees"]:
        node = np.zeros(len(x), int)
        for feature, cut in tests:
            node = node * 2 + (b[rows, feature[node]] > cut[node])
        f += leaf[node]
    return 1 / (1 + np.exp(-f))


def calibrated(p: np.ndarray, y: np.ndarray) -> float:
    """Least threshold from 0.5 on at which the held-out precision is reached."""
    for t in np.unique(np.concatenate([[0.5], p[p >= 0.5]])):
        if y[p >= t].mean() >= PRECISION if (p >= t).any() else True:
            return float(t)
    return 1.1


def train(docs: DataFrame) -> dict | None:
    ids = stored(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
                 .orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS), "sample-ids")
    sample = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi").select("text")
    examples = stored(sample.mapInArrow(_examples, "x array<double>, y int, part long").distinct()
                      .orderBy("part", "y", "x").limit(SAMPLE), "examples").toPandas()
    if examples["y"].nunique() < 2:
        return None
    x, y = np.array(examples["x"].tolist(), float), examples["y"].to_numpy(float)
    held = examples["part"].to_numpy() % 4 == 0
    if len(set(y[~held])) < 2 or not held.any():
        return None
    model = boost(x[~held], y[~held])
    return model | {"threshold": calibrated(probability(model, x[held]), y[held])}


def added(texts: list, base: list, model: dict | None) -> list:
    """Spans that the trees add to each text, without overlap, by start."""
    out: list = [[] for _ in texts]
    if model is None:
        return out
    taken, where, rows = [_Taken(b) for b in base], [], []
    for k, text in enumerate(texts):
        for s, e in candidates(text):
            if not taken[k].overlaps(s, e):
                where.append((k, s, e))
                rows.append(features(*_context(text, s, e)))
    if rows:
        p = probability(model, np.array(rows, float))
        for i in np.lexsort(([-e for _, _, e in where], [s for _, s, _ in where], -p)):
            k, s, e = where[i]
            if p[i] >= model["threshold"] and not taken[k].overlaps(s, e):
                taken[k].add(s, e)
                out[k].append((len(KINDS) - 1, s, e))
    return [sorted(o) for o in out]


def scan(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, spans): array of (kind, start, end) by kind, then start; kind is
    an index into ``KINDS`` and the last one is what the trees add."""
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def find(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                base = [base_spans(t) for t in texts]
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in b + more]
                        for b, more in zip(base, added(texts, base, model))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(span))],
                                                 names=["doc_id", "spans"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, spans array<struct<kind:int,start:int,end:int>>")


def as_string(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
