"""Quality classifier: histogram gradient-boosted trees over document statistics.

* *Statistics.* Each text gives one row of numbers (``NAMES``): shares of kinds
  of bytes, entropy, lengths and forms of words, repeated words and word pairs,
  lines. They are computed by array code over packs of texts, in tasks.
* *Trees.* Learned from a bounded sample of labelled rows: statistics are cut
  into at most ``BINS`` bins by their quantiles, and each split is the best by
  the second-order gain of the logistic loss over per-bin sums of gradients.
  The sample's statistics (``TRAIN_ROWS`` rows of ``len(NAMES)`` numbers, a few
  megabytes) are all that reaches the driver.
* *Scoring.* Trees are complete binary trees of one depth, flattened into
  arrays of features, thresholds and leaf values; all rows of a pack walk all
  trees at once, one level at a time.

Labels of rows with ``crc32(doc_id as text) % 5 = 0`` are never read; labels,
languages, sources and ids are never inputs of a score.

Cases: NULL and empty texts have all statistics zero and are scored like any
other; labels that are NULL or contradict each other are not used; without
labels of both kinds the score is the share of label 1 (one half without any);
repeated rows are scored alike; very long texts are read whole; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import Words, mix, packs, ragged, slices, span_hashes, staged, utf8

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
BINS = 64
TREES, DEPTH, RATE = 120, 4, 0.1
#: Pull of leaf values to zero, and the least sum of second derivatives in a leaf.
PULL, LEAST = 1.0, 2.0

_KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c", "newline": b"\n", "stop": b".!?", "pause": b",;:'\"()-", "sign": b"#$%&*+/<=>@[\\]^_`{|}~",
}
_KIND = np.full(256, len(_KINDS), np.int64)  # the last kind: beyond ASCII
_KIND[:0x80] = len(_KINDS) + 1  # control characters
for _i, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _i
_KIND_OF = np.eye(len(_KINDS) + 2)[_KIND]
_LENGTHS = ((1, 1), (2, 3), (4, 6), (7, 10), (11, 1 << 40))

NAMES = (
    "log_bytes", *(f"share_{k}" for k in (*_KINDS, "wide", "control")), "entropy", "doubled",
    "word_length", "word_spread", "log_longest", "all_caps", "capitalised", "numbers", *(f"words_{a}_up" for a, _ in _LENGTHS),
    "gap", "again", "distinct", "top", "distinct_pairs", "per_stop", "per_line", "log_lines", "lines_stopped", "lines_again",
)

_STEP = np.uint64(0xD6E8FEB86659FD93)


def _distinct(group: np.ndarray, key: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each group, and the rows of its most frequent one."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    begins = np.ones(len(g), bool)
    begins[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(begins)
    most = np.zeros(groups, np.int64)
    np.maximum.at(most, g[at], np.diff(np.append(at, len(g))))
    return np.bincount(g[at], minlength=groups), most


def statistics(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """A row of ``NAMES`` for each text of a pack."""
    n, size = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n), size)

    def share(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        return rows / np.maximum(of, 1)

    def per(at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(at, weights, n).astype(np.float64)

    bytes_ = np.bincount(doc * 256 + raw, minlength=n * 256).reshape(n, 256)
    p = share(bytes_, size[:, None])
    kinds = bytes_ @ _KIND_OF
    out: list[np.ndarray] = [np.log1p(size), *share(kinds, size[:, None]).T]
    out.append(-(p * np.log2(np.where(p > 0, p, 1))).sum(1))
    twice = (raw[1:] == raw[:-1]) & (doc[1:] == doc[:-1]) & (raw[1:] > 0x20)
    out.append(share(per(doc[1:][twice]), size))

    w = Words(offsets, raw)
    words = np.diff(w.first)
    of, length = np.repeat(np.arange(n), words), w.end - w.start
    total = per(of, length)
    mean = share(total, words)
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    upper, digit = (np.concatenate([[0], np.cumsum(_KIND[raw] == k)]) for k in (1, 2))
    upper, digit, first = upper[w.end] - upper[w.start], digit[w.end] - digit[w.start], _KIND[raw[w.start]] == 1
    caps = (upper == length) & (length > 1)
    out += [mean, np.sqrt(np.maximum(share(per(of, length.astype(np.float64) ** 2), words) - mean**2, 0)), np.log1p(longest)]
    out += [share(per(of[x]), words) for x in (caps, first & ~caps, digit == length, *((length >= a) & (length <= b) for a, b in _LENGTHS))]
    out.append(share(size - total, words))
    same = of[1:] == of[:-1]
    out.append(share(per(of[1:][same & (w.hash[1:] == w.hash[:-1])]), words))
    distinct, most = _distinct(of, w.hash, n)
    pairs = of[1:][same]
    out += [share(distinct, words), share(most, words)]
    out.append(share(_distinct(pairs, mix(w.hash[:-1] * _STEP + w.hash[1:])[same], n)[0], per(pairs)))

    stops = kinds[:, list(_KINDS).index("stop")]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    brk = np.flatnonzero(raw == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], brk + 1]))
    starts = starts[starts < len(raw)]
    # a line ends at its break or with its text (a text begins where the one before ends)
    ends = np.minimum(np.append(brk, len(raw))[np.searchsorted(brk, starts)], offsets[1:][doc[starts]])
    full = ends > starts
    starts, ends = starts[full], ends[full]
    line = doc[starts]
    lines = per(line)
    stopped = _KIND[raw[ends - 1]] == list(_KINDS).index("stop")
    out += [words / (1 + stops), share(words, lines), np.log1p(lines), share(per(line[stopped]), lines)]
    out.append(1 - share(_distinct(line, span_hashes(raw, starts, ends), n)[0], lines) - (lines == 0))
    return np.stack(out, 1)


@dataclass
class Trees:
    """Complete binary trees of one depth: ``feature`` and ``threshold`` by level order, ``leaf`` from left to right."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The sum of the leaves that each row reaches, all trees at once."""
        trees = np.arange(len(self.feature))
        at = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        inner = self.feature.shape[1] if len(trees) else 0
        while inner and len(x) and at[0, 0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        return self.base + (self.leaf[trees, at - inner].sum(1) if len(trees) else np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.margin(x))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _grow(bins: np.ndarray, widths: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree: feature and bin of each inner node (bin ``BINS``: all go left), leaf values, and each row's leaf."""
    rows, columns = bins.shape
    feature, cut = np.zeros((1 << DEPTH) - 1, np.int64), np.full((1 << DEPTH) - 1, BINS, np.int64)
    node = np.zeros(rows, np.int64)
    # a cell for each (feature, bin); a node's cells are one histogram
    cell = bins + np.arange(columns) * BINS
    for level in range(DEPTH):
        nodes = 1 << level
        at = ((node[:, None] * columns * BINS) + cell).ravel()
        g, h = (np.bincount(at, np.repeat(x, columns), nodes * columns * BINS).reshape(nodes, columns, BINS).cumsum(2) for x in (gradient, curvature))
        all_g, all_h = g[:, :, -1:], h[:, :, -1:]
        gain = g**2 / (h + PULL) + (all_g - g) ** 2 / (all_h - h + PULL) - all_g**2 / (all_h + PULL)
        gain[(h < LEAST) | (all_h - h < LEAST) | (np.arange(BINS) >= widths[:, None])] = 0
        best = gain.reshape(nodes, -1).argmax(1)
        worth = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
        own = np.arange(nodes) + nodes - 1
        feature[own], cut[own] = best // BINS, np.where(worth, best % BINS, BINS)
        node = 2 * node + (bins[np.arange(rows), feature[own][node]] > cut[own][node])
    g, h = (np.bincount(node, x, 1 << DEPTH) for x in (gradient, curvature))
    return feature, cut, -RATE * g / (h + PULL), node


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boost ``trees`` trees on rows ``x`` with labels 0 and 1."""
    share = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
    base = float(np.log(share / (1 - share)))
    inner = (1 << DEPTH) - 1
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(c, quantiles, method="lower")) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    widths = np.array([len(e) for e in edges])
    limits = np.full((len(edges), BINS + 1), np.inf)
    for i, e in enumerate(edges):
        limits[i, : len(e)] = e
    margin = np.full(len(y), base)
    grown = []
    for _ in range(trees):
        p = _logistic(margin)
        feature, cut, leaf, node = _grow(bins, widths, p - y, p * (1 - p))
        margin += leaf[node]
        grown.append((feature, limits[feature, cut], leaf))
    return Trees(*(np.stack(c) for c in zip(*grown, strict=True)), base)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label must not be learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _packs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of a few texts with their statistics."""
    for batch in slices(batches):
        offsets, raw = ragged(batch.column(column))
        for i, j in packs(offsets):
            yield batch.slice(i, j - i), statistics(offsets[i : j + 1] - offsets[i], raw[offsets[i] : offsets[j]])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, found in _packs(batches, 1):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(found), pa.list_(pa.float64()))], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Learn from about ``rows`` labelled rows at most, picked by a hash of the id."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("most")).filter("label = most").select("id", "label")
    n = known.count()
    if n > rows:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    # about ``rows`` ids: small enough to send to the documents, whose texts then stay where they are
    sample = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).join(F.broadcast(staged(known)), "id").select("label", "text")
    found = sample.mapInArrow(_described, "label int, x array<double>").toPandas()
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, len(NAMES)))
    y = found["label"].to_numpy(np.float64)
    order = np.lexsort((*x.T[::-1], y))  # the same trees whatever order the rows came in
    return fit(x[order], y[order])


def _score(trees: Trees, place: int, passed: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _packs(batches, place):
            yield pa.RecordBatch.from_arrays([*batch.columns[:passed], pa.array(trees.probability(found))], names=[*batch.schema.names[:passed], name])

    return run


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns (the id alone unless given) with the score, a number from 0 to 1, as ``name``."""
    names = keep or [id_col]
    rows = docs.select(*names) if text_col in names else docs.select(*names, text_col)
    schema = docs.select(*names).schema.add(name, "double")
    return rows.mapInArrow(_score(trees, rows.columns.index(text_col), len(names), name), schema)


def digest(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The query's columns: ``doc_id, held_out, score, predicted``."""
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
