"""Helpers shared by the operators: packed arrays, staging, row identity, components.

Array code runs inside ``mapInArrow`` tasks, on packs of a bounded number of
text bytes, so a task's memory does not grow with its input.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import checkpoint_root

#: Text bytes that array code handles at once.
PACK_BYTES = 1 << 20

#: Bits of a bit table, as a power of two: 2 MiB, whatever the number of keys.
TABLE_BITS = 24

#: Edges of a graph that one task handles.
EDGES = 20_000

#: Spans of more values are hashed and compared one by one.
LONG_SPAN = 512

_SEED = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A folder without a scheme lies on the cluster's default file system, which
    need not be the executors' disks: Spark's own address of it has the scheme.
    """
    root = checkpoint_root(spark)
    if not urlparse(root).scheme:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/tierflow-llm/{what}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def staged(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared checkpoint folder (cuts the lineage).

    Spark removes the files when nothing refers to the result any more, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint()


def named(column: str, name: str) -> Column:
    """A column under a name, without an alias where it has it (so that equal exchanges are found equal)."""
    return F.col(column) if column == name else F.col(column).alias(name)


def shuffle_parts(spark: SparkSession, total_bytes: int, each: int = 16 << 20) -> int:
    """Partitions for ``total_bytes`` of text at about ``each`` bytes, at least the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // each), 1)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over all rows (one aggregate over that column alone)."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def utf8(column: str):
    """A text column as bytes, NULL as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary Arrow column as (offsets, bytes), without a copy; NULL counts as empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def packs(offsets: np.ndarray, limit: int = PACK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes (a longer row stands alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, for work that makes Python objects of them."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX2
    return x ^ (x >> np.uint64(33))


def loads(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The 64 bits that start at each value of a narrower unsigned array, masks by number of values, values a load."""
    width = 8 * values.itemsize
    each = 64 // width
    raw = np.zeros((len(values) + each) * values.itemsize + 8, np.uint8)
    raw[: values.nbytes] = np.ascontiguousarray(values).view(np.uint8)
    x = np.ndarray(len(values) + each, "<u8", raw, strides=(values.itemsize,)).copy()
    return x, np.array([(1 << (width * k)) - 1 for k in range(each + 1)], np.uint64), each


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of an unsigned array: equal spans get equal ones wherever they stand.

    Eight bytes at a time are multiplied and mixed; that is no proof of
    equality, so whoever acts on it compares the spans too (``same_spans``).
    """
    size = ends - starts
    out = size.astype(np.uint64) * _MIX2 + _SEED
    load, masks, each = loads(values)
    rows = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    at, left = starts[rows], size[rows]
    while len(rows):
        h = (out[rows] ^ (load[at] & masks[np.minimum(left, each)])) * _MIX1
        h ^= h >> np.uint64(32)
        out[rows] = h
        going = np.flatnonzero(left > each)
        rows, at, left = rows[going], at[going] + each, left[going] - each
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        digest = hashlib.blake2b(values[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return mix(out)


def same_spans(values: np.ndarray, starts: np.ndarray, others: np.ndarray, size: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """Whether the ``size`` values from ``starts`` are those from ``others`` (in ``among``, if given)."""
    load, masks, each = loads(values)
    if among is None:
        among, other_load = values, load
    else:
        other_load = loads(among)[0]
    same = np.ones(len(starts), bool)
    rows = np.flatnonzero((size > 0) & (size <= LONG_SPAN) & (starts != others if among is values else True))
    at, to, left = starts[rows], others[rows], size[rows]
    while len(rows):
        equal = ((load[at] ^ other_load[to]) & masks[np.minimum(left, each)]) == 0
        if not equal.all():
            same[rows[~equal]] = False
        going = np.flatnonzero(equal & (left > each))
        rows, at, to, left = rows[going], at[going] + each, to[going] + each, left[going] - each
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        same[i] = np.array_equal(values[starts[i] : starts[i] + size[i]], among[others[i] : others[i] + size[i]])
    return same


def distinct_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an example of each distinct span, the place of each span's example): found by hash, decided by the values."""
    found = span_hashes(values, starts, ends)
    order = np.argsort(found)  # not a stable sort, which takes several times as long
    found = found[order]
    begins = np.ones(len(found), bool)
    begins[1:] = found[1:] != found[:-1]
    which = np.empty(len(found), np.int64)
    which[order] = np.cumsum(begins) - 1
    example = np.minimum.reduceat(order, np.flatnonzero(begins)) if len(order) else order
    size = ends - starts
    first = example[which]
    same = size == size[first]
    same[same] = same_spans(values, starts[same], starts[first[same]], size[same])
    if not same.all():  # unlike spans with one hash
        found: dict[bytes, int] = {}
        for i in np.flatnonzero(~same).tolist():
            key = values[starts[i] : ends[i]].tobytes()
            if key not in found:
                found[key] = len(example)
                example = np.append(example, i)
            which[i] = found[key]
    return example, which


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


class Words:
    """Words of a pack of texts: runs of digits, letters a-z and non-ASCII, A-Z in lower case.

    ``start``/``end`` are byte places, ``first[i]`` is the number of words
    before text ``i`` and ``hash`` a 64-bit hash of each word (equal words have
    equal ones; unlike words may).
    """

    def __init__(self, offsets: np.ndarray, raw: np.ndarray):
        self.bytes = _FOLD[raw]
        inside = _WORD[self.bytes]
        n = len(inside)
        begins, ends = inside.copy(), np.zeros(n + 1, bool)
        begins[1:] &= ~inside[:-1]
        ends[1:n] = inside[:-1] & ~inside[1:]
        if n:
            ends[n] = inside[-1]
            edge = np.unique(offsets[(offsets > 0) & (offsets < n)])
            begins[edge] |= inside[edge]
            ends[edge] |= inside[edge - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(self.bytes, self.start, self.end)
        self._offsets, self._inside = offsets, inside

    def text(self, i: int, j: int) -> list[bytes]:
        """Words ``i`` to ``j - 1`` as bytes."""
        return [self.bytes[s:e].tobytes() for s, e in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)]

    def joined(self) -> list[bytes]:
        """Each text's words with one space between."""
        keep, raw = self._inside.copy(), self.bytes.copy()
        first = np.zeros(len(self.start) + 1, bool)
        first[self.first] = True
        gap = self.start[~first[:-1]] - 1  # before every word but a text's first
        keep[gap], raw[gap] = True, 0x20
        at = np.concatenate([[0], np.cumsum(keep)])[self._offsets].tolist()
        kept = raw[keep].tobytes()
        return [kept[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i] + 0 .. counts[i] - 1`` for every i, in one array."""
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.repeat(starts.astype(np.int64) - (ends - counts), counts) + np.arange(total)


def planes(values: np.ndarray) -> bytes:
    """Fixed-width integers with equal-weight bytes together, which shuffle compression packs well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(blob, dtype, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8, width * n).reshape(width, n).T).view(dtype).ravel()


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash, in a table of ``2**TABLE_BITS`` bits (at most 2**18 rows come back)."""
    slot = F.col(column).bitwiseAND((1 << TABLE_BITS) - 1)
    rows = hashes.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for at, bits in rows:
        table[at] = bits
    return table.view(np.uint8)


def bit_hits(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places whose hash is in the table (or shares a bit with one that is)."""
    slot = hashes & ((1 << TABLE_BITS) - 1)
    return np.flatnonzero((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)


def _signature(edges: DataFrame) -> tuple:
    """Number of distinct edges and two sums of their hashes: equal for equal sets, and for others hardly ever."""
    one, two = F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(38,0)")), F.sum(two.cast("decimal(38,0)"))).first())


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over undirected ``edges`` (a, b).

    Alternating large-star and small-star rounds as joins and aggregates,
    each written to the shared folder; the number of edges never grows and
    the rounds grow with the logarithm of the longest path. A hot node's
    rows are aggregated before the shuffle; the join back is a plain
    equi-join, which adaptive execution splits when skewed. What is shuffled
    comes from as many tasks as the edges need, for each leaves a file. NULL ids must
    not occur; ids without an edge are their own component; an empty graph
    returns ``nodes`` as they are.
    """
    current = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = _signature(current)
    for _ in range(max_rounds):
        tasks = max(1, -(-sign[0] // EDGES))
        current = current.coalesce(tasks)
        # large star: every neighbour at least as large as the node meets the least of all
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        # small star: every smaller neighbour and the node itself meet the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b")
        current, before = staged(small.coalesce(tasks).distinct().coalesce(tasks)), sign
        sign = _signature(current)
        if sign == before:
            break
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    root = current.coalesce(tasks).groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return nodes.select("id").distinct().join(root, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
