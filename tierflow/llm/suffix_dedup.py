"""Suffix-array dedup: remove bytes that repeat a 50-byte string of an earlier document.

A byte goes when it lies in a string of ``SPAN`` bytes that also starts in a
document with a smaller id; strings are judged on the input and never cross
documents. The work is dealt out so that a suffix order is only ever built
over strings that can match:

1. *Units.* Every window of ``SPAN`` bytes is keyed by the smallest hash among
   its ``GRAM``-byte grams, so equal windows have equal keys. A unit is a
   maximal run of windows of one document with the same key (about 15 bytes
   apart). Tasks send one fixed-width record a unit, dealt by key.
2. *Repeats.* A unit equal to a unit of an earlier document is removed whole.
   Units whose key occurs in several documents, but not as the same unit, are
   asked for; they are the borders of repeats and a few chance hits.
3. *Longest previous factors.* The bytes of these units meet by key. Their
   windows are put in suffix order, to a depth of ``SPAN`` and with ties in
   text order, by doubling ranks; the prefixes that neighbours share are
   counted. The previous and the next suffix of a smaller document in that
   order give each window's longest previous factor; where it reaches ``SPAN``
   the window is a later copy, and the first one stays.
4. *Removal.* Ranges return to their documents by ``doc_id``.

Hot groups: within a pack of texts, only the first unit of a key is sent on;
later equal ones are decided there, later unequal ones asked for at once. Keys
held by more than one in ``HOT_SHARE`` units (so at most that many, sent to
the tasks as a list) are dealt by single windows instead, which spreads them.
Everything else is dealt by hash, and no group is ever gathered whole.

Equality of whole units is by their key and a 48-bit hash of their bytes;
borders are compared byte by byte.

Cases: NULL and empty texts have 0 bytes and the hash of nothing; texts under
``SPAN`` bytes are kept; rows with a NULL ``doc_id`` are kept whole and serve
no other row; repeated ids are not smaller than each other, so such rows do
not remove one another's bytes (rows with equal id and different texts are
each judged by their own text); very long texts are handled in slices.
Columns other than the id and the text are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import PACK_BYTES, loads, mix, named, packs, planes, ragged, shuffle_parts, slices, span_hashes, spread, staged, text_bytes, unplanes, utf8

SPAN = 50
GRAM = 20
HOT_SHARE = 10_000
#: Windows of one text handled at once; a longer text is cut there (units end, windows do not).
SLICE = 1 << 21

_C1, _C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)
_LOW32 = np.uint64((1 << 32) - 1)
_LOW48 = np.uint64((1 << 48) - 1)
_RECORD = (("key", np.uint64), ("unit", np.uint64), ("doc", np.int64), ("lo", np.uint32), ("n", np.uint32), ("more", np.uint32))
FULL, ASK, HOT, MINE = 1, 2, 3, 4


def _grams(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` (20) bytes that start at each place."""
    x = raw.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    a, b, c = x[: len(x) - 12], x[8 : len(x) - 4], x[12:]
    return mix(a * _C1 ^ (b * _C2 + (c >> np.uint64(29)) + c * _C1))


def _window_keys(raw: np.ndarray, span: int) -> np.ndarray:
    """The least gram hash of each window of ``span`` bytes."""
    low = _grams(raw)
    width, have = span - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _slices(offsets: np.ndarray, raw: np.ndarray, docs: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Packs as (starts, ends, doc row, place in its text) over bytes that array code can hold."""
    for i, j in packs(offsets):
        size = offsets[j] - offsets[i]
        if j - i > 1 or size <= SLICE + span:
            yield raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], np.arange(i, j), np.zeros(j - i, np.int64)
        else:
            for at in range(0, int(size) - span + 1, SLICE):
                piece = raw[offsets[i] + at : min(offsets[i] + at + SLICE + span - 1, offsets[j])]
                yield piece, np.array([0, len(piece)]), np.array([i]), np.array([at])


def _units(raw: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Units of a pack: text number, first window, number of windows, key and hash of the bytes."""
    n = len(raw)
    if n < span:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    keys = _window_keys(raw, span)
    long = np.diff(offsets) >= span
    step = np.zeros(n + 1, np.int8)
    step[offsets[:-1][long]] += 1
    np.subtract.at(step, offsets[1:][long] - span + 1, 1)
    valid = np.cumsum(step[: len(keys)], dtype=np.int8).astype(bool)
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (keys[1:] != keys[:-1])
    at = offsets[:-1][long]
    begins[at] = True
    ends = np.zeros(len(keys) + 1, bool)
    ends[1:] = valid
    ends[1:-1] &= ~valid[1:] | begins[1:]
    lo, hi = np.flatnonzero(begins), np.flatnonzero(ends)
    text = np.searchsorted(offsets, lo, "right") - 1
    return text, lo, hi - lo, keys[lo] & _LOW48, span_hashes(raw, lo, hi + (span - 1)) & _LOW48


def _record_blob(fields: dict[str, np.ndarray]) -> bytes:
    return np.int64(len(fields["key"])).tobytes() + b"".join(planes(fields[name].astype(t)) for name, t in _RECORD)


def _records(blobs: list) -> dict[str, np.ndarray]:
    parts: dict[str, list] = {name: [] for name, _ in _RECORD}
    for blob in blobs:
        n, view = int(np.frombuffer(blob, np.int64, 1)[0]), memoryview(blob)[8:]
        for name, t in _RECORD:
            size = np.dtype(t).itemsize * n
            parts[name].append(unplanes(view[:size], t, n))
            view = view[size:]
    return {name: np.concatenate(parts[name]) if parts[name] else np.zeros(0, t) for name, t in _RECORD}


def _range_rows(kind: int, doc: np.ndarray, *fields: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """One (kind, doc, ranges) row for each document; a range is first window, windows, hash of its bytes[, key]."""
    if not len(doc):
        return
    order = np.lexsort((fields[0], doc))
    doc, pairs = doc[order], np.stack([(x[order].astype(np.uint64) & _LOW32).astype(np.uint32) for x in fields], 1)
    cut = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(doc)], strict=True):
        yield kind, int(doc[a]), pairs[a:b].tobytes()


def _own_ranges(text: np.ndarray, blobs: list[bytes], span: int, fields: int = 3) -> np.ndarray:
    """The ranges that hold for this text: rows under one id may have different texts."""
    ranges = np.concatenate([np.frombuffer(x, np.uint32).reshape(-1, fields) for x in blobs]).astype(np.int64)
    ranges = ranges[ranges[:, 0] + ranges[:, 1] + span - 1 <= len(text)]
    sums = span_hashes(text, ranges[:, 0], ranges[:, 0] + ranges[:, 1] + span - 1) & _LOW32
    return ranges[sums == ranges[:, 2].astype(np.uint64)]


_ROWS = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc", pa.int64()), ("blob", pa.binary())])
ROWS_DDL = "part int, kind int, doc long, blob binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns, whether a row begins a new group."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _send_units(parts: int, span: int):
    """Pack by pack: unit records dealt by key, and what the pack alone already decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets, raw = ragged(batch.column(1))
            for piece, at, rows, place in _slices(offsets, raw, ids, span):
                text, lo, n, key, unit = _units(piece, at, span)
                if not len(text):
                    continue
                doc, lo = ids[rows[text]], lo - at[text] + place[text]
                order = np.lexsort((doc, unit, key))
                doc, lo, n, key, unit = (x[order] for x in (doc, lo, n, key, unit))
                new_unit = _first_of(key, unit)
                first_doc = doc[np.maximum.accumulate(np.where(new_unit, np.arange(len(doc)), 0))]
                full = doc > first_doc
                again = ~new_unit & ~full  # the same text twice under one id: the first stands for both
                group = np.cumsum(_first_of(key)) - 1
                least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, group, np.where(full | again, np.iinfo(np.int64).max, doc))
                # the first unit of the least document of a key is sent on for all of the pack
                lead = np.flatnonzero(~full & ~again & (doc == least[group]))
                lead = lead[_first_of(group[lead])]
                many = np.bincount(group)
                ask = ~full
                ask[lead] = False
                rows_out = [*_range_rows(FULL, doc[full], lo[full], n[full], unit[full]), *_range_rows(ASK, doc[ask], lo[ask], n[ask], unit[ask], key[ask])]
                out = [(int(d % parts), k, d, blob) for k, d, blob in rows_out]
                fields = {"key": key[lead], "unit": unit[lead], "doc": doc[lead], "lo": lo[lead], "n": n[lead], "more": many[group[lead]] - 1 - np.bincount(group, full)[group[lead]].astype(np.int64)}
                to = (fields["key"] >> np.uint64(20)) % np.uint64(parts)
                order = np.lexsort((fields["lo"], fields["doc"], to))
                fields, to = {k: v[order] for k, v in fields.items()}, to[order]
                cut = np.flatnonzero(_first_of(to)).tolist()
                for a, b in zip(cut, [*cut[1:], len(to)], strict=True):
                    out.append((int(to[a]), MINE, 0, _record_blob({k: v[a:b] for k, v in fields.items()})))
                yield _batch(out)

    return run


def _decide_units(hot_from: int):
    """All records of some keys: whole repeats, units to ask for, and hot keys. Other rows pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            mine = np.asarray(batch.column(1)) == MINE
            blobs += [b for b, m in zip(batch.column(3).to_pylist(), mine.tolist(), strict=True) if m]
            if not mine.all():
                yield batch.filter(pa.array(~mine))
        r = _records(blobs)
        del blobs
        if not len(r["key"]):
            return
        order = np.lexsort((r["doc"], r["unit"], r["key"]))
        key, unit, doc, lo, n, more = (r[name][order] for name, _ in _RECORD)
        del r
        new_unit, new_key = _first_of(key, unit), _first_of(key)
        first_doc = doc[np.maximum.accumulate(np.where(new_unit, np.arange(len(doc)), 0))]
        full = doc > first_doc
        group = np.cumsum(new_key) - 1
        units = np.bincount(group, ~full) + np.bincount(group, more)
        ask = ~full & (units > 1)[group]
        rows = [*_range_rows(FULL, doc[full], lo[full], n[full], unit[full]), *_range_rows(ASK, doc[ask], lo[ask], n[ask], unit[ask], key[ask])]
        out = [(0, k, d, blob) for k, d, blob in rows]
        out += [(0, HOT, 0, k.tobytes()) for k in key[new_key][units >= hot_from]]
        for i in range(0, len(out), 5000):
            yield _batch(out[i : i + 5000])

    return run


def _send_bytes(parts: int, span: int, hot: np.ndarray):
    """The bytes of the units that were asked for, dealt by key (by window for hot keys)."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        doc, lo, route = (np.concatenate([h[i] for h in held]) for i in range(3))
        size = np.concatenate([h[3] for h in held])
        data = np.concatenate([h[4] for h in held])
        begin = np.cumsum(size) - size
        order = np.argsort(route % parts, kind="stable")
        doc, lo, route, size, begin = (x[order] for x in (doc, lo, route, size, begin))
        cut = np.flatnonzero(_first_of(route % parts)).tolist()
        out = []
        for a, b in zip(cut, [*cut[1:], len(doc)], strict=True):
            blob = b"".join((np.int64(b - a).tobytes(), *(planes(x[a:b].astype(t)) for x, t in ((doc, np.int64), (lo, np.uint32), (route, np.uint32), (size, np.uint32))), data[spread(begin[a:b], size[a:b])].tobytes()))
            out.append((int(route[a] % parts), MINE, 0, blob))
        return _batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            offsets, raw = ragged(batch.column(1))
            held: list[tuple] = []
            size = 0
            for row, asked in enumerate(batch.column(2).to_pylist()):
                text = raw[offsets[row] : offsets[row + 1]]
                lo, n, _, key = _own_ranges(text, asked, span, 4).T
                split = np.isin(key, hot)
                if split.any():  # one piece for each window
                    single = spread(lo[split], n[split])
                    lo, n, key = (np.concatenate([x[~split], y]) for x, y in ((lo, single), (n, np.ones_like(single)), (key, (span_hashes(text, single, single + span) & _LOW32).astype(np.int64))))
                length = n + span - 1
                held.append((np.full(len(lo), ids[row], np.int64), lo, key, length, text[spread(lo, length)]))
                size += int(length.sum())
                if size > 2 * PACK_BYTES:
                    yield flush(held)
                    held, size = [], 0
            if size:
                yield flush(held)

    return run


def _pieces(blob: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    view = memoryview(blob)[8:]
    doc, lo, route, size = unplanes(view, np.int64, n), *(unplanes(view[(8 + 4 * i) * n :], np.uint32, n) for i in range(3))
    return doc, lo, route, size, np.frombuffer(view[20 * n :], np.uint8)


def suffix_ranks(buffer: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the ``depth``-byte prefixes of the suffixes at ``starts``, by doubling.

    Needs ``depth`` bytes after each start and 8 <= depth. Ranks of 8 bytes come
    from the bytes as one big-endian number; each round doubles the length, the
    last overlaps. Places whose rank is never asked for are left out.
    """
    level = [depth]
    while level[-1] > 8:
        level.append(-(-level[-1] // 2) if level[-1] <= 16 else 1 << (level[-1] - 1).bit_length() - 1)
    level = sorted({max(8, x) for x in level})
    wanted = [starts]
    for big, small in zip(reversed(level), reversed(level[:-1]), strict=False):
        need = np.zeros(len(buffer), bool)
        need[wanted[-1]] = True
        need[wanted[-1] + (big - small)] = True
        wanted.append(np.flatnonzero(need))
    wanted.reverse()
    at = wanted[0]
    value = np.zeros(len(at), np.uint64)
    for i in range(8):
        value = (value << np.uint64(8)) | buffer[at + i]
    rank = np.unique(value, return_inverse=True)[1]
    for small, big, at in zip(level[:-1], level[1:], wanted[1:], strict=True):
        place = np.zeros(len(buffer), np.int64)
        place[wanted[level.index(small)]] = rank
        rank = np.unique((place[at] << 32) | place[at + (big - small)], return_inverse=True)[1]
    back = np.zeros(len(buffer), np.int64)
    back[wanted[-1]] = rank
    return back[starts]


def common_prefixes(buffer: np.ndarray, one: np.ndarray, other: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, ``depth`` at most, that the suffixes at ``one`` and ``other`` have in common."""
    load = loads(buffer)[0]
    found = np.full(len(one), depth, np.int64)
    rows = np.arange(len(one))
    for k in range(0, depth, 8):
        differ = load[one[rows] + k] ^ load[other[rows] + k]
        ends = differ != 0
        low = differ[ends] & (~differ[ends] + np.uint64(1))  # the lowest bit that differs, in the lowest byte that does
        found[rows[ends]] = np.minimum(depth, k + np.log2(low.astype(np.float64)).astype(np.int64) // 8)
        rows = rows[~ends]
        if not len(rows):
            break
    return found


def _previous_smaller(owner: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the nearest one before it, in suffix order, of a smaller owner (0: none).

    ``shared`` is what neighbours share. Every place points back over places of
    owners that are not smaller, with the least prefix shared on the way; all
    pointers that do not rest yet jump to where their targets point, so the
    rounds grow with the logarithm of the longest way. A way on which nothing
    is shared any more is given up.
    """
    to, least = np.arange(-1, len(owner) - 1), shared.copy()
    least[:1] = 0
    going = np.flatnonzero((least > 0) & (owner[to] >= owner))
    while len(going):
        over = to[going]
        low, target = np.minimum(least[going], least[over]), to[over]
        low[target < 0] = 0
        least[going], to[going] = low, target
        going = going[(low > 0) & (owner[target] >= owner[going])]
    return least


def longest_previous_factors(buffer: np.ndarray, starts: np.ndarray, owner: np.ndarray, span: int) -> np.ndarray:
    """For each suffix the longest prefix, up to ``span``, that a suffix of a smaller owner shares.

    In suffix order (ranks of ``span`` bytes, ties by owner and place) that is
    the longer of the prefixes shared with the previous and with the next
    suffix of a smaller owner.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    order = np.lexsort((starts, owner, suffix_ranks(buffer, starts, span)))
    at, owners = starts[order], owner[order]
    shared = np.zeros(len(order), np.int64)
    shared[1:] = common_prefixes(buffer, at[:-1], at[1:], span)
    before = _previous_smaller(owners, shared)
    after = _previous_smaller(owners[::-1], np.concatenate([[0], shared[:0:-1]]))[::-1]
    factors = np.zeros(len(order), np.int64)
    factors[order] = np.maximum(before, after)
    return factors


def repeated_windows(buffer: np.ndarray, starts: np.ndarray, owner: np.ndarray, span: int) -> np.ndarray:
    """Whether each window also starts in an earlier owner: its longest previous factor reaches ``span``."""
    return longest_previous_factors(buffer, starts, owner, span) >= span


def _match_bytes(span: int):
    """Repeated windows among pieces that met, a bounded number of bytes (but whole keys) at a time."""

    def ranges(doc: np.ndarray, lo: np.ndarray, size: np.ndarray, buffer: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        begin = np.cumsum(size) - size
        n = size - span + 1
        piece, starts = np.repeat(np.arange(len(doc)), n), spread(begin, n)
        found = np.flatnonzero(repeated_windows(buffer, starts, doc[piece], span))
        at, piece = starts[found], piece[found]
        begins = np.ones(len(at), bool)
        begins[1:] = (at[1:] != at[:-1] + 1) | (piece[1:] != piece[:-1])
        cut = np.flatnonzero(begins)
        runs = np.diff(np.append(cut, len(at)))
        piece, at = piece[cut], at[cut]
        yield from _range_rows(FULL, doc[piece], lo[piece] + at - begin[piece], runs, span_hashes(buffer, at, at + runs + (span - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_pieces(b) for batch in batches for b in batch.column(3).to_pylist()]
        if not got:
            return
        doc, lo, route, size = (np.concatenate([g[i] for g in got]).astype(np.int64) for i in range(4))
        data = np.concatenate([g[4] for g in got])
        del got
        begin = np.cumsum(size) - size
        order = np.argsort(route, kind="stable")
        doc, lo, route, size, begin = (x[order] for x in (doc, lo, route, size, begin))
        heads = np.flatnonzero(_first_of(route))
        filled = np.cumsum(size)[heads] - size[heads]
        # cut before the first key of each further PACK_BYTES
        cut = heads[_first_of(filled // PACK_BYTES)].tolist()
        out = []
        for a, b in zip(cut, [*cut[1:], len(doc)], strict=True):
            out += [(0, k, d, blob) for k, d, blob in ranges(doc[a:b], lo[a:b], size[a:b], data[spread(begin[a:b], size[a:b])])]
            if len(out) > 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return run


_COUNTS = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()), ("kept_text", pa.string()))


def _remove(span: int, more: frozenset[str]):
    """Rows (doc_id, text, ranges, rest) to the result's, without text and ranges."""
    fields = _COUNTS[:4] + tuple(f for f in _COUNTS[4:] if f[0] in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            offsets, raw = ragged(batch.column(1))
            out: list[list] = [[] for _ in fields]
            for row, ranges in enumerate(batch.column(2).to_pylist()):
                text = raw[offsets[row] : offsets[row + 1]]
                removed = spans = 0
                if ranges:
                    pairs = _own_ranges(text, ranges, span)
                    mark = np.zeros(len(text) + 1, np.int32)
                    np.add.at(mark, pairs[:, 0], 1)
                    np.add.at(mark, pairs[:, 0] + pairs[:, 1] + (span - 1), -1)
                    gone = np.cumsum(mark[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = text[~gone].tobytes()
                else:
                    kept = text.tobytes()
                row_out = {"n_bytes": len(text), "n_removed": removed, "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}
                if "kept_text" in more:
                    row_out["kept_text"] = kept.decode("utf-8", "ignore")
                for values, (name, _) in zip(out, fields, strict=True):
                    values.append(row_out[name])
            arrays = [pa.array(values, t) for values, (_, t) in zip(out, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, *batch.columns[3:]], names=["doc_id", *(name for name, _ in fields), *batch.schema.names[3:]])

    return run


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, with_bytes: bool = False, with_text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept][, kept_text][, rest]``.

    ``kept`` is the remaining bytes, ``kept_text`` the text they make without
    cut characters, ``rest`` a struct of the ``keep`` columns.
    See the module's text for the method and the defined cases. ``span`` is at
    least 28. Runs jobs while it is built; what the unit pass finds is kept in
    the checkpoint folder.
    """
    if span < GRAM + 8:
        raise ValueError(f"span must be at least {GRAM + 8}")
    rows = docs.select(named(id_col, "doc_id"), named(text_col, "text"), *([F.struct(*keep).alias("rest")] if keep else []))
    if dict(rows.dtypes)["doc_id"] != "bigint":
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    total = text_bytes(rows)
    parts = shuffle_parts(docs.sparkSession, total, 8 << 20)
    # a unit starts about every 15 bytes; keys with more than this many units are at most HOT_SHARE
    hot_from = max(4096, total // 15 // HOT_SHARE)
    sent = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= span)).select("doc_id", utf8("text").alias("text")).mapInArrow(_send_units(parts, span), ROWS_DDL)
    decided = staged(sent.repartitionById(parts, F.col("part")).mapInArrow(_decide_units(hot_from), ROWS_DDL))
    hot = np.array([int(np.frombuffer(r[0], np.uint64)[0]) & int(_LOW32) for r in decided.filter(F.col("kind") == HOT).select("blob").collect()], np.int64)
    # the texts are dealt once: both joins below read the same exchange
    dealt = rows.filter(F.col("doc_id").isNotNull()).repartition(parts, "doc_id")
    rest = ["rest"] if keep else []

    def by_doc(found: DataFrame) -> DataFrame:
        return found.groupBy("doc").agg(F.collect_list("blob").alias("ranges")).withColumnRenamed("doc", "doc_id")

    asked = dealt.join(by_doc(decided.filter(F.col("kind") == ASK)), "doc_id").select("doc_id", utf8("text").alias("text"), "ranges", *rest)
    matched = asked.mapInArrow(_send_bytes(parts, span, hot), ROWS_DDL).repartitionById(parts, F.col("part")).mapInArrow(_match_bytes(span), ROWS_DDL)
    gone = decided.filter(F.col("kind") == FULL).unionByName(matched)
    judged = dealt.join(by_doc(gone), "doc_id", "left").select("doc_id", "text", "ranges", *rest)
    whole = rows.filter(F.col("doc_id").isNull()).withColumn("ranges", F.lit(None).cast("array<binary>"))
    both = judged.unionByName(whole).select("doc_id", utf8("text").alias("text"), "ranges", *rest)
    more = frozenset(name for name, on in (("kept", with_bytes), ("kept_text", with_text)) if on)
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "") + (", kept_text string" if with_text else "")
    if keep:
        ddl += f", rest {rows.schema['rest'].dataType.simpleString()}"
    return both.mapInArrow(_remove(span, more), ddl)


#: Every window of every text as a row: for tables of a few megabytes.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, rn, p, substr(h, 2 * p + 1, {2 * SPAN}) AS s FROM (SELECT doc_id, rn, h, unnest(range(greatest(length(h) // 2 - {SPAN} + 1, 0))) AS p FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.rn, w.p, lag(w.p) OVER (PARTITION BY w.rn ORDER BY w.p) AS q FROM w JOIN f USING (s) WHERE f.least < w.doc_id),
run AS (SELECT rn, p, q, sum(CASE WHEN q IS NULL OR p > q + {SPAN} THEN 1 ELSE 0 END) OVER (PARTITION BY rn ORDER BY p) AS k FROM hit),
cut AS (SELECT rn, k, min(p) AS a, max(p) + {SPAN} AS b FROM run GROUP BY rn, k),
gap AS (SELECT rn, a, b, lag(b, 1, 0) OVER (PARTITION BY rn ORDER BY a) AS c FROM cut),
kept AS (
  SELECT rn, count(*) AS spans, sum(b - a) AS gone, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k
  FROM gap JOIN d USING (rn) GROUP BY rn)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
"""
