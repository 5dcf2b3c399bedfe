"""Order MinHash near-dedup over shingles of five words.

Two documents are near-duplicates when their shingle sequences align to
``M / (n1 + n2 - M) >= threshold``, with ``M`` the shingles matched in order:
a Jaccard similarity that also asks for the order. A class is a connected
component of such links.

1. *Classes of equal words.* Each text becomes the hashes of its shingles.
   Texts with the same word sequence share a key (128 bits of a cryptographic
   hash of the words; 64 stand for it where that tells all apart) and go on as one.
2. *Sketches.* For each of ``SKETCHES`` hash functions the ``KEEP`` smallest
   occurrence-labelled shingles are kept in text order; their hash is a bucket.
   At similarity 0.8 a sketch agrees with probability about 0.5, so all of 24
   differ with probability under 1e-7.
3. *Leaders.* In each bucket every class is compared with the one whose
   sketches are the most crowded (the original of a family of variants), so a
   bucket of n classes gives n - 1 pairs: for each class first the pair with the
   most crowded of its leaders, then those whose ends these links do not join in
   two steps. Accepted links form components.
4. *The rest.* Buckets that still hold several components are compared within:
   their members but the leader, in blocks of a bounded size, meet with their shingles, pairs
   in one component are skipped, and only new links between components leave the
   task. Thus a bucket of any size is compared whole, and no pairs are sent.

A pair is accepted by a banded alignment (longest common subsequence by bit
vectors, limited to the diagonals the threshold allows), after the bounds that
lengths and shared shingles give.

Cases: texts of one to four words are one shingle; texts without words equal
only the same text (NULL counts as empty); repeated rows and repeated ids are
separate rows of the same or other classes; a class id is the smallest
``doc_id`` in it (NULL when it has none); other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import Words, components, free_name, mix, packs, ragged, shuffle_parts, slices, staged, text_bytes, utf8

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 24
KEEP = 3
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048
#: Shingles of one text that are hashed at once.
_SLICE = 1 << 17

_STEP = np.uint64(0xD6E8FEB86659FD93)
_FACTORS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


def text_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash for each ``size`` words in a row; fewer words are one shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    h = words[: len(words) - size + 1].copy()
    for i in range(1, size):
        h = mix(h * _STEP + words[i : len(words) - size + 1 + i])
    return h


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles made distinct by their occurrence number."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return shingles
    begins = np.concatenate([[True], ~same])
    place = np.arange(len(ordered))
    nth = np.zeros(len(ordered), np.uint64)
    nth[order] = (place - np.maximum.accumulate(np.where(begins, place, 0))).astype(np.uint64)
    return np.where(nth > 0, mix(shingles + nth * _STEP), shingles)


def sketches(shingles: np.ndarray) -> np.ndarray:
    """A bucket for each hash function: its smallest labelled shingles, in text order."""
    h = labelled(shingles)
    keep = min(KEEP, len(h))
    best = np.zeros((SKETCHES, 0), np.int64)
    for at in range(0, len(h), _SLICE):
        piece = h[at : at + _SLICE]
        k = min(keep, len(piece))
        low = np.argpartition(_FACTORS[:, None] * piece[None, :], k - 1, axis=1)[:, :k] + at
        best = np.concatenate([best, low], axis=1)
    if best.shape[1] > keep:
        again = np.argpartition(_FACTORS[:, None] * h[best], keep - 1, axis=1)[:, :keep]
        best = np.take_along_axis(best, again, axis=1)
    best.sort(axis=1)
    out = np.arange(SKETCHES, dtype=np.uint64)
    for i in range(keep):
        out = mix(out * _STEP + h[best[:, i]])
    return out


def _key(joined: bytes, raw: bytes) -> bytes:
    """128 bits of a cryptographic hash of the words; texts without words are told apart by their bytes."""
    return hashlib.blake2b(joined or b"-" + raw, digest_size=16).digest()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
    """Word hashes, words joined by spaces and bytes (only of texts without words) of each row."""
    offsets, raw = ragged(batch.column(column))
    for i, j in packs(offsets):
        w = Words(offsets[i : j + 1] - offsets[i], raw[offsets[i] : offsets[j]])
        first = w.first.tolist()
        for r, joined in zip(range(i, j), w.joined(), strict=True):
            words = w.hash[first[r - i] : first[r - i + 1]]
            yield words, joined, b"" if joined else raw[offsets[r] : offsets[r + 1]].tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, found = [], [], []
        for words, joined, raw in _texts(batch, 2):
            keys.append(_key(joined, raw))
            shingles = text_shingles(words)
            sizes.append(len(shingles))
            # one shingle: only the same words are similar, and the key has them
            found.append(sketches(shingles).view(np.int64) if len(shingles) > 1 else None)
        node, check = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), pa.array(check), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "tag", "node", "check", "n", "sketch"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of (node, text) rows."""
    for batch in batches:
        nodes, found, size = [], [], 0
        for node, (words, _, _) in zip(batch.column(0).to_pylist(), _texts(batch, 1), strict=True):
            nodes.append(node)
            found.append(text_shingles(words).tobytes())
            size += len(found[-1])
            if size > 16 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "shingles"])
                nodes, found, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "shingles"])


def matched_in_order(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence within ``band`` diagonals of the main one, by bit vectors.

    The window of columns ``i - band .. i + band`` moves with row ``i``; a zero
    bit is a column where the length grows, and columns that leave keep theirs.
    """
    head = 0
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        places[x] = places.get(x, 0) | (1 << j)
    width = 2 * band + 1
    mask = (1 << width) - 1
    grown, vector, low = 0, mask, -band  # bit k of vector is column low + k
    for x in a.tolist():
        match = places.get(x, 0)
        match = (match >> low if low >= 0 else match << -low) & mask
        u = vector & match
        vector = ((vector + u) | (vector - u)) & mask
        grown += not vector & 1
        vector = (vector >> 1) | (1 << (width - 1))
        low += 1
    grown += (~vector & mask).bit_count()
    return head + tail + grown


def similar(a: np.ndarray, b: np.ndarray, sorted_a: np.ndarray, sorted_b: np.ndarray, threshold: float) -> bool:
    """Whether two shingle sequences align to ``threshold``; ``sorted_*`` are their labelled shingles, sorted."""
    n, m = len(a), len(b)
    if min(n, m) < threshold * max(n, m):
        return False
    need = threshold * (n + m) / (1 + threshold) - 1e-9  # matches that reach the threshold
    at = np.searchsorted(sorted_b, sorted_a)
    at[at == m] = 0
    if int((sorted_b[at] == sorted_a).sum()) < need:
        return False
    return matched_in_order(a, b, int(n + m - 2 * need) + 1) >= need


def _verify_pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(similar(a, b, np.sort(labelled(a)), np.sort(labelled(b)), threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block_links(rows: list[tuple], threshold: float) -> Iterator[tuple[int, int]]:
    """The components that new links among the members of a bucket (or of two of its blocks) join."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    members = []
    for node, component, mine, blob in sorted(rows, key=lambda r: r[0]):
        a = np.frombuffer(blob, np.uint64)
        members.append((node, component, mine, a, np.sort(labelled(a))))
    size = np.array([len(m[3]) for m in members])
    for i, (_, component, mine, a, sa) in enumerate(members):
        near = np.flatnonzero((np.minimum(size[i + 1 :], size[i]) >= threshold * np.maximum(size[i + 1 :], size[i]))) + i + 1
        for j in near.tolist():
            _, component2, mine2, b, sb = members[j]
            if mine is not None and mine == mine2:
                continue  # two members of one block meet in that block's own task
            if find(component) != find(component2) and similar(a, b, sa, sb, threshold):
                root[find(component)] = find(component2)
                yield component, component2


def _verify_blocks(threshold: float):
    """Rows sorted by block: (block key, node, component, own block or NULL, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = None, []

        def links() -> pa.RecordBatch:
            pairs = list(_block_links(rows, threshold))
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], names=["a", "b"])

        for batch in slices(batches):
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != held:
                    if len(rows) > 1:
                        yield links()
                    held, rows = key, []
                rows.append(tuple(row))
        if len(rows) > 1:
            yield links()

    return run


def _told_apart(sketched: DataFrame) -> DataFrame:
    """Rows whose first 64 bits agree but whose other 64 do not get a node of their own."""
    mixed = sketched.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo <> hi").select("node", F.lit(True).alias("mixed"))
    if not mixed.limit(1).count():
        return sketched
    node = F.when(F.col("mixed"), F.xxhash64("node", "check")).otherwise(F.col("node"))
    return staged(sketched.join(staged(mixed), "node", "left").withColumn("node", node).drop("mixed"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_shingles, copy_key, tag, class_key``.

    ``class_id`` is the smallest id of the document's class; ``copy_key`` is
    equal for equal word sequences, ``class_key`` within a class; ``tag`` is
    ``xxhash64`` of the text (0 for NULL), which with the id names a row. Runs jobs while it is built; what it needs
    again is written to the shared folder.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(text_col).alias("text"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tag")).withColumn("text", utf8("text"))
    parts = shuffle_parts(spark, text_bytes(texts))
    sketched = _told_apart(staged(texts.select("doc_id", "tag", "text").mapInArrow(_sketch, "doc_id long, tag long, node long, check long, n long, sketch array<long>")))
    nodes = sketched.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))

    buckets = nodes.filter("n > 1").select("node", F.posexplode("sketch").alias("j", "bucket")).select("node", F.xxhash64("j", "bucket").alias("bucket"))
    crowd = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = staged(buckets.join(crowd, "bucket"))
    central = staged(members.groupBy("node").agg(F.sum("size").alias("weight")))
    ranked = members.select("bucket", "node").join(central, "node")
    leader = ranked.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top")).select("bucket", F.col("top.node").alias("leader"), "top.weight")
    # a leader is above its members by weight and id, so a pair has one direction whatever the bucket
    led = staged(members.join(leader, "bucket").filter("node <> leader"))
    # most nodes are linked by the most crowded of their leaders; the other pairs are compared where they are not
    first = staged(led.groupBy("node").agg(F.max(F.struct("weight", "leader")).alias("top")).select(F.col("node").alias("a"), F.col("top.leader").alias("b")))

    # one text of each candidate node; a NULL id counts as 0 here, for rows with the same tag have the same text
    own = F.coalesce("doc_id", F.lit(0)).alias("own")
    chosen = sketched.select("node", own, "tag").join(central.select("node"), "node", "left_semi").groupBy("node").agg(F.min(F.struct("own", "tag")).alias("row")).select("node", "row.own", "row.tag")
    wanted = texts.select(own, "tag", "text").join(chosen, ["own", "tag"]).dropDuplicates(["own", "tag"])
    shingles = staged(wanted.select("node", "text").mapInArrow(_shingle_rows, "node long, shingles binary"))
    side = lambda name, other: shingles.select(F.col("node").alias(name), F.col("shingles").alias(other))

    def verified(pairs: DataFrame) -> DataFrame:
        check = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
        return staged(check.mapInArrow(_verify_pairs(threshold), "a long, b long"))

    links = verified(first)
    # each node has one of these links at most: where they lead in two steps
    step = links.select(F.col("a").alias("b"), F.col("b").alias("next"))
    roots = staged(links.join(step, "b", "left").select(F.col("a").alias("id"), F.coalesce("next", "b").alias("root")))
    place = lambda end: roots.select(F.col("id").alias(end), F.col("root").alias(f"{end}_in"))
    others = led.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    others = others.join(place("a"), "a", "left").join(place("b"), "b", "left").filter("coalesce(a_in, a) <> coalesce(b_in, b)").select("a", "b")
    links = links.unionByName(verified(others))
    found = staged(components(central.select(F.col("node").alias("id")), links))

    # buckets in which several components are left; their leaders were compared with all others
    placed = led.select("bucket", "node", "size").join(found.withColumnRenamed("id", "node"), "node")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("bucket")
    rest = placed.join(mixed, "bucket")
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    rest = rest.withColumn("blocks", count).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rest = rest.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    key = F.concat_ws("/", "bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    rest = rest.join(shingles, "node").select(key.alias("key"), "node", "component", F.when(F.col("other") != F.col("mine"), F.col("mine")).alias("mine"), "shingles")
    more = staged(rest.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_verify_blocks(threshold), "a long, b long"))
    if more.limit(1).count():
        ends = more.select(F.col("a").alias("id")).unionByName(more.select(F.col("b").alias("id")))
        joined = components(ends, more).select(F.col("id").alias("component"), F.col("component").alias("joined"))
        found = found.join(joined, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))

    classes = nodes.select("node", "least").join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("class_id"))
    of_node = classes.join(smallest, "component").select("node", "class_id", "component")
    return sketched.select("doc_id", "tag", "node", "n").join(of_node, "node").select("doc_id", "class_id", F.col("n").alias("n_shingles"), F.col("node").alias("copy_key"), "tag", F.col("component").alias("class_key"))


def keep_one(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the smallest id in each class; equal rows once. Only ids and hashes are compared."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("best")
    own, key = free_name(docs, "own"), free_name(docs, "winner")
    # an id as text, "" for none, so that rows are dealt once for both the copies and the winners
    text_id = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    winners = result.groupBy("class_key").agg(best).select(text_id("best.doc_id").alias(key), F.col("best.tag").alias(own))
    tagged = docs.withColumn(own, F.coalesce(F.xxhash64(text_col), F.lit(0))).withColumn(key, text_id(id_col))
    return tagged.dropDuplicates([key, own]).join(winners, [key, own], "left_semi").select(*docs.columns)


def first_of_class(result: DataFrame) -> DataFrame:
    """The digest: ``doc_id, class_id, kept`` (kept: the smallest id of its class)."""
    return result.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


