"""Benchmark decontamination: a prefix-filtered join of item-sized windows.

A window is ``window`` consecutive words of an item (all words of a shorter,
non-empty item); it occurs in a document where the same words stand in a row.
Containment must be whole, so of a window's shingles, taken in order of rarity,
one is a sufficient prefix: the rarest. The steps:

1. The items' shingles (``SHINGLE`` words, or all of a shorter window) are
   hashed. A bit table of fixed size (2 MiB, whatever the items) holds them.
2. One pass over all documents counts the shingles that pass the table;
   windows with a shingle that no document has are dropped, the others keep
   their rarest as prefix token.
3. A second pass sends each document's places of prefix tokens with the words
   around them. They are joined to the windows by token; length and position
   bounds cut windows that would begin before or end after the text, and the
   words themselves are compared.

Items are never gathered: beyond the bit table both sides meet in joins whose
strategy Spark chooses by size, and adaptive execution splits a token that
many documents share.

Words are runs of ASCII digits, letters (A-Z as a-z) and non-ASCII characters.

Cases: NULL and empty texts have no words; items without words have no window;
equal windows of several items count for each (items with a NULL id for hits, not
as items); items that repeat with the same
id count once; equal documents repeat in the result; documents under one id
are judged by their own text; other columns are not read; an empty table of
items leaves every document without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import Words, bit_hits, bit_table, free_name, mix, packs, ragged, staged, utf8

WINDOW = 13
SHINGLE = 3

_STEP = np.uint64(0xD6E8FEB86659FD93)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each ``size`` words in a row, as a signed 64-bit integer."""
    if len(words) < size:
        return np.zeros(0, np.int64)
    h = words[: len(words) - size + 1].copy()
    for i in range(1, size):
        h = mix(h * _STEP + words[i : len(words) - size + 1 + i])
    return mix(h + np.uint64(size)).view(np.int64)


def _item_windows(window: int):
    """Rows (item, windows): words of each window and the hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            offsets, raw = ragged(batch.column(1))
            w = Words(offsets, raw)
            item, words, hashes = [], [], []
            for i in range(len(ids)):
                a, b = int(w.first[i]), int(w.first[i + 1])
                if a == b:
                    continue
                text, n = w.text(a, b), min(window, b - a)
                found = _shingles(w.hash[a:b], min(SHINGLE, n)).tolist()
                for s in range(b - a - n + 1):
                    item.append(i)
                    words.append(text[s : s + n])
                    hashes.append(found[s : s + n - min(SHINGLE, n) + 1])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(item, pa.int32())), pa.array(words, pa.list_(pa.binary())), pa.array(hashes, pa.list_(pa.int64()))], names=["item_id", "words", "hashes"])

    return run


def _count(table: np.ndarray, sizes: list[int]):
    """(hash, n) of the shingles that pass the table, pre-aggregated by pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = ragged(batch.column(0))
            for i, j in packs(offsets):
                w = Words(offsets[i : j + 1] - offsets[i], raw[offsets[i] : offsets[j]])
                found = [h[bit_hits(h, table)] for h in (_shingles(w.hash, s) for s in sizes)]
                h, n = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return run


_PLACE = pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.list_(pa.binary()))])


def _places(table: np.ndarray, sizes: list[int], window: int):
    """For each text its number of words and its places of prefix tokens with the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = ragged(batch.column(2))
            for i, j in packs(offsets):
                w = Words(offsets[i : j + 1] - offsets[i], raw[offsets[i] : offsets[j]])
                lists: list[list[dict]] = [[] for _ in range(i, j)]
                for size in sizes:
                    h = _shingles(w.hash, size)
                    at = bit_hits(h, table)
                    doc = np.searchsorted(w.first, at, "right") - 1
                    inside = at + size <= w.first[doc + 1]  # a shingle does not cross texts
                    for d, p in zip(doc[inside].tolist(), at[inside].tolist(), strict=True):
                        a = max(p - window + 1, int(w.first[d]))
                        b = min(p + window, int(w.first[d + 1]))
                        lists[d].append({"hash": int(h[p]), "at": p - int(w.first[d]), "lead": p - a, "around": w.text(a, b)})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(w.first)), pa.array(lists, pa.list_(_PLACE))], names=["doc_id", "tag", "n_words", "places"])

    return run


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, spans, items, tag``.

    ``spans`` are the occurrences as (first word, words), in order; ``items``
    the ids whose windows occur; ``n_hit`` the words inside any of them; ``tag`` is
    ``xxhash64`` of the text (0 for NULL), which with the id names a row. Runs
    jobs while it is built: shingle counts over all documents.
    """
    item_type = items.schema[item_col].dataType.simpleString()
    # the item's words decide, so an id may come with several texts
    windows = items.select(F.col(item_col).alias("item_id"), utf8(item_text_col).alias("text")).distinct()
    windows = staged(windows.mapInArrow(_item_windows(window), f"item_id {item_type}, words array<binary>, hashes array<long>").distinct())
    sizes = [r[0] for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("s")).distinct().collect()]
    sizes.sort()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tag"), utf8(text_col).alias("text"))

    shingles = windows.select("words", F.posexplode("hashes").alias("place", "hash"))
    table = bit_table(shingles.select("hash").distinct(), "hash")
    counted = texts.select("text").mapInArrow(_count(table, sizes), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    # the rarest shingle of each window; a window with an unseen one cannot occur
    rarest = shingles.distinct().join(counted, "hash", "left").groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "place")).alias("p"))
    prefix = staged(windows.select("item_id", "words").join(rarest.filter("p.n > 0"), "words").select("p.hash", "p.place", "words", "item_id"))

    table = bit_table(prefix.select("hash").distinct(), "hash")
    doc_type = docs.schema[id_col].dataType.simpleString()
    found = texts.mapInArrow(_places(table, sizes, window), f"doc_id {doc_type}, tag long, n_words long, places array<struct<hash: long, at: long, lead: int, around: array<binary>>>")
    # a first row without a token stands for the document itself
    rows = found.select("doc_id", "tag", "n_words", F.explode(F.concat(F.array(F.lit(None).cast("struct<hash: long, at: long, lead: int, around: array<binary>>")), "places")).alias("x"))
    rows = rows.select("doc_id", "tag", "n_words", "x.*").join(prefix, "hash", "left")
    length = F.size("words")
    start = F.col("at") - F.col("place")
    fits = (start >= 0) & (start + length <= F.col("n_words")) & (F.col("place") <= F.col("lead"))
    same = fits & (F.expr("slice(around, greatest(lead - place, 0) + 1, size(words))") == F.col("words"))
    rows = rows.select("doc_id", "tag", "n_words", F.col("hash").isNull().cast("long").alias("self"), F.when(same, F.struct(start.alias("start"), length.alias("n"))).alias("span"), F.when(same, F.col("item_id")).alias("item"))
    by_doc = rows.groupBy("doc_id", "tag", "n_words").agg(F.sum("self").alias("copies"), F.sort_array(F.collect_set("span")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    hit = F.expr("""aggregate(spans, named_struct('hit', 0L, 'end', 0L),
        (a, x) -> named_struct('hit', a.hit + greatest(0L, x.start + x.n - greatest(a.end, x.start)), 'end', greatest(a.end, x.start + x.n)),
        a -> a.hit)""")
    return by_doc.select("doc_id", "n_words", hit.alias("n_hit"), "spans", "items", "tag", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).drop("_")


def contaminated():
    """At least one hit word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    own, key, tag = (free_name(docs, n) for n in ("own", "bad", "bad_tag"))
    bad = result.filter(contaminated()).select(F.col("doc_id").alias(key), F.col("tag").alias(tag)).distinct()
    tagged = docs.withColumn(own, F.coalesce(F.xxhash64(text_col), F.lit(0)))
    return tagged.join(bad, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(tag)), "left_anti").select(*docs.columns)


def digest(result: DataFrame) -> DataFrame:
    """The query's columns of a ``contamination`` result."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), contaminated().alias("contaminated"))


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(len(w) - least(len(w), 13) + 1)) AS s FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS k FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS s FROM dw, (SELECT DISTINCT n FROM win)),
occ AS (SELECT d.doc_id, d.s, d.n, win.item_id
        FROM (SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS k FROM ds) d JOIN win ON win.k = d.k AND win.n = d.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
