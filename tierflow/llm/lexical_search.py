"""Ranked lexical search: item tiles times document tiles by dense matrix multiplication.

Each item asks for the documents whose terms score highest: a term's weight
(rarer terms weigh more) times its impact in the document (saturating with its
count, damped by the document's length), summed over the item's terms.

1. *Item tiles.* Items are dealt into tiles of about ``TILE_ITEMS`` items and
   ``TILE_TERMS`` terms; a tile has a compact vocabulary of its own, and
   ``PASS_TILES`` tiles at most go to the tasks at once. More items mean more
   passes over the documents, never a larger broadcast.
2. *Counts.* One pass turns each document into its number of terms and the
   counts of the vocabulary's terms in it (found by hash, decided by bytes).
   That is written once; the number of documents, of all terms and of
   documents by term come from it.
3. *Products.* Documents are taken in blocks. The terms that a block has make a
   dense tile of impacts, which BLAS multiplies by the tile of weights, at most
   ``DEPTH`` terms at a time. All numbers are integers and a product's partial
   sums stay below 2**53, where float64 is exact; products add up in int64.
4. *Top k.* A block gives all pairs that reach its item's k-th score there,
   ties included; the best k by (score, smaller id) go on, through the task and
   then through two rounds of ranking, so no task ranks all candidates of an item.

Terms are runs of ASCII digits, letters (A-Z as a-z) and non-ASCII characters.

Cases: NULL and empty texts have no terms, are no documents for the counts and
never rank; items without terms return nothing; rows with one item id are one
item with all their terms; repeated documents rank each by themselves, rows of
one id and score in any order; NULL document ids rank after others of the
score; very long texts are read whole; other columns are not read; empty
tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import Words, packs, ragged, same_spans, span_hashes, staged, utf8

TOP = 10
TILE_ITEMS = 256
TILE_TERMS = 16_384
PASS_TILES = 8
#: Documents that are multiplied at once, and terms of one product.
BLOCK = 512
DEPTH = 4096
#: An impact is below this, whatever the counts (tf / (tf + damping), in millionths).
IMPACT = 1_000_000


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, raw = ragged(batch.column(1))
        w = Words(offsets, raw)
        lists = [sorted(set(w.text(int(a), int(b)))) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        item = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(item)), pa.array([t for x in lists for t in x], pa.binary())], names=["item_id", "term"])


@dataclass
class Tile:
    """Some items (an Arrow array of ids), the numbers of their terms and (item, place among these) pairs."""

    items: pa.Array
    terms: np.ndarray
    pairs: np.ndarray


class Vocabulary:
    """The terms of some tiles, found in packs of words."""

    def __init__(self, terms: list[bytes]):
        self.raw = np.frombuffer(b"".join(terms), np.uint8)
        self.size = np.fromiter(map(len, terms), np.int64, len(terms))
        start = np.cumsum(self.size) - self.size
        hashes = span_hashes(self.raw, start, start + self.size)
        self.order = np.argsort(hashes, kind="stable")
        self.start, self.hash = start, hashes[self.order]
        self.run = int(np.unique(hashes, return_counts=True)[1].max()) if len(terms) else 0

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) numbers of all words that are terms."""
        size = w.end - w.start
        at = np.searchsorted(self.hash, w.hash)
        words, terms = [], []
        for k in range(self.run):  # terms that share a hash stand next to each other
            near = np.minimum(at + k, len(self.hash) - 1)
            term = self.order[near]
            some = np.flatnonzero((self.hash[near] == w.hash) & (at + k < len(self.hash)) & (self.size[term] == size))
            same = some[same_spans(w.bytes, w.start[some], self.start[term[some]], size[some], self.raw)]
            words.append(same)
            terms.append(term[same])
        return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (words, terms))


_COUNTED = "doc_id {kind}, n long, terms array<int>, counts array<int>"


def _count(terms: list[bytes]):
    """(doc_id, n, terms, counts): the vocabulary's terms in each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        many = max(1, len(terms))
        for batch in batches:
            offsets, raw = ragged(batch.column(1))
            for i, j in packs(offsets):
                w = Words(offsets[i : j + 1] - offsets[i], raw[offsets[i] : offsets[j]])
                word, term = vocabulary.find(w)
                doc = np.searchsorted(w.first, word, "right") - 1
                key, n = np.unique(doc * many + term, return_counts=True)
                cuts = np.searchsorted(key // many, np.arange(j - i + 1))
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.astype(np.int32))) for x in (key % many, n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(w.first)), *lists], names=["doc_id", "n", "terms", "counts"])

    return run


def _list(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column as (offsets, values)."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    return offsets - offsets[0], np.asarray(column.values)[offsets[0] : offsets[-1]]


def _documents_of(many: int):
    """(term, documents), pre-aggregated by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(many, np.int64)
        for batch in batches:
            found += np.bincount(_list(batch.column(0))[1], minlength=many)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["term", "df"])

    return run


def damping(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Ten plus ninety times a document's length over the mean one, rounded down."""
    if 90 * int(n.max(initial=0)) * documents < 1 << 62:
        return 10 + (90 * documents * n.astype(np.int64)) // words
    return np.array([10 + 90 * x * documents // words for x in n.tolist()], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1000 * IMPACT * tf) // (1000 * tf + 8 * m)


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, none: np.ndarray, top: int) -> np.ndarray:
    """Places of each item's ``top`` entries by (score, smaller id, NULL last)."""
    order = np.lexsort((doc, none, -score, item))
    ordered = item[order]
    begins = np.ones(len(ordered), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(len(ordered))
    return order[place - np.maximum.accumulate(np.where(begins, place, 0)) < top]


def multiply(weights: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, heaviest: int) -> np.ndarray:
    """Scores (items x documents) of a block: dense float64 products, exact below 2**53, added in int64."""
    used, place = np.unique(term, return_inverse=True)
    depth = max(1, min(DEPTH, ((1 << 53) - 1) // max(1, heaviest * IMPACT)))
    total = np.zeros((len(weights), docs), np.int64)
    for a in range(0, len(used), depth):
        b = min(a + depth, len(used))
        here = (place >= a) & (place < b)
        tile = np.zeros((b - a, docs))
        tile[place[here] - a, doc[here]] = impact[here]
        total += (weights[:, used[a:b]] @ tile).astype(np.int64)
    return total


def _rank(tiles: list[Tile], weight: np.ndarray, documents: int, words: int, top: int, kind: pa.DataType):
    """(item_id, doc_id, score): each task's best documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, places, heaviest = [], [], int(weight.max(initial=0))
        for tile in tiles:
            w = np.zeros((len(tile.items), len(tile.terms)))
            w[tile.pairs[:, 0], tile.pairs[:, 1]] = weight[tile.terms[tile.pairs[:, 1]]]
            dense.append(w)
            place = np.full(len(weight), -1, np.int64)
            place[tile.terms] = np.arange(len(tile.terms))
            places.append(place)
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in tiles]
        for batch in batches:
            none = np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).fill_null(0)).astype(np.int64)
            m = damping(np.asarray(batch.column(1)), documents, words)
            (cuts, term), (_, tf) = _list(batch.column(2)), _list(batch.column(3))
            row = np.repeat(np.arange(len(ids)), np.diff(cuts))
            impact = impacts(tf, m[row]).astype(np.float64)
            for a in range(0, len(ids), BLOCK):
                b = min(a + BLOCK, len(ids))
                part = slice(cuts[a], cuts[b])
                for k in range(len(tiles)):
                    own = places[k][term[part]]
                    mine = own >= 0
                    if not mine.any():
                        continue
                    scores = multiply(dense[k], row[part][mine] - a, own[mine], impact[part][mine], b - a, heaviest)
                    enough = np.partition(scores, -top, axis=1)[:, -top] if b - a > top else np.zeros(len(scores), np.int64)
                    item, doc = np.nonzero(scores >= np.maximum(enough, 1)[:, None])
                    found = (item, scores[item, doc], ids[a + doc], none[a + doc])
                    found = tuple(np.concatenate(x) for x in zip(held[k], found, strict=True))
                    keep = _best(*found, top)
                    held[k] = tuple(x[keep] for x in found)
        for tile, (item, score, doc, none) in zip(tiles, held, strict=True):
            yield pa.RecordBatch.from_arrays([tile.items.take(pa.array(item)), pa.array(doc, pa.int64(), mask=none).cast(kind), pa.array(score)], names=["item_id", "doc_id", "score"])

    return run


def _tiles(rows: list, kind: pa.DataType) -> tuple[list[Tile], list[bytes]]:
    """Collected (tile, item_id, term) rows as tiles, and all their terms."""
    by_tile: dict[int, dict] = {}
    for tile, item, term in rows:
        by_tile.setdefault(tile, {}).setdefault(item, []).append(bytes(term))
    terms = sorted({t for items in by_tile.values() for found in items.values() for t in found})
    number = {t: i for i, t in enumerate(terms)}
    out = []
    for _, items in sorted(by_tile.items()):
        pairs = np.array([(i, number[t]) for i, found in enumerate(items.values()) for t in found], np.int64)
        own, place = np.unique(pairs[:, 1], return_inverse=True)
        out.append(Tile(pa.array(list(items), kind), own, np.stack([pairs[:, 0], place], 1)))
    return out, terms


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """Each item's ``top`` documents: ``item_id, rank, doc_id, score``. Runs jobs while it is built.

    ``id_col`` holds integers.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    item_type, doc_type = items.schema[item_col].dataType, docs.schema[id_col].dataType
    asked = items.select(F.col(item_col).alias("item_id"), utf8(item_text_col).alias("text")).mapInArrow(_item_terms, f"item_id {item_type.simpleString()}, term binary")
    asked = staged(asked.distinct())
    pairs, many = asked.agg(F.count(F.lit(1)), F.count_distinct(F.xxhash64("item_id"))).first()
    tiles = max(1, -(-many // TILE_ITEMS), -(-pairs // TILE_TERMS))
    asked = asked.withColumn("tile", F.pmod(F.xxhash64("item_id"), F.lit(tiles)).cast("int"))
    texts = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))

    found = None
    for start in range(0, tiles, PASS_TILES):
        rows = asked.filter(F.col("tile").between(start, start + PASS_TILES - 1)).select("tile", "item_id", "term").collect()
        group, terms = _tiles(rows, to_arrow_type(item_type))
        counted = staged(texts.mapInArrow(_count(terms), _COUNTED.format(kind=doc_type.simpleString())))
        documents, words = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = np.zeros(len(terms), np.int64)
        for r in counted.select("terms").mapInArrow(_documents_of(max(1, len(terms))), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r.term] = r.df
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        ranked = counted.mapInArrow(_rank(group, weight, documents, max(1, words or 0), top, to_arrow_type(doc_type)), f"item_id {item_type.simpleString()}, doc_id {doc_type.simpleString()}, score long")
        found = ranked if found is None else found.unionByName(ranked)

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    shard = Window.partitionBy("item_id", "shard").orderBy(*order)
    some = found.withColumn("shard", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(shard)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("item_id").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, rn, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rn FROM documents)),
tf AS (SELECT doc_id, rn, term, count(*) AS tf FROM dw GROUP BY doc_id, rn, term),
len AS (SELECT rn, sum(tf) AS n FROM tf GROUP BY rn),
tot AS (SELECT count(*) AS nd, sum(n) AS nl FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
it AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wt AS (SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM it JOIN df USING (term), tot),
sc AS (
  SELECT item_id, doc_id, rn, CAST(sum(w * CAST((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nl)) AS BIGINT)) AS BIGINT) AS score
  FROM wt JOIN tf USING (term) JOIN len USING (rn), tot GROUP BY item_id, doc_id, rn)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 10
"""
