"""Token ids as flat binary files with 64-bit document offsets.

The rows are range-partitioned by id and sorted, so the parts follow each
other in id order. Each task writes its part's ids as one flat file of
unsigned integers (16 bits when the vocabulary fits, else 32) and an index:
document count, 64-bit offsets within the part, document ids. Part bases are
the prefix sums of the parts' counts, so no file is rewritten. Readers
memory-map the files.

A part's files have a name of their own for each attempt, and only the names
that the committed manifest lists are read: a lost executor's half-written
files are never seen.

Encoding is the ``tokenizers`` library's. The texts are cut into its pieces as
arrays first, and each distinct piece is encoded once by the library; pieces
do not influence each other in these models. Texts that hold a special token's
string go through the library whole.

Cases: NULL and empty texts have only the end id; rows with a NULL id come
first; repeated ids stand next to each other (equal rows in any order, others
by a hash of the text); other columns are not read; an empty table gives no
files and an empty result. A text's ids are held in memory at once.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import packs, scratch_path, shuffle_parts, spread, staged, text_bytes
from tierflow.llm.segment import Classes, Pieces
from tierflow.llm.shared_files import mapped, open_output

END_ID = 2
#: Distinct pieces whose ids a task remembers, and as many again of the ones before.
REMEMBERED = 400_000
_PACK = 1 << 20
#: New words that the tokenizer gets as one text: the longer it is, the more a word costs.
_TOGETHER = 200
#: Parts whose ids are summed together before the prefix sums.
GROUP = 1000
# Fixed value: how the vocabulary spells a space at a token's beginning.
_SPACE = "\u0120"


class PieceEncoder:
    """The tokenizer with a bounded memory of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        before = self.tokenizer.pre_tokenizer
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = Classes(lambda s: len(before.pre_tokenize_str(s)), False)
        #: whether an id's token begins with a space
        self.spaced = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(_SPACE)]] = True
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        self.before: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, each by itself.

        Words with a space before them are encoded some in one text, which the
        tokenizer cuts at the spaces again: there a token with a space begins
        a word, and no other does.
        """
        out: list[bytes] = [b""] * len(pieces)
        words = [i for i, p in enumerate(pieces) if p[0] == " " and p[1:].isalpha()]
        if words:
            runs = ["".join([pieces[i] for i in words[at : at + _TOGETHER]]) for at in range(0, len(words), _TOGETHER)]
            ids = np.array([x for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False) for x in e.ids], np.uint32)
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == len(words) and begins[0] == 0:
                raw, at = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
                for i, a, b in zip(words, at[:-1], at[1:], strict=True):
                    out[i] = raw[a:b]
            else:
                words = []
        rest = set(range(len(pieces))).difference(words)
        if rest:
            order = sorted(rest)
            for i, e in zip(order, self.tokenizer.encode_batch_fast([pieces[i] for i in order], add_special_tokens=False), strict=True):
                out[i] = array("I", e.ids).tobytes()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        whole = {i: self.tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if any(s in t for s in self.special)}
        pieces = Pieces(["" if i in whole else t for i, t in enumerate(texts)] if whole else texts, self.classes, True)
        keys = pieces.distinct()
        if len(self.known) > REMEMBERED:  # pieces in use move on to the new memory
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        lists = list(map(known.get, keys))
        new = []
        for i in [i for i, found in enumerate(lists) if found is None]:
            found = before.get(keys[i])
            if found is None:
                new.append(i)
            else:
                lists[i] = known[keys[i]] = found
        if new:
            for i, found in zip(new, self._ids([keys[i] for i in new]), strict=True):
                lists[i] = known[keys[i]] = found
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.uint32)
        counts = sizes[pieces.which]
        ids = flat[spread((np.cumsum(sizes) - sizes)[pieces.which], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[pieces.first]
        n = np.diff(ends)
        if whole:
            parts = [np.array(whole[i], np.uint32) if i in whole else ids[ends[i] : ends[i + 1]] for i in range(len(texts))]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, n


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_of(path: str) -> PieceEncoder:
    """This process's encoder, which remembers pieces from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _write(folder: str, tokenizer: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = None, TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        counts, docs, file = [], [], None
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            encoder = encoder or encoder_of(tokenizer)
            file = file or open_output(f"{name}.ids")
            docs.append(batch.column(0))
            sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for i, j in packs(sizes, _PACK):
                ids, n = encoder.encode(texts[i:j])
                file.write(np.insert(ids, np.cumsum(n), end_id).astype(dtype).tobytes())
                counts.append(n + 1)
        if file is None:
            return
        file.close()
        n = np.concatenate(counts)
        column = pa.chunked_array(docs).combine_chunks()
        with open_output(f"{name}.index") as f:
            f.write(np.int64(len(n)).tobytes())
            f.write(np.concatenate([[0], np.cumsum(n)]).astype("<i8").tobytes())
            f.write(np.asarray(column.fill_null(0)).astype("<i8").tobytes())
            f.write(np.asarray(column.is_null()).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(n)]), pa.array([int(n.sum())])], names=["part", "name", "n_docs", "n_ids"])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, vocabulary: int = 1 << 16) -> DataFrame:
    """Write the files; the manifest ``part, name, n_docs, n_ids, base`` (base: ids of all parts before)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = shuffle_parts(spark, text_bytes(rows), 32 << 20)
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    manifest = staged(ordered.mapInArrow(_write(folder, tokenizer, end_id, dtype), "part int, name string, n_docs long, n_ids long"))
    # prefix sums in two steps: over groups of parts, then within each
    group = F.expr(f"part div {GROUP}")
    sums = manifest.groupBy(group.alias("group")).agg(F.sum("n_ids").alias("ids"))
    before = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.select("group", F.coalesce(F.sum("ids").over(before("group")), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("group", group).withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return placed.join(groups, "group").select("part", "name", "n_docs", "n_ids", (F.col("begin") + F.col("within")).alias("base"), F.lit(dtype).alias("dtype"))


class TokenFile:
    """A part, memory-mapped: ``ids``, ``offsets`` (within the part), ``doc_ids``, ``is_null``."""

    def __init__(self, name: str, dtype: str):
        index = mapped(f"{name}.index", "<i8")
        n = int(index[0])
        self.offsets, self.doc_ids, self.is_null = index[1 : n + 2], index[n + 2 : 2 * n + 2], index[2 * n + 2 : 3 * n + 2] > 0
        self.ids = mapped(f"{name}.ids", dtype)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            part = TokenFile(r["name"], r["dtype"])
            sums = [zlib.crc32(part.document(i).astype("<u4")) for i in range(len(part.doc_ids))]
            yield pa.RecordBatch.from_arrays([pa.array(part.doc_ids, mask=part.is_null), pa.array(part.offsets[:-1] + r["base"]), pa.array(np.diff(part.offsets)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``, a task for each few parts."""
    parts = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartition(parts).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
