"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

* *Counting.* Tasks count words and send the counts on whenever they hold
  ``SUMMARY`` of them; the sums are exact. The ``LEXICON`` most counted words
  are taken, among equal counts in the order of a hash.
* *Lexicon.* These words, each merged exactly once, are compiled into a
  minimal acyclic automaton (equal suffixes are shared). Arcs carry output
  numbers whose sum along a word is its place among the sorted words, which
  leads to its ids. The automaton is a file of arrays in the shared folder,
  memory-mapped by the tasks; its size is bounded by ``LEXICON``.
* *Encoding.* The distinct words of a pack walk the automaton together, a byte
  a step. Words it does not hold are merged exactly: all of them at once, each
  round applying to every word its best-ranked pair. Very long words are merged
  one by one with a heap.
* *Decoding.* The tokens joined by one space, as the library decodes a
  vocabulary without a decoder.

What the vocabulary file says (normaliser, pattern, suffix, special tokens) is
followed; other settings than NFC, white space, lower case, the split and the
end-of-word suffix are refused.

Cases: NULL and empty texts have no ids and decode to nothing; strings of
special tokens become their ids; repeated rows are encoded alike; very long
texts and words are handled whole; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import packs, scratch_path, spread, staged
from tierflow.llm.segment import Classes, Pieces
from tierflow.llm.shared_files import mapped, open_output

LEXICON = 50_000
#: Words whose counts a task holds before it sends them on.
SUMMARY = 100_000
#: Bytes of a word up to which words are counted and merged side by side.
SHORT = 64
_PACK = 1 << 20


class Vocabulary:
    """What the tokenizer file defines."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or spec["decoder"] or spec["post_processor"]:
            raise ValueError("a word BPE file with NFC, white space and lower case normalisers is needed")
        if model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("unsupported BPE setting")
        before = Tokenizer.from_file(path).pre_tokenizer
        self.classes = Classes(lambda s: len(before.pre_tokenize_str(s)), True)
        vocabulary, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = _byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.final = np.array([vocabulary[c + self.suffix] for c in letters], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_rank, self.pair_made = keys[order], order.astype(np.int64), made[order]
        self._merge = {k: (r, m) for r, (k, m) in enumerate(zip(keys.tolist(), made.tolist(), strict=True))}

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # the library lowers each character by itself
                text = text.replace("Σ", "σ")
        return text.lower()

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens: ordinary, special, ordinary, ..."""
        return self._special.split(text) if self._special and any(s in text for s in self.special) else [text]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; a pair that does not merge ranks last."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_rank[at], 1 << 30), self.pair_made[at]

    def merge_words(self, words: list[bytes]) -> list[list[int]]:
        """Exact ids of each word."""
        out: list[list[int]] = [[] for _ in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = self._merge_long(words[i])
        for low, high in ((0, 8), (8, 16), (16, SHORT)):
            rows = np.flatnonzero((size > low) & (size <= high))
            if len(rows):
                self._merge_block([words[i] for i in rows.tolist()], rows, size[rows], high, out)
        return out

    def _merge_block(self, words: list[bytes], rows: np.ndarray, size: np.ndarray, width: int, out: list[list[int]]) -> None:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = self.inner[raw]
        line = np.arange(len(words))
        ids[line, size - 1] = self.final[raw[line, size - 1]]
        none = 1 << 30
        rank, made = self._ranks(ids[:, :-1], ids[:, 1:])
        place = np.arange(width - 1)
        rank[place[None, :] >= (size - 1)[:, None]] = none
        while True:
            best = rank.argmin(1)
            active = rank[line, best] < none
            done = np.flatnonzero(~active)
            for i, r, n in zip(done.tolist(), rows[done].tolist(), size[done].tolist(), strict=True):
                out[r] = ids[i, :n].tolist()
            if len(done) == len(line):
                return
            ids, rank, made, size, rows, best = (x[active] for x in (ids, rank, made, size, rows, best))
            line = np.arange(len(ids))
            ids[line, best] = made[line, best]
            # everything after the pair moves up by one
            shift = np.arange(width)[None, :] > best[:, None]
            ids[:, :-1] = np.where(shift[:, :-1], ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(shift[:, : width - 2], rank[:, 1:], rank[:, :-1])
            made[:, :-1] = np.where(shift[:, : width - 2], made[:, 1:], made[:, :-1])
            rank[:, -1] = none
            size = size - 1
            for at in (best - 1, best):
                ok = np.flatnonzero((at >= 0) & (at < size - 1))
                rank[ok, at[ok]], made[ok, at[ok]] = self._ranks(ids[ok, at[ok]], ids[ok, at[ok] + 1])
            gone = np.flatnonzero(best >= size - 1)
            rank[gone, np.minimum(best[gone], width - 2)] = none

    def _merge_long(self, word: bytes) -> list[int]:
        ids = [*self.inner[np.frombuffer(word, np.uint8)].tolist()]
        ids[-1] = int(self.final[word[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(*self._merge[k], i) for i in range(n - 1) if (k := ids[i] << 32 | ids[i + 1]) in self._merge]
        heap = [(rank, i, ids[i], ids[i + 1], made) for rank, made, i in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (k := ids[left] << 32 | ids[right]) in self._merge:
                    rank, result = self._merge[k]
                    heapq.heappush(heap, (rank, left, ids[left], ids[right], result))
        return [x for x in ids if x >= 0]


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    """This process's vocabulary, from task to task."""
    return Vocabulary(path)


class Transducer:
    """The automaton as arrays: sorted arc keys (state << 8 | byte), targets, outputs; final states; ids by place."""

    NAMES = ("keys", "target", "output", "final", "ids_at", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.NAMES:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, words: list[bytes], ids: list[list[int]]) -> Transducer:
        """Compile sorted distinct words: equal right languages become one state."""
        final, arcs = [False], [{}]
        register: dict[tuple, int] = {}
        path: list[int] = [0]  # states of the previous word
        previous = b""

        def close(depth: int) -> None:
            """Replace the states below ``depth`` of the last word by equal registered ones."""
            while len(path) - 1 > depth:
                state = path.pop()
                kind = (final[state], tuple(arcs[state].items()))
                arcs[path[-1]][previous[len(path) - 1]] = register.setdefault(kind, state)

        for word in words:
            common = 0
            while common < min(len(word), len(previous)) and word[common] == previous[common]:
                common += 1
            close(common)
            for byte in word[common:]:
                final.append(False)
                arcs.append({})
                arcs[path[-1]][byte] = len(final) - 1
                path.append(len(final) - 1)
            final[path[-1]] = True
            previous = word
        close(0)
        live, count = {}, {}

        def number(root: int) -> None:
            """Words below each state, deepest first, without recursion."""
            stack = [(root, False)]
            while stack:
                state, ready = stack.pop()
                if ready:
                    count[state] = final[state] + sum(count[t] for t in arcs[state].values())
                elif state not in live:
                    live[state] = len(live)
                    stack.append((state, True))
                    stack += [(t, False) for t in arcs[state].values()]

        number(0)
        rows = []
        for state, new in live.items():
            below = int(final[state])
            for byte, target in sorted(arcs[state].items()):
                rows.append((new << 8 | byte, live[target], below))
                below += count[target]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        ends = np.zeros(len(live), np.int64)
        for state, new in live.items():
            ends[new] = final[state]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return cls({"keys": table[:, 0], "target": table[:, 1], "output": table[:, 2], "final": ends, "ids_at": np.concatenate([[0], np.cumsum(sizes)]), "ids": np.fromiter((x for w in ids for x in w), np.int64, int(sizes.sum()))})

    def save(self, address: str) -> None:
        """One file: the lengths of the arrays, then the arrays."""
        arrays = [np.asarray(getattr(self, n), "<i8") for n in self.NAMES]
        with open_output(address) as f:
            f.write(np.array([len(a) for a in arrays], "<i8").tobytes())
            for a in arrays:
                f.write(a.tobytes())

    @classmethod
    def open(cls, address: str) -> Transducer:
        data = np.asarray(mapped(address, "<i8"))  # still mapped, but sliced as a plain array
        lengths = data[: len(cls.NAMES)].tolist()
        ends = np.cumsum([len(cls.NAMES), *lengths])
        return cls({n: data[ends[i] : ends[i + 1]] for i, n in enumerate(cls.NAMES)})

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, -1 for words that are not held."""
        place = np.full(len(words), -1, np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        at = np.cumsum(size) - size
        row = np.flatnonzero((size > 0) & (size <= SHORT)) if len(self.keys) else np.zeros(0, np.int64)
        state, total = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        step = 0
        while len(row):
            key = state << 8 | raw[at[row] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            row, arc, total = row[hit], arc[hit], total[hit]
            state, total = self.target[arc], total + self.output[arc]
            step += 1
            ended = size[row] == step
            good = ended & (self.final[state] > 0)
            place[row[good]] = total[good]
            row, state, total = row[~ended], state[~ended], total[~ended]
        return place

    def ids_of(self, places: np.ndarray) -> list[list[int]]:
        """The ids of words by place."""
        sizes = self.ids_at[places + 1] - self.ids_at[places]
        flat = self.ids[spread(self.ids_at[places], sizes)].tolist()
        ends = np.cumsum(sizes).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def _text_packs(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    texts = batch.column(column).fill_null("").to_pylist()
    sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for i, j in packs(sizes, _PACK):
        yield i, texts[i:j]


def _count_words(path: str):
    """Word counts, sent on in parts of a bounded number of words."""

    def rows(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts = None, {}
        for batch in batches:
            vocabulary = vocabulary or vocabulary_of(path)
            for _, texts in _text_packs(batch, 0):
                ordinary = [vocabulary.normalise(p) for t in texts for p in vocabulary.parts(t)[::2]]
                pieces = Pieces(ordinary, vocabulary.classes, False)
                for word, n in zip(pieces.distinct(), np.bincount(pieces.which, minlength=len(pieces)).tolist(), strict=True):
                    if len(word) <= SHORT:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > SUMMARY:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    return run


def _most_counted(counted: DataFrame, size: int) -> DataFrame:
    """The ``size`` most counted words (fewer only where order and hash are equal at the cut)."""
    # counts, and a hash that parts equal ones, as one number; the cut is narrowed by 64 ranges a pass
    ranked = counted.select("word", (F.col("n") * 65536 + F.pmod(F.xxhash64("word"), F.lit(65536))).alias("rank"))
    low, high, room = 0, int(ranked.agg(F.max("rank")).first()[0] or 0) + 1, size  # all of ``high`` and above fit
    while low < high:
        width = -(-(high - low) // 64)
        ranges = ranked.filter((F.col("rank") >= low) & (F.col("rank") < high)).groupBy(F.expr(f"(rank - {low}L) div {width}L").alias("at")).agg(F.count(F.lit(1)).alias("words"))
        words = {r["at"]: r["words"] for r in ranges.collect()}
        for at in sorted(words, reverse=True):
            if words[at] > room:
                low, high = low + at * width, min(high, low + (at + 1) * width)
                break
            room -= words[at]
        else:
            high = low
        if width == 1:
            low = high
    return ranked.filter(F.col("rank") >= high).select("word")


def build_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = LEXICON) -> str:
    """Compile the most frequent words of all documents, ``size`` at most; the address of the file."""
    counted = docs.select(text_col).mapInArrow(_count_words(tokenizer), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = _most_counted(staged(counted.filter(F.octet_length("word") <= SHORT)), size).collect()
    words = sorted(r.word.encode() for r in top)
    address = scratch_path(docs.sparkSession, "lexicon") + ".fst"
    Transducer.build(words, Vocabulary(tokenizer).merge_words(words)).save(address)
    return address


class Encoder:
    """Encodes packs of texts: the lexicon first, exact merges for the rest."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.vocabulary, self.lexicon = vocabulary_of(tokenizer), Transducer.open(lexicon)
        self.numerals = list(map(str, range(len(self.vocabulary.tokens))))

    def words(self, texts: list[str]) -> tuple[Pieces, list[list[int]]]:
        """The pieces of normalised texts and the ids of the distinct ones."""
        pieces = Pieces(texts, self.vocabulary.classes, False)
        distinct = [w.encode() for w in pieces.distinct()]
        place = self.lexicon.find(distinct)
        ids: list[list[int]] = [[]] * len(distinct)
        seen, unseen = np.flatnonzero(place >= 0), np.flatnonzero(place < 0).tolist()
        for i, found in zip(seen.tolist(), self.lexicon.ids_of(place[seen]), strict=True):
            ids[i] = found
        for i, found in zip(unseen, self.vocabulary.merge_words([distinct[i] for i in unseen]), strict=True):
            ids[i] = found
        return pieces, ids

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[list[int]]]]:
        """For each text its words as numbers, and the ids of the numbered words (shared by the pack).

        Special tokens are numbered after the distinct words.
        """
        parts = [self.vocabulary.parts(t) for t in texts]
        pieces, ids = self.words([self.vocabulary.normalise(p) for ps in parts for p in ps[::2]])
        special = {s: len(ids) + i for i, s in enumerate(self.vocabulary.special)}
        ids = ids + [[i] for i in self.vocabulary.special.values()]
        which, first, at = pieces.which, pieces.first.tolist(), 0
        for ps in parts:
            if len(ps) == 1:
                yield which[first[at] : first[at + 1]].tolist(), ids
                at += 1
            else:
                row: list[int] = []
                for k, p in enumerate(ps):
                    if k % 2:
                        row.append(special[p])
                    else:
                        row += which[first[at] : first[at + 1]].tolist()
                        at += 1
                yield row, ids

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.vocabulary.tokens[i] for i in ids])


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str, lexicon: str) -> Encoder:
    """This process's encoder, from task to task."""
    return Encoder(tokenizer, lexicon)


def _digests(tokenizer: str, lexicon: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or encoder_of(tokenizer, lexicon)
            for start, texts in _text_packs(batch, 1):
                sizes, id_sums, text_sums, rows, held = [], [], [], [], None
                for row, ids in encoder.encode(texts):
                    if ids is not held:  # strings of the pack's distinct words, made once
                        held = ids
                        counts = [len(w) for w in ids]
                        numerals, tokens = encoder.numerals, encoder.vocabulary.tokens
                        numbers = [numerals[w[0]] if len(w) == 1 else " ".join([numerals[i] for i in w]) for w in ids]
                        decoded = [tokens[w[0]] if len(w) == 1 else " ".join([tokens[i] for i in w]) for w in ids]
                    sizes.append(sum([counts[w] for w in row]))
                    id_sums.append(hashlib.sha256(" ".join([numbers[w] for w in row]).encode()).hexdigest())
                    text_sums.append(hashlib.sha256(" ".join([decoded[w] for w in row]).encode()).hexdigest())
                    if with_ids:
                        rows.append(np.array(row, np.int64))
                columns = [batch.column(0).slice(start, len(texts)), pa.array(sizes, pa.int64()), pa.array(id_sums), pa.array(text_sums)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    words, each = np.concatenate(rows), np.array(counts, np.int64)
                    flat = np.fromiter((x for w in held for x in w), np.int32, int(each.sum()))
                    values = flat[spread((np.cumsum(each) - each)[words], each[words])]
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]``.

    Counts words and builds the lexicon when none is given. Each id of a word
    is non-empty, so joining the words' strings joins the ids.
    """
    lexicon = lexicon or build_lexicon(docs, tokenizer, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_digests(tokenizer, lexicon, with_ids), ddl)
