"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

* *Folding.* Lower case, homoglyphs (Cyrillic, Greek, full-width letters) as
  the Latin letter they look like, digits and signs that stand for letters
  (``1d10t``) as that letter where they touch one.
* *Lexicon.* Learned from labelled texts, one of each family of near copies
  (the smallest id; texts that merely share a passage all count): words
  and word beginnings with a weight, the log odds of toxic
  against other labelled texts that have them. Terms that other texts have as
  often, or that too few texts have, are left out.
* *Exception phrases.* A lexicon word with the word before or after it, as
  found in texts that are not toxic and never in toxic ones; a match inside
  such a phrase does not count.
* *Score.* The weights of all matches over the number of words, through a
  logistic curve fitted on the labelled rows.

``train`` reads at most about ``rows`` labelled rows (picked by a hash of the
id), so the lexicon, which goes to every task, is bounded by a constant.
Labels of rows with ``crc32(doc_id as text) % 3 = 1`` are never read.

Cases: NULL and empty texts have no match and get the curve's value at zero;
labels that are NULL or contradict each other are not used; without toxic or
without other labels the score is the share of toxic ones for every text;
repeated rows are scored alike; very long texts are scored whole; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import Words, mix, ragged, slices, staged
from tierflow.llm.order_minhash import text_shingles

TRAIN_ROWS = 20_000
THRESHOLD = 0.7
#: Length of a word beginning that may be a term of its own.
BEGINNING = range(3, 9)
MIN_TEXTS = 3
MIN_G2 = 20.0
MAX_TERMS = 4096
#: Family of a labelled text: shared one of so many minima, and this share of so many smallest shingles.
MINIMA, SKETCH, FAMILY = 6, 64, 0.8

# Letters of other scripts that look like Latin ones, and signs used as letters.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁԛԝѵӏαεικνορτυχ", "abekmhopctyxijsdqwvlaeiknoptux", strict=True)) | {chr(0xFF41 + i): chr(0x61 + i) for i in range(26)}
SIGNS = dict(zip("013457@$", "oieastas", strict=True))

_LOOKALIKE = re.compile("[" + "".join(HOMOGLYPHS) + "]")
_AS_LATIN = str.maketrans(HOMOGLYPHS)
_SIGN = re.compile(r"(?<=[^\W\d_])[013457@$]|[013457@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case with look-alike letters and signs as letters."""
    text = (text or "").lower()
    if not text.isascii() and _LOOKALIKE.search(text):
        text = text.translate(_AS_LATIN)
    if any(sign in text for sign in SIGNS):
        for _ in range(2):  # a sign between two signs touches a letter the second time
            text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text


def terms_of(text: str) -> set[str]:
    """Whole words as ``word$`` and their beginnings."""
    found = set()
    for word in set(_WORD.findall(text)):
        found.add(word + "$")
        found.update(word[:n] for n in BEGINNING if n < len(word))
    return found


def word_before(text: str, place: int) -> str:
    """The last word that ends at or before ``place``, which begins a word."""
    end = place
    while end and not text[end - 1].isalnum():
        end -= 1
    start = end
    while start and text[start - 1].isalnum():
        start -= 1
    return text[start:end]


@dataclass
class Model:
    """Terms with weights (``word$``: the whole word), exception phrases and the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[tuple[str, str]] = frozenset()
    slope: float = 0.0
    base: float = 0.0

    def matcher(self):
        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term.rstrip("$"), (len(term.rstrip("$")), []))
        for term, weight in self.weights.items():
            automaton.get(term.rstrip("$"))[1].append((term.endswith("$"), weight))
        if self.weights:
            automaton.make_automaton()
        return automaton

    def matches(self, text: str, automaton) -> Iterator[tuple[float, str, str, str]]:
        """(weight, word before, word, word after) of each match at a word's beginning."""
        if not self.weights:
            return
        seen = -1
        for end, (length, kinds) in automaton.iter(text):
            start = end - length + 1
            if start == seen or (start and _WORD.match(text[start - 1])):
                continue
            rest = _WORD.match(text, end + 1)
            stop = rest.end() if rest else end + 1
            weight = max((w for whole, w in kinds if not whole or stop == end + 1), default=None)
            if weight is None:
                continue
            seen = start
            after = _WORD.search(text, stop)
            yield weight, word_before(text, start), text[start:stop], after[0] if after else ""

    def density(self, text: str | None, automaton) -> float:
        """Weights of the matches outside exception phrases, for 100 words."""
        text = fold(text)
        total = 0.0
        for weight, before, word, after in self.matches(text, automaton):
            if (before, word + ">") not in self.exceptions and ("<" + word, after) not in self.exceptions:
                total += weight
        return 100 * total / max(1, len(text.split())) if total else 0.0

    def score(self, density: float) -> float:
        z = self.base + self.slope * math.log1p(density)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _g2(a: int, n: int, b: int, m: int) -> float:
    """Likelihood ratio of ``a`` of ``n`` against ``b`` of ``m``."""
    def part(x: float, expected: float) -> float:
        return x * math.log(x / expected) if x else 0.0

    p = (a + b) / (n + m)
    return 2 * (part(a, n * p) + part(b, m * p) + part(n - a, n * (1 - p)) + part(m - b, m * (1 - p)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text the ``SKETCH`` smallest shingle hashes, and the smallest by each of ``MINIMA`` other hashes."""
    factors = mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        offsets, raw = ragged(batch.column(2))
        w = Words(offsets, raw)
        low, minima = [], []
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            found = np.unique(text_shingles(w.hash[a:b]) >> np.uint64(1))  # no sign: one order everywhere
            low.append(found[:SKETCH].view(np.int64))
            minima.append([int((found * f).min() >> np.uint64(1)) for f in factors] if len(found) else [])
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(low, lists), pa.array(minima, lists)], names=["id", "toxic", "low", "minima"])


def one_of_family(sample: DataFrame) -> DataFrame:
    """(id, toxic, text) rows without those that resemble another one of smaller id and the same label.

    Rows meet where one of several minima of their shingles agrees; each is
    compared with the smallest id there, by the share of common shingles that
    the smallest hashes of both estimate.
    """
    rows = staged(sample.mapInArrow(_sketch, "id long, toxic int, low array<long>, minima array<long>"))
    met = rows.select("id", "toxic", "low", F.posexplode("minima").alias("j", "least"))
    first = met.groupBy("toxic", "j", "least").agg(F.min(F.struct("id", "low")).alias("first"))
    both = F.slice(F.array_sort(F.array_union("low", "first.low")), 1, SKETCH)
    same = F.size(F.array_intersect(F.array_intersect("low", "first.low"), both)) >= FAMILY * F.size(both)
    copies = met.join(first, ["toxic", "j", "least"]).filter((F.col("id") > F.col("first.id")) & same).select("id").distinct()
    return sample.join(copies, "id", "left_anti")


def _toxic_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(terms_of(fold(text)))
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])


def _other_terms(wanted: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(terms_of(fold(text)) & wanted)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return run


def _phrases(model: Model):
    """Phrases around matches: texts that have them, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.matcher()
        counts: Counter[tuple[str, str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set()
                for _, before, word, after in model.matches(fold(text), automaton):
                    found |= {(before, word + ">"), ("<" + word, after)}
                counts.update((a, b, toxic) for a, b in found if a and b)
        yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in counts], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))), pa.array(list(counts.values()), pa.int64())], names=["a", "b", "toxic", "n"])

    return run


def _densities(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.matcher()
        for batch in batches:
            found = [model.density(text, automaton) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], names=["density", "toxic"])

    return run


def _pick(candidates: dict[str, tuple[int, int]], n: int, m: int) -> dict[str, float]:
    """Terms that tell toxic texts, without those that only extend another or are extended alike."""
    good: dict[str, tuple[float, float]] = {}
    for term, (a, b) in candidates.items():
        g2 = _g2(a, n, b, m)
        weight = math.log((a + 0.5) / (n + 1)) - math.log((b + 0.5) / (m + 1))
        if weight > 1 and g2 >= MIN_G2:
            good[term] = (g2, weight)
    weights: dict[str, float] = {}
    # longest first among equals: a beginning that adds no text to a longer one says nothing new
    for term in sorted(good, key=lambda t: (-good[t][0], -len(t), t)):
        same = term.rstrip("$")
        if not any(same.startswith(have.rstrip("$")) or have.startswith(same) for have in weights) and len(weights) < MAX_TERMS:
            weights[term] = good[term][1]
    return weights


def _curve(density: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on log(1 + density), slightly drawn to zero."""
    x = np.stack([np.ones(len(density)), np.log1p(density)], 1)
    w, pull = np.zeros(2), np.array([1e-3, 0.1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (toxic - p) - pull * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[1]), float(w[0])


def held_out(id_col: str = "doc_id"):
    """Rows whose label must not be learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learn lexicon, exception phrases and curve from about ``rows`` labelled rows at most."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.min(label_col).cast("int").alias("toxic"), F.max(label_col).cast("int").alias("most")).filter("toxic = most").select("id", "toxic")
    n = known.count()
    if n > rows:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(known, "id").select("id", "toxic", "text")
    # a text that was copied often counts once, or its chance words would look telling
    sample = staged(one_of_family(sample).select("text", "toxic"))
    size = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        share = min(max(bad / max(1, bad + good), 0.01), 0.99)
        return Model(base=math.log(share / (1 - share)))
    toxic, other = sample.filter("toxic = 1").select("text"), sample.filter("toxic = 0").select("text")
    first = toxic.mapInArrow(_toxic_terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # a term needs enough toxic texts to pass MIN_G2 even if no other text had it
    least = next(a for a in range(MIN_TEXTS, bad + MIN_TEXTS + 1) if a >= bad or _g2(a, bad, 0, good) >= MIN_G2)
    counts = {r.term: r["n"] for r in first.filter(F.col("n") >= least).collect()}
    second = other.mapInArrow(_other_terms(frozenset(counts)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    against = {r.term: r["n"] for r in second.collect()}
    model = Model(_pick({t: (a, against.get(t, 0)) for t, a in counts.items()}, bad, good))
    if not model.weights:
        model.base = math.log(bad / good)
        return model
    seen = sample.mapInArrow(_phrases(model), "a string, b string, toxic int, n long").groupBy("a", "b").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"))
    model.exceptions = frozenset((r.a, r.b) for r in seen.filter("clean >= 2 AND bad = 0").select("a", "b").collect())
    found = sample.mapInArrow(_densities(model), "density double, toxic int").collect()
    model.slope, model.base = _curve(np.array([r.density for r in found]), np.array([float(r.toxic) for r in found]))
    return model


def _score(model: Model, place: int, passed: int, name: str):
    """Scores column ``place``; the first ``passed`` columns are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.matcher()
        for batch in slices(batches):
            found = [model.score(model.density(text, automaton)) for text in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:passed], pa.array(found, pa.float64())], names=[*batch.schema.names[:passed], name])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns (the id alone unless given) with the score, a number from 0 to 1, as ``name``."""
    names = keep or [id_col]
    rows = docs.select(*names) if text_col in names else docs.select(*names, text_col)
    schema = docs.select(*names).schema.add(name, "double")
    return rows.mapInArrow(_score(model, rows.columns.index(text_col), len(names), name), schema)


def digest(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The query's columns: ``doc_id, held_out, score, predicted``."""
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
