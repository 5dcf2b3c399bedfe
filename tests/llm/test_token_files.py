"""Token files against the library, text by text."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierflow.llm import segment
from tierflow.llm.token_files import PieceEncoder, TokenFile, read_token_files, write_token_files
from twins import twins

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def odd_texts(n=400):
    rng = random.Random(2)
    signs = [*"ab'  \n\t1٣½Ⅷé ß!?.'\"srtvemld  ’​中é́̀", "'s", "'re", " '", "I'm", "<|endoftext|>", "hello ", "🙂"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_cut_like_the_library():
    library = Tokenizer.from_file(PATH).pre_tokenizer
    texts = [t.replace("<|endoftext|>", "") for t in odd_texts(1500)]
    pieces = segment.Pieces(texts, segment.Classes(lambda s: len(library.pre_tokenize_str(s)), False), True)
    offsets = np.cumsum([0, *map(len, texts)])
    for i, text in enumerate(texts):
        a, b = pieces.first[i], pieces.first[i + 1]
        got = list(zip((pieces.start[a:b] - offsets[i]).tolist(), (pieces.end[a:b] - offsets[i]).tolist(), strict=True))
        assert got == [o for _, o in library.pre_tokenize_str(text)]


def test_ids_like_the_library(monkeypatch):
    import tierflow.llm.token_files as tf

    monkeypatch.setattr(tf, "REMEMBERED", 50)
    encoder, library, texts = PieceEncoder(PATH), Tokenizer.from_file(PATH), odd_texts()
    for i in range(0, len(texts), 50):
        ids, n = encoder.encode(texts[i : i + 50])
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[i : i + 50]]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [x for w in want for x in w]


def test_new_words_go_to_the_library_in_short_texts():
    class Seen:
        def __init__(self, tokenizer):
            self.tokenizer, self.longest = tokenizer, 0

        def encode_batch_fast(self, texts, **how):
            self.longest = max(self.longest, *(t.count(" ") for t in texts))
            return self.tokenizer.encode_batch_fast(texts, **how)

    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgé中") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    encoder, library = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    encoder.tokenizer = Seen(encoder.tokenizer)
    ids, n = encoder.encode([" ".join(words)])
    want = library.encode(" ".join(words), add_special_tokens=False).ids
    assert ids.tolist() == want and n.tolist() == [len(want)]
    assert 1 < encoder.tokenizer.longest <= 500


@pytest.mark.parametrize("vocabulary", [1 << 16, 1 << 20])
def test_round_trip(spark, vocabulary):
    rows = [(i * 7 % 101, t) for i, t in enumerate(odd_texts(101))] + [(500, None), (501, ""), (None, "no id"), (502, "long " * 200_000)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, start int, name string")
    manifest = write_token_files(df, PATH, vocabulary=vocabulary)
    got = sorted((tuple(r) for r in read_token_files(spark, manifest).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    parts = [TokenFile(r["name"], r["dtype"]) for r in manifest.orderBy("part").collect()]
    ids = [d for p in parts for d in p.doc_ids[~p.is_null].tolist()]
    assert ids == sorted(ids)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "same")] * 3 + [(2, "x")]
    got = read_token_files(spark, write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)
    empty = write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert read_token_files(spark, empty).count() == 0


def test_texts_that_sums_cannot_tell_apart(spark):
    rows = [(i, t) for n in (1024, 2048) for i, t in enumerate(twins(n), n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, read_token_files(spark, write_token_files(docs, PATH)).collect())) == expected(rows)


def test_bases_over_many_parts_and_groups(spark, monkeypatch):
    import tierflow.llm.token_files as tf

    monkeypatch.setattr(tf, "GROUP", 3)
    monkeypatch.setattr(tf, "shuffle_parts", lambda *a: 11)
    rows = [(i, "word " * (i % 7)) for i in range(200)]
    manifest = write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    assert manifest.count() > 6
    assert sorted(map(tuple, read_token_files(spark, manifest).collect())) == expected(rows)
