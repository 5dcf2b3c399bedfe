"""Pieces of texts: which are equal, whatever their code points and hashes."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import common, segment
from twins import twins


def classes():
    """Letters, digits, white space and the rest, as a pattern like the tokenizers' sees them."""
    import re

    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?[^\s\w]+|\s+(?!\S)|\s+")
    return segment.Classes(lambda s: len(pattern.findall(s)), False)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab 1.é中🙂", max_size=16), max_size=8), st.booleans())
def test_equal_pieces_have_one_number(texts, blind):
    with pytest.MonkeyPatch.context() as patch:
        if blind:
            patch.setattr(common, "span_hashes", lambda v, s, e: s * 0)
        pieces = segment.Pieces(texts, classes(), True)
    joined = "".join(texts)
    spans = [joined[a:b] for a, b in zip(pieces.start.tolist(), pieces.end.tolist(), strict=True)]
    distinct = pieces.distinct()
    assert len(distinct) == len(pieces) == len(set(spans))
    assert [distinct[i] for i in pieces.which.tolist()] == spans and "".join(spans) == joined


def test_long_words():
    a, b = twins(4096)
    pieces = segment.Pieces([a, b, a, b + "é", "中" + a], classes(), True)
    assert len(pieces) == 4
