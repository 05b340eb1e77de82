import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spindle.llm import arrowtext as at

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_regex(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aB zé9.\n", max_size=60)), min_size=1, max_size=12)


@settings(max_examples=120, deadline=None)
@given(TEXTS, st.integers(1, 64))
def test_words_of_batches(texts, chunk):
    got = []
    for s in at.slices(pa.array(texts, pa.string()), chunk):
        w = at.words(s)
        for r in range(s.hi - s.lo):
            got.append([w.low[a:b].tobytes().decode() for a, b in zip(w.start[w.first[r]:w.first[r + 1]], w.end[w.first[r]:w.first[r + 1]])])
            assert (w.hash[w.first[r]:w.first[r + 1]] == at.word_hashes(by_regex(texts[s.lo + r]))).all()
    assert got == [by_regex(t) for t in texts]
    assert [at.text_words(t) for t in texts] == got


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingles(texts):
    for s in at.slices(pa.array(texts, pa.string())):
        w = at.words(s)
        h, row, first = at.shingles(w, 5)
        want = []
        for r in range(s.hi - s.lo):
            x = by_regex(texts[r])
            want += [(r, tuple(x[i:i + 5])) for i in range(max(1, len(x) - 4))] if x else []
        assert row.tolist() == [r for r, _ in want]
        seen = {}
        for k, (_, g) in zip(h.tolist(), want):
            assert seen.setdefault(k, g) == g
        assert len(set(h.tolist())) == len({g for _, g in want})


def test_sliced_columns_keep_their_offset():
    column = pa.array(["a b", None, "c d e", "f"]).slice(1, 3)
    counts = [np.diff(at.words(s).first).tolist() for s in at.slices(column)]
    assert counts == [[0, 3, 1]]
