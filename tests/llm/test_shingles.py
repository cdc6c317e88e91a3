import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ragloom.llm import shingles as S

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=80)), max_size=8))
def test_words_and_shingles_match_plain_versions(texts):
    words = [WORD.findall((t or "").lower()) for t in texts]
    h, off = S.word_hashes(texts)
    assert np.diff(off).tolist() == [len(w) for w in words]
    names = dict(zip([w for ws in words for w in ws], h.tolist(), strict=True))
    assert [names[w] for ws in words for w in ws] == h.tolist()
    assert len(set(names.values())) == len(names)
    plain = [[tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [] for w in words]
    s, soff = S.shingle_hashes(h, off)
    assert np.diff(soff).tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    assert len(set(flat)) == len(set(s.tolist())) == len(set(zip(flat, s.tolist(), strict=True)))
    _, counts, coff = S.counted(s, soff)
    for i, p in enumerate(plain):
        assert sorted(counts[coff[i]:coff[i + 1]].tolist()) == sorted(Counter(p).values())


def test_blocks_do_not_change_hashes_and_long_texts_pass():
    long = "word " * 400_000
    alone = S.word_hashes([long])[0]
    assert len(set(alone.tolist())) == 1
    both = S.word_hashes(["x", long, "word"])[0]
    assert both[1] == both[-1] == alone[0]
    assert list(S.text_blocks(["a" * 10, None, "b" * 10], 15)) == [(0, 3)] or list(S.text_blocks(["a" * 10, None, "b" * 10], 15))[-1][1] == 3


def test_spans_are_the_words():
    t = "Ab, cé 12\nx"
    a, b = S.word_spans(t)
    assert [t.lower()[i:j] for i, j in zip(a, b, strict=True)] == WORD.findall(t.lower())
