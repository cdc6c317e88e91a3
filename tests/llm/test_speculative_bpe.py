import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ragloom.llm import queries
from ragloom.llm import speculative_bpe as B

from .helpers import DOC_ROWS, documents, empty_documents

SF = "/root/testdata/sf0.01"
SOURCE = queries.word_tokenizer()
LIB = Tokenizer.from_file(public_tokenizers.path(queries.WORD_MODEL))
LIB.no_truncation()
LIB.no_padding()


def plain(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), LIB.decode(ids, skip_special_tokens=False)


LETTERS = st.text(alphabet="etaoinshrdlaa", max_size=30)
ODD = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n'Ss\x0b\x85\xa0İſß²½É\u0301\u2028日")))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(LETTERS, ODD), max_size=5))
@example(["it's I'LL '' 's'T", "<|startoftext|>a<|endoftext|>b <|start", "İſ ΣΑΣ Σ", "a" * 300, "x\x0by\x0cz\x85q", "e\u0301", " \n", "", "½²1a"])
def test_table_equals_library(texts):
    assert list(B.WordTable(SOURCE).encode(texts)) == [plain(t) for t in texts]


@pytest.mark.parametrize("entries", [1, 5, 40])
def test_a_small_table_changes_nothing(entries):
    table = B.WordTable(SOURCE, entries)
    for t in ["a b c d a b", "  x  y ", "", None, " ".join(map(str, range(60))), "one two three four five", "b <|endoftext|> a"]:
        assert list(table.encode([t, "k", t])) == [plain(t), plain("k"), plain(t)]


def test_easy_characters_are_their_own_normal_form():
    """The short word rule and the file's own one agree on every character, alone and beside others."""
    model = B.merge_table(SOURCE)
    assert model.easy
    chars = [chr(c) for c in range(9, 0x2028) if B._EASY.fullmatch(chr(c))]
    assert len(chars) == 344
    for c in chars:
        for text in (c, f"a{c}", f"{c}a", f"1{c}!", f"!{c}{c}"):
            assert model.words(text) == [w for w in model._hard_words(text)], (c, text)


def test_check_finds_exactly_the_words_that_greedy_gets_wrong():
    """Random words: the proposal passes if and only if it is the exact encoding."""
    model, rng = B.merge_table(SOURCE), np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(1, 14))) for _ in range(3000)]
    flat, start = model.proposals(words)
    n = np.diff(start, append=len(flat))
    wrong = 0
    for i, w in enumerate(words):
        mine = flat[start[i]:start[i] + n[i]]
        assert mine.tolist() == model.propose(w)
        exact = model.merge_all([w])[0]
        crossed = (model.first_crossing(mine[:-1], mine[1:]) != B.NEVER).any()
        assert crossed == (mine.tolist() != exact)
        wrong += crossed
    assert 100 < wrong < 2900
    assert model.encode_words(words) == (model.merge_all(words), wrong)


def test_long_words_one_by_one_and_in_rounds(monkeypatch):
    model, rng = B.merge_table(SOURCE), np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeth"), k)) for k in (1, 2, 63, 64, 65, 400)]
    both = []
    for limit in (0, 1000):
        monkeypatch.setattr(B, "LONG_WORD", limit)
        both.append(model.merge_all(words))
    assert both[0] == both[1] == [LIB.encode(w, add_special_tokens=False).ids for w in words]


def test_other_files_are_refused():
    for change in ({"decoder": {"type": "ByteLevel"}}, {"model": json.loads(SOURCE)["model"] | {"unk_token": "x"}}):
        with pytest.raises(ValueError, match="plain"):
            B.MergeTable(json.dumps(json.loads(SOURCE) | change))


def test_query_and_edge_rows(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_speculative_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, ids, back = plain(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = B.encode_decode(documents(spark), SOURCE).collect()
    assert sorted((r.doc_id or -1, " ".join(map(str, r.ids)), r.decoded) for r in got) == sorted((d or -1, *plain(t)[1:]) for d, t in DOC_ROWS)
    assert B.encode_decode(empty_documents(spark), SOURCE).collect() == []
