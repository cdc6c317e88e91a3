import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st

from ragloom.llm import queries
from ragloom.llm import sentencepiece_codec as C

from .helpers import DOC_ROWS, documents, empty_documents

SF = "/root/testdata/sf0.01"
MODEL = queries.piece_model()
SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))


def plain(text):
    ids = SP.encode(text or "", add_bos=True, add_eos=True)
    return b"".join(i.to_bytes(4, "little") for i in ids), SP.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" ▁\n\t a"))), max_size=4))
@example(["a ", " ", "a▁", "▁", " a", "a  b  ", "\n \n", ""])
def test_table_equals_library(texts):
    assert list(C.ChunkTable(MODEL).encode(texts)) == [plain(t) for t in texts]


@pytest.mark.parametrize("entries", [1, 3, 50])
def test_a_small_table_changes_nothing(entries):
    table = C.ChunkTable(MODEL, entries)
    for t in ["a b c d a b", "  x  y ", "", None, "a b", " ".join(map(str, range(200))), "▁▁ b", "one two three four five", "b a"]:
        assert list(table.encode([t, "k", t])) == [plain(t), plain("k"), plain(t)]
        assert len(table.table) <= max(entries, 203)


def test_query_and_edge_rows(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_sentencepiece(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw, back = plain(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = C.encode_decode(documents(spark), MODEL).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids), r.decoded) for r in got) == sorted(
        (d or -1, tuple(SP.encode(t or "", add_bos=True, add_eos=True)), plain(t)[1]) for d, t in DOC_ROWS)
    assert C.encode_decode(empty_documents(spark), MODEL).collect() == []
