"""SentencePiece encoding and decoding over a distinct-chunk table.

Where no piece of the model holds a whitespace marker after another character,
merges never cross from one marked word into the next, so a text's ids are the
ids of its marked words in order. Each task keeps a table of the distinct
marked words it has met; a word is segmented by the library once and its ids
are put back by position. The table is emptied when it reaches a fixed number
of entries, which bounds memory and changes no result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import column_blocks

MARK = "▁"
TABLE_ENTRIES = 300_000

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def read_model(path: str) -> bytes:
    """The model file's bytes (read on the driver and shipped with the job)."""
    with open(path, "rb") as f:
        return f.read()


@functools.lru_cache(maxsize=2)
def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Raise if a piece of the model crosses a whitespace marker, or if the
    model changes white space or characters before segmenting (then marked
    words are not independent)."""
    sp = _processor(model)
    for i in range(sp.get_piece_size()):
        if re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)):
            raise ValueError(f"piece {i} crosses a whitespace marker")
    for probe in ("a", " a  b ", "ÅÅ ﬁ é\t\n　x"):
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model normalises its input or adds no leading marker")


class ChunkTable:
    """Ids and decoded text of the marked words met so far."""

    def __init__(self, model: bytes, entries: int = TABLE_ENTRIES):
        self.sp, self.entries = _processor(model), entries
        self.table: dict[str, tuple[bytes, str]] = {}
        self.bos = self.sp.bos_id().to_bytes(4, "little")
        self.eos = self.sp.eos_id().to_bytes(4, "little")

    def _add(self, chunks: list[str]) -> None:
        # the library puts the first marker in front itself, but not before nothing
        chunks = [c for c in chunks if c != MARK]
        ids = self.sp.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        for c, i, text in zip(chunks, ids, self.sp.decode(ids), strict=True):
            self.table[c] = (array("I", i).tobytes(), " " + text)
        self.table[MARK] = (self.sp.piece_to_id(MARK).to_bytes(4, "little"), " ")

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[bytes, str]]:
        """For each text, ids with begin and end as little-endian unsigned
        32-bit integers, and what they decode to. The new words of all texts
        are segmented in one call."""
        chunks = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        distinct = set().union(*chunks)
        new = [c for c in distinct if c not in self.table]
        if len(self.table) + len(new) > self.entries:
            self.table, new = {}, list(distinct)
        if new:
            self._add(new)
        for own in chunks:
            pairs = [self.table[c] for c in own]
            yield self.bos + b"".join([p[0] for p in pairs]) + self.eos, "".join([p[1] for p in pairs])[1:]


def encode_decode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per input row: the id column, ``n_tokens`` (begin and end
    included), ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256`` (of the decoded text in UTF-8), and on demand
    ``ids`` (array<int>) and ``decoded``. Other columns are not read, so their
    names may clash. A null text counts as empty: two ids (begin, end) and an
    empty decoded text. A marker character in the text decodes to a space, as
    in the library. Repeated rows and null ids stay; an empty table gives an
    empty one. Memory: one Arrow batch, the word table, and the ids of one block of
    texts (or of one longer text).
    """
    check_model(model)
    extra = (", ids array<int>" if with_ids else "") + (", decoded string" if with_text else "")
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in batches:
            for i, j, texts in column_blocks(batch.column(1)):
                part = batch.slice(i, j - i)
                n, digest, back_digest, ids, back = [], [], [], [], []
                for raw, text in table.encode(texts):
                    n.append(len(raw) // 4)
                    digest.append(hashlib.sha256(raw).hexdigest())
                    back_digest.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                    if with_ids:
                        ids.append(np.frombuffer(raw, dtype="<i4"))
                    if with_text:
                        back.append(text)
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(digest), pa.array(back_digest)]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                if with_text:
                    cols.append(pa.array(back, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")
