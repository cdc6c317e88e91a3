"""BPE encoding and decoding by speculation and verification.

A word is first cut by greedy longest match (the speculation). A sequence of
tokens is the word's BPE encoding exactly if every token encodes to itself and
no merge crosses the border of two neighbours while each side is being built
alone, so the proposal is verified pair by pair; the pairs of all new words of a
block are tested together with array operations. Only words with a failing pair
are merged step by step. Each distinct word is encoded once per table of a task.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from itertools import chain
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import column_blocks

TABLE_ENTRIES = 400_000
NEVER = np.iinfo(np.int64).max  # rank of a merge that does not exist
LONG_WORD = 64  # symbols; longer words are merged one by one
_END = "\n"  # stands for the end-of-word suffix while a word is matched

# The file's word rule, and the same rule over the lower-cased
# characters below U+0180 and the punctuation U+2010 to U+2027, where the
# normal form and lower case are one character's own.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_LETTERS, _DIGITS, _BLANKS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\r\n"
_EASY = re.compile(r"[\t\r\n -~\xa1-\u012f\u0131-\u017f\u2010-\u2027]*")
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+")
_PIECE = re.compile(f"[^{_BLANKS}]+")


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text (read on the driver and shipped with the job)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class MergeTable:
    """Vocabulary, merges and word rules of a tokenizer file of the
    ``tokenizers`` library; a ``ValueError`` if the file asks for something that
    this method does not cover."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model, added = spec["model"], spec.get("added_tokens") or []
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = (model.get("type") == "BPE" and not model.get("dropout") and not model.get("unk_token") and not model.get("byte_fallback")
                 and not model.get("continuing_subword_prefix") and not model.get("ignore_merges") and model.get("end_of_word_suffix")
                 and spec.get("decoder") is None and len(steps) == 2 and steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed"
                 and steps[0]["invert"] and steps[1].get("type") == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])
        if not plain or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("the file is not a plain byte-level BPE model with word ends and without decoder")
        self.easy = steps[0]["pattern"] == {"Regex": WORD_RULE} and (spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        rules = Tokenizer.from_str(json.dumps(spec | {"pre_tokenizer": steps[0]}))
        self._normal, self._split = rules.normalizer, rules.pre_tokenizer
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in added}
        self.special = {_END + t: i for t, i in special.items()}
        self.special_cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.size = max(*vocab.values(), *special.values(), 0) + 1
        self.text = [""] * self.size
        for t, i in chain(vocab.items(), special.items()):
            self.text[i] = t
        self.number = [str(i) for i in range(self.size)]
        alphabet = byte_alphabet()
        self._visible = {b: c for b, c in enumerate(alphabet)}
        if any(c not in vocab or c + suffix not in vocab for c in alphabet):
            raise ValueError("a byte has no token")
        self.first, self.last = (np.array([vocab[c + end] for c in alphabet], dtype=np.int64) for end in ("", suffix))
        self._byte = {c: b for b, c in enumerate(alphabet)}
        self.rank, self.left, self.right = (np.full(self.size, -1, dtype=np.int64) for _ in range(3))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a, b = (np.array([vocab[p[i]] for p in pairs], dtype=np.int64) for i in (0, 1))
        self.made = new = np.array([vocab[x + y] for x, y in pairs], dtype=np.int64)
        self.rank[new], self.left[new], self.right[new] = np.arange(len(new)), a, b
        if len(set(new.tolist())) < len(new) or (np.maximum(self.rank[a], self.rank[b]) >= np.arange(len(new))).any():
            raise ValueError("a token has two merges, or a merge comes before its parts")
        order = np.argsort(a * self.size + b)
        self._pair, self._pair_rank = (a * self.size + b)[order], order
        self._merge = {(x, y): r for r, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True))}
        self.place = self._places(vocab, suffix, a, b)
        self.automaton = ahocorasick.Automaton()
        for key, i in self.place.items():
            self.automaton.add_word(key, i)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.place))
        self.width = np.array([len(t) - len(suffix) * t.endswith(suffix) for t in self.text], dtype=np.int64)
        self.closes = np.array([t.endswith(suffix) for t in self.text])

    def _places(self, vocab: dict[str, int], suffix: str, a: np.ndarray, b: np.ndarray) -> dict[str, int]:
        """Tokens that encode to themselves, by their characters."""
        whole = self.first_crossing(a, b) == np.arange(len(a))
        own: dict[int, bool] = {}
        for t, x, y, ok in zip(self.made.tolist(), a.tolist(), b.tolist(), whole.tolist(), strict=True):
            own[t] = ok and own.get(x, True) and own.get(y, True)
        out = {}
        for token, i in vocab.items():
            ends = token.endswith(suffix)
            key = token[:len(token) - len(suffix)] if ends else token
            if own.get(i, len(key) == 1):
                out[key + _END if ends else key] = i
        return out

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._pair, key), len(self._pair) - 1)
        return np.where(self._pair[at] == key, self._pair_rank[at], NEVER)

    def first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of neighbouring tokens, the rank of the first merge
        that would join the two sides while they are built, else ``NEVER``.

        The parts next to the border are taken apart in the reverse order of
        their merges, which visits every two parts that stand there at the same
        time. Joining them comes first if its rank is below that of the merge
        that uses up the left part, and not above that of the merge that uses
        up the right one (of equal merges the left place is served first).
        """
        found = np.full(len(a), NEVER, dtype=np.int64)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(a), NEVER, dtype=np.int64), np.full(len(a), NEVER, dtype=np.int64)
        while len(live):
            m = self.pair_ranks(x, y)
            comes = (m < until_x) & (m <= until_y)
            found[live[comes]] = np.minimum(found[live[comes]], m[comes])
            rx, ry = self.rank[x], self.rank[y]
            undo_y = (ry >= rx) & (ry >= 0)
            undo_x = ~undo_y & (rx >= 0)
            until_y, y = np.where(undo_y, ry, until_y), np.where(undo_y, self.left[y], y)
            until_x, x = np.where(undo_x, rx, until_x), np.where(undo_x, self.right[x], x)
            on = undo_x | undo_y
            live, x, y, until_x, until_y = live[on], x[on], y[on], until_x[on], until_y[on]
        return found

    def _hard_words(self, text: str) -> Iterator[str]:
        for piece in _PIECE.findall(text):
            for part in self.special_cut.split(piece) if self.special_cut else (piece,):
                if _END + part in self.special:
                    yield _END + part
                elif part:
                    low = self._normal.normalize_str(part) if self._normal is not None else part
                    yield from (w for w, _ in self._split.pre_tokenize_str(low))

    def words(self, text: str) -> list[str]:
        """Normalised words of a text in order; a special token is its string
        behind a line break."""
        if self.easy and _EASY.fullmatch(text) and not (self.special_cut and self.special_cut.search(text)):
            return _WORD.findall(text.lower())
        return list(self._hard_words(text))

    def propose(self, word: str) -> list[int]:
        """Greedy longest match of a word in the byte alphabet, such that the
        end of the word is never left alone."""
        s, out, p = word + _END, [], 0
        while p < len(s):
            for q in range(min(len(s), p + self.longest), p, -1):
                if q != len(s) - 1 and s[p:q] in self.place:
                    break
            out.append(self.place[s[p:q]])
            p = q
        return out

    def proposals(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words: tokens, and the first of each."""
        found = [[i for _, i in self.automaton.iter_long(w + _END)] for w in words]
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(words))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(n.sum()))
        start = np.cumsum(n) - n
        # the longest match may leave the end of a word alone, which is no token
        covered = np.add.reduceat(self.width[flat], start) if len(flat) and n.all() else np.zeros(len(words), dtype=np.int64)
        whole = (covered == np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        if len(flat) and n.all():
            whole &= self.closes[flat[start + n - 1]]
        if whole.all():
            return flat, start
        for i in np.flatnonzero(~whole).tolist():
            found[i] = self.propose(words[i])
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(words))
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(n.sum())), np.cumsum(n) - n

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging of one word: the merge of least rank first, the
        leftmost of equals."""
        ids: list[int | None] = list(symbols)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self._merge[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self._merge]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j >= n or self._merge.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = int(self.made[rank]), None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for u, v in ((before[i], i), (i, after[i])):
                if u >= 0 and v < n and (ids[u], ids[v]) in self._merge:
                    heapq.heappush(heap, (self._merge[ids[u], ids[v]], u))
        return [i for i in ids if i is not None]

    def merge_all(self, words: Sequence[str]) -> list[list[int]]:
        """Exact merging of many words. Every round takes one merge of each word
        that still has one; words beyond ``LONG_WORD`` go one by one."""
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.fromiter((self._byte[c] for w in words for c in w), dtype=np.int64, count=int(length.sum()))
        start = np.cumsum(length) - length
        ids = self.first[raw]
        ids[start + length - 1] = self.last[raw[start + length - 1]]
        out: list[list[int]] = [[]] * len(words)
        for i in np.flatnonzero(length > LONG_WORD).tolist():
            out[i] = self.merge(ids[start[i]:start[i] + length[i]].tolist())
        owner = np.repeat(np.arange(len(words)), length)
        keep = length[owner] <= LONG_WORD
        ids, owner = ids[keep], owner[keep]
        rank = np.full(len(ids), NEVER, dtype=np.int64)  # of the merge with the next symbol of the word

        def refresh(at: np.ndarray) -> None:
            rank[at] = NEVER
            at = at[(at >= 0) & (at < len(ids) - 1)]
            at = at[owner[at] == owner[at + 1]]
            rank[at] = self.pair_ranks(ids[at], ids[at + 1])

        refresh(np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            n = np.diff(first, append=len(ids))
            done = least == NEVER
            flat = ids.tolist()
            for o, i, k in zip(owner[first[done]].tolist(), first[done].tolist(), n[done].tolist(), strict=True):
                out[o] = flat[i:i + k]
            keep = np.repeat(~done, n)
            ids, owner, rank, least = ids[keep], owner[keep], rank[keep], np.repeat(least, n)[keep]
            at = np.flatnonzero(rank == least)
            at = at[np.diff(owner[at], prepend=-1) != 0]
            ids[at] = self.made[rank[at]]
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            at = (np.cumsum(stay) - 1)[at]
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            refresh(np.concatenate([at, at[at > 0] - 1]))
        return out

    def encode_words(self, words: Sequence[str]) -> tuple[list[list[int]], int]:
        """Ids of each normalised word, and how many failed the check."""
        if not words:
            return [], 0
        shown = [w if w.isascii() and w.isprintable() else w.encode("utf-8").decode("latin-1").translate(self._visible) for w in words]
        flat, start = self.proposals(shown)
        n = np.diff(start, append=len(flat))
        owner = np.repeat(np.arange(len(words)), n)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        crossed = self.first_crossing(flat[inner], flat[inner + 1]) != NEVER
        failing = np.unique(owner[inner[crossed]]).tolist()
        ids = flat.tolist()
        out = [ids[i:j] for i, j in zip(start.tolist(), (start + n).tolist(), strict=True)]
        for i, merged in zip(failing, self.merge_all([shown[i] for i in failing]), strict=True):
            out[i] = merged
        return out, len(failing)


@functools.lru_cache(maxsize=2)
def merge_table(source: str) -> MergeTable:
    return MergeTable(source)


class WordTable:
    """Token count, ids as decimal text and decoded text of the words met so
    far. Emptied when it would pass ``entries``, which changes no result."""

    def __init__(self, source: str, entries: int = TABLE_ENTRIES):
        self.model, self.entries = merge_table(source), entries
        self.special = {w: (1, self.model.number[i], self.model.text[i]) for w, i in self.model.special.items()}
        self.table: dict[str, tuple[int, str, str]] = dict(self.special)
        self.tried = self.failed = 0

    def _add(self, words: list[str]) -> None:
        found, failed = self.model.encode_words(words)
        self.tried, self.failed = self.tried + len(words), self.failed + failed
        number, text = self.model.number, self.model.text
        for w, ids in zip(words, found, strict=True):
            self.table[w] = len(ids), " ".join([number[i] for i in ids]), " ".join([text[i] for i in ids])

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[int, str, str]]:
        """For each text the number of ids, the ids as decimal numbers joined by
        one space, and what they decode to. The new words of all texts are
        encoded together."""
        own = [self.model.words(t) if t else [] for t in texts]
        distinct = set().union(*own)
        new = [w for w in distinct if w not in self.table]
        if len(self.table) + len(new) > self.entries:
            self.table = dict(self.special)
            new = [w for w in distinct if w not in self.table]
        self._add(new)
        for words in own:
            got = [self.table[w] for w in words]
            yield sum([e[0] for e in got]), " ".join([e[1] for e in got]), " ".join([e[2] for e in got])


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encode every whole text without added special tokens and decode the ids
    again. ``tokenizer`` is the text of a tokenizer file.

    Returns one row per input row: the id column, ``n_tokens``, ``ids_sha256``
    (of the decimal ids joined by one space), ``decoded_sha256`` (of the decoded
    text in UTF-8), and on demand ``ids`` (array<int>) and ``decoded``. A null
    text counts as empty: no ids and an empty decoded text. A special token's
    string in a text is that token, as in the library. Repeated rows and null
    ids stay; other columns are not read, so their names may clash; an empty
    table gives an empty one. Texts of any length are taken whole; a word of n
    letters takes time with n log n. Memory: one Arrow batch, the bounded word
    table, and the results of one block of texts (or of one longer text).
    Nothing is shuffled.
    """
    merge_table(tokenizer)  # raises here rather than in a task
    extra = (", ids array<int>" if with_ids else "") + (", decoded string" if with_text else "")
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(tokenizer)
        for batch in batches:
            for i, j, texts in column_blocks(batch.column(1)):
                n, digest, back_digest, ids, back = [], [], [], [], []
                for count, numbers, text in table.encode(texts):
                    n.append(count)
                    digest.append(hashlib.sha256(numbers.encode("ascii")).hexdigest())
                    back_digest.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                    if with_ids:
                        ids.append(np.array(numbers.split(), dtype=np.int32))
                    if with_text:
                        back.append(text)
                cols = [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(digest), pa.array(back_digest)]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                if with_text:
                    cols.append(pa.array(back, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")
