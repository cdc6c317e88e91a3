"""Secret scan: fixed patterns plus dictionary-primed zstandard novelty.

The base patterns find assignments, access ids and long hexadecimal runs. The
novelty method looks at every other token of secret-like characters that stands
in a sensitive context: the surrounding code together with a dictionary of
identifiers primes a zstandard compressor, and the bytes that the token adds to
the compressed size tell how much of it is new. A token that costs nearly its
own length, or as much as evenly used characters of its alphabet must cost, is
random to the compressor and is reported, with the lines that carry it on.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import column_blocks

# The base patterns and the least length of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 24
KINDS = ("assign", "access", "hex", "novel")

# runs shorter than the least length fail and cannot hide a longer one, as a
# hexadecimal match always takes its whole run
_HEX_LONG = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Words that make what follows on the line sensitive.
CONTEXT = re.compile(r"(?:pass(?:wor|wd|phrase)|secret|token|api.?key|access.?key|private.?key|credential|bearer|authorization|signature|client.?id)", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
# A private key in armour, up to its last line.
ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(?=(.*?)-----END )", re.DOTALL)
# A line break (also an escaped one, or one between quoted pieces) and a line
# that is a candidate as a whole.
_BREAK = r"""["']?[,;]?[ \t]*[+\\]?[ \t]*(?:\r?\n|(?:\\r)?\\n)"""
NEXT_LINE = re.compile(_BREAK + r"""[ \t]*["'#>]?[ \t]*([A-Za-z0-9+/_=-]+)(?=["',;]*[ \t]*[+\\]?[ \t]*(?:\r?\n|\\[rn]|\Z)|["'])""")
ARMOUR_END = re.compile(_BREAK + r"""[ \t]*["'#>]?[ \t]*-----END """)

# Identifiers of ordinary code and configuration, the least frequent first
# (zstandard reaches the end of a dictionary with the shortest offsets).
IDENTIFIERS = """
abstract assert async await boolean break buffer callback catch certificate channel class client close cluster
column commit component config configuration connection const constructor container context continue controller
counter create database datetime debug default delete dependency description destination directory
document domain double element encoding endpoint environment exception execute export extends factory false field
filename filter final finally float format function generator getattr global handler hashlib header hostname html
http https identifier import index initialize instance integer interface internal iterator javascript json
keyword lambda language length library license listener local logger logging message metadata method module
namespace network number object operator option output package parameter password path pattern pointer
port private process production project property protected protocol public query queue random record
refresh_token regex register remote repository request require resource response result return schema script
secret_key server service session setting signature socket source static status stream string struct
super switch system table target template test text thread throw timeout timestamp token access_token
transaction true type undefined update upload username utf-8 validate value variable vector version
void volatile warning while window worker xmlns yield api_key user_id client_secret authorization bearer
self.assertEqual def __init__(self, return None if __name__ == "__main__": public static void main(String[] args)
"""


@dataclass(frozen=True)
class NoveltyRule:
    """Parameters of the novelty method.

    ``least``: characters of a candidate; ``before``: characters in front of it
    in which a sensitive word must end; ``around``: characters of code on each
    side that prime the compressor; ``ratio``: added bytes per character from
    which it is reported (random base-64 costs about 0.75 and more); ``coded``:
    characters from which the compressor codes single characters, so that fewer
    added bytes are enough for a smaller alphabet, if its characters are used
    evenly (entropy at least ``even`` of the alphabet's); ``level``: of
    compression.
    """

    least: int = 16
    before: int = 40
    around: int = 512
    ratio: float = 0.7
    coded: int = 64
    even: float = 0.9
    level: int = 3


@functools.lru_cache(maxsize=4)
def _tools(level: int):
    import zstandard

    return zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0), zstandard


def marginal_bytes(candidate: str, before: str, after: str, identifiers: str = IDENTIFIERS, level: int = 3) -> int:
    """Compressed bytes that ``candidate`` adds, with the identifiers and the
    code on both sides as the compressor's dictionary."""
    params, z = _tools(level)
    prime = (identifiers + after + before).encode("utf-8", "surrogatepass")
    comp = z.ZstdCompressor(dict_data=z.ZstdCompressionDict(prime, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
    tail = before[-32:].encode("utf-8", "surrogatepass")
    return len(comp.compress(tail + candidate.encode("ascii"))) - len(comp.compress(tail))


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the base patterns: leftmost matches that do
    not overlap within a kind, of which those too short are dropped; ordered by
    start, then kind as in ``KINDS``."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(*m.span(), "hex") for m in _HEX_LONG.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _least_ratio(candidate: str, rule: NoveltyRule) -> float:
    """Added bytes per character from which a candidate is reported."""
    n, counts = len(candidate), Counter(candidate)
    if n < rule.coded or len(counts) < 2:
        return rule.ratio
    most = math.log2(len(counts))
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    return min(rule.ratio, most / 8) if entropy >= rule.even * most else rule.ratio


def _is_novel(text: str, s: int, e: int, rule: NoveltyRule) -> bool:
    if e - s < rule.least:
        return False
    cost = marginal_bytes(text[s:e], text[max(0, s - rule.around):s], text[e:e + rule.around], level=rule.level)
    return cost >= _least_ratio(text[s:e], rule) * (e - s)


def _carried_on(text: str, e: int, width: int, rule: NoveltyRule) -> int:
    """End of the block whose line of ``width`` characters ends at ``e``: lines
    as long as that one or novel themselves belong to it, and a shorter last
    line that is not a plain word or stands before the end of an armour."""
    while m := NEXT_LINE.match(text, e):
        line, n = m[1], len(m[1])
        if (n != width or n < rule.least) and not _is_novel(text, *m.span(1), rule):
            last = n < width and (ARMOUR_END.match(text, m.end(1)) or re.search(r"[0-9+/=]", line) and re.search(r"[A-Za-z0-9]", line))
            return m.end(1) if last else e
        e, width = m.end(1), n
    return e


def novel_spans(text: str | None, taken: list[tuple[int, int, str]], rule: NoveltyRule) -> list[tuple[int, int, str]]:
    """Spans of incompressible candidates in a sensitive context, each with the
    lines that carry it on, and of such lines behind a span of ``taken``. Apart
    from those lines no span of ``taken`` is overlapped."""
    if not text:
        return []
    found: dict[int, tuple[int, int, str]] = {}
    inside = lambda s: any(a <= s < b for a, b, _ in found.values())

    def look(start: int, stop: int) -> None:
        for m in CANDIDATE.finditer(text, start):
            s, e = m.span()
            if s > stop:
                break
            if s in found or e - s < rule.least or any(a < e and s < b for a, b, _ in taken) or inside(s):
                continue
            if _is_novel(text, s, e, rule):
                escaped = text[s - 1:s + 1] == "\\n"  # the letter of a line break
                found[s] = (s, _carried_on(text, e, e - s - escaped, rule), "novel")

    for a, b, _ in taken:
        m = NEXT_LINE.match(text, b)
        if m and not inside(m.start(1)) and _is_novel(text, *m.span(1), rule) and not any(x < m.end(1) and m.start(1) < y for x, y, _ in taken):
            found[m.start(1)] = (m.start(1), _carried_on(text, m.end(1), len(m[1]), rule), "novel")
    for c in CONTEXT.finditer(text):
        look(c.end(), c.end() + rule.before)
    for c in ARMOUR.finditer(text):
        look(c.end(), c.end(1) - 1)
    return list(found.values())


def all_spans(text: str | None, rule: NoveltyRule) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and base with novel spans, both ordered."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, rule), key=lambda s: (s[0], KINDS.index(s[2])))


def _line(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str | None, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones merged) replaced by ``mark``."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: NoveltyRule = NoveltyRule()) -> DataFrame:
    """Find secrets in every whole text.

    Returns one row per input row: the id column, ``n_assign``, ``n_access``,
    ``n_hex``, ``n_novel`` (long), ``base_sha256`` (of the base spans as
    ``kind:start:end``, comma-joined; code points, end exclusive) and ``spans``
    (all spans, joined likewise). A span covers the whole match, an assignment
    with its key word. A null text counts as empty (no spans). Other columns
    are not read. Repeated rows and null ids stay; an empty table gives an
    empty one. Each text is handled by itself, so nothing is shuffled.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [all_spans(v.as_py(), rule) for v in batch.column(1)]
            count = lambda name: pa.array([sum(k == name for _, _, k in every) for _, every in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(count(k) for k in KINDS),
                 pa.array([hashlib.sha256(_line(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                 pa.array([_line(every) for _, every in rows], pa.string())],
                [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return src.mapInArrow(run, f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string")


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                     rule: NoveltyRule = NoveltyRule(), mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs`` with the secrets of the text replaced
    by ``mark``; ``length_col``, where the table has it, follows the new text
    of rows that change. Null texts stay null."""
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, old in column_blocks(batch.column(at)):
                part = batch.slice(i, j - i)
                cols = list(part.columns)
                new = [redact(t, all_spans(t, rule)[1], mark) for t in old]
                cols[at] = pa.array(new, cols[at].type)
                if length_at is not None:
                    had = cols[length_at]
                    cols[length_at] = pa.array([h if o == n else len(n) for h, o, n in zip(had.to_pylist(), old, new, strict=True)], had.type)
                yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return docs.mapInArrow(run, fields)
