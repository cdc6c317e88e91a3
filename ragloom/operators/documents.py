"""Document jobs: decode bytes, sniff real types, extract HTML main text, safe
parse with classified errors, table records, chunking, caption cleaning,
dictionary repair, dataset cleaning and versions (TXT1-TXT14, FIL14, AGG17-19,
AGG23).

Everything that is regular-expression or string work is a built-in column
(JVM side, code-generated); only recursive chunking needs Python and runs as
one vectorised ``mapInPandas`` over document batches.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# TXT1: decode raw bytes
# ---------------------------------------------------------------------------

# Candidate single-byte encodings tried when bytes are not UTF-8,
# in order; the one whose text has the highest share of letters wins.
CANDIDATE_CHARSETS = ["windows-1251", "ISO-8859-1"]


def decode_files(files: DataFrame, content: str = "content") -> DataFrame:
    """TXT1: BOM strip, UTF-8 when valid, otherwise the candidate charset whose
    decoded text has the largest share of letters (ties: list order); adds
    ``encoding, had_bom, text, char_count``. Needs
    ``spark.sql.legacy.javaCharsets=true`` for windows-1251."""
    c = F.col(content)
    had_bom = F.hex(F.substring(c, 1, 3)) == "EFBBBF"
    body = F.when(had_bom, F.expr(f"substring({content}, 4)")).otherwise(c)
    df = files.withColumn("had_bom", F.coalesce(had_bom, F.lit(False))).withColumn("_body", body)
    utf8_ok = F.is_valid_utf8(F.col("_body").cast("string"))

    def letter_share(t: Column) -> Column:
        """Share of letters, minus the share of implausible words: words that
        mix Latin and Cyrillic letters (Latin text read as Cyrillic) and words
        made only of accented Latin letters (Cyrillic text read as Latin)."""
        n = F.length(t)
        letters = F.length(F.regexp_replace(t, r"(?U)[^\p{L}]", ""))
        words = F.regexp_count(t, F.lit(r"(?U)\b\p{L}+\b"))
        mixed = F.regexp_count(t, F.lit(r"(?U)\b(?=\p{L}*\p{IsCyrillic})(?=\p{L}*\p{IsLatin})\p{L}+\b"))
        accented = F.regexp_count(t, F.lit(r"(?U)\b[\p{IsLatin}&&[^a-zA-Z]]{3,}\b"))
        bad = F.when(words > 0, (mixed + accented) / words).otherwise(F.lit(0.0))
        return F.when(n > 0, letters / n - bad).otherwise(F.lit(0.0))

    best_enc = None
    best_score = None
    for cs in CANDIDATE_CHARSETS:
        t = F.decode(F.col("_body"), cs)
        sc = letter_share(t)
        if best_enc is None:
            best_enc, best_score = F.lit(cs), sc
        else:
            better = sc > best_score
            best_enc = F.when(better, F.lit(cs)).otherwise(best_enc)
            best_score = F.when(better, sc).otherwise(best_score)
    enc = F.when(F.length(F.col("_body")) == 0, F.lit("utf-8")).when(utf8_ok, F.lit("utf-8")).otherwise(best_enc)
    df = df.withColumn("encoding", enc)
    text = F.when(F.col("encoding") == "utf-8", F.decode(F.col("_body"), "UTF-8"))
    for cs in CANDIDATE_CHARSETS:
        text = text.when(F.col("encoding") == cs, F.decode(F.col("_body"), cs))
    return df.withColumn("text", text).withColumn("char_count", F.length("text")).drop("_body")


# ---------------------------------------------------------------------------
# TXT2: real type vs declared suffix
# ---------------------------------------------------------------------------

# Leading-byte signatures (hex) and the type they announce.
MAGIC = [
    ("25504446", "pdf"),
    ("89504E47", "png"),
    ("FFD8FF", "jpg"),
    ("47494638", "gif"),
    ("1F8B", "gz"),
    ("504B0304", "zip"),
]
# Entry-name markers that turn a zip into an office type.
ZIP_SUBTYPES = [("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx")]


def suffix_of(path: Column) -> Column:
    """FUN7: lower-case extension without the dot ('' when none)."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def detect_type(content: Column) -> Column:
    """Magic bytes first; a zip that names office parts becomes docx/xlsx/pptx;
    otherwise HTML when the first 512 bytes (lower-cased) hold
    ``<html`` or ``<!doctype``; otherwise null (unknown)."""
    head_hex = F.hex(F.substring(content, 1, 8))
    out = None
    for sig, typ in MAGIC:
        cond = head_hex.startswith(sig)
        val = F.lit(typ)
        if typ == "zip":
            whole = F.decode(content, "ISO-8859-1")
            sub = F.lit("zip")
            for marker, t in reversed(ZIP_SUBTYPES):
                sub = F.when(F.instr(whole, marker) > 0, F.lit(t)).otherwise(sub)
            val = sub
        out = F.when(cond, val) if out is None else out.when(cond, val)
    head = F.lower(F.decode(F.substring(content, 1, 512), "ISO-8859-1"))
    html = (F.instr(head, "<html") > 0) | (F.instr(head, "<!doctype") > 0)
    return out.when(html, F.lit("html"))


def file_types(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """TXT2: ``declared_type, detected_type, is_mismatch, issue``. Empty is a
    mismatch; unknown content is not (S22)."""
    declared = suffix_of(F.col(path))
    empty = F.coalesce(F.length(F.col(content)), F.lit(0)) == 0
    detected = F.when(empty, F.lit(None).cast("string")).otherwise(detect_type(F.col(content)))
    df = files.withColumn("declared_type", declared).withColumn("detected_type", detected)
    mism = F.when(empty, F.lit(True)).otherwise(F.col("detected_type").isNotNull() & (F.col("detected_type") != F.col("declared_type")))
    issue = F.when(empty, F.lit("empty file")).when(
        mism, F.concat(F.lit("declared ."), F.col("declared_type"), F.lit(" but detected "), F.col("detected_type")))
    return df.withColumn("is_mismatch", mism).withColumn("issue", issue)


# ---------------------------------------------------------------------------
# TXT3: HTML main text
# ---------------------------------------------------------------------------

# Elements dropped with their content, and the entities decoded.
DROPPED_TAGS = ["script", "style", "nav", "header", "footer", "aside"]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
SEP = "\u0001"


def html_text(html: Column) -> Column:
    """Main text of an HTML string: dropped elements and comments removed, each
    text node stripped, empty nodes skipped, nodes joined by newlines."""
    t = html
    for tag in DROPPED_TAGS:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b.*?</{tag}\s*>", SEP)
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", SEP)
    t = F.regexp_replace(t, r"(?s)<!doctype[^>]*>|<!DOCTYPE[^>]*>", SEP)
    t = F.regexp_replace(t, r"(?s)<[^>]*>", SEP)
    for ent, rep in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(rep))
    nodes = F.transform(F.split(t, SEP), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(nodes, lambda x: F.length(x) > 0), "\n")


def html_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """TXT3: adds ``text, raw_size, text_size, useful_ratio``."""
    df = pages.withColumn("text", html_text(F.col(html)))
    raw = F.length(F.col(html))
    return df.withColumn("raw_size", raw).withColumn("text_size", F.length("text")).withColumn(
        "useful_ratio", F.when(F.col("raw_size") > 0, F.col("text_size") / F.col("raw_size")).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------------------
# TXT4 / UDF6: safe parse
# ---------------------------------------------------------------------------

Extractor = Callable[[DataFrame], DataFrame]


def parse_files(files: DataFrame, path: str = "path", content: str = "content",
                extractors: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """TXT4 / UDF6: route every file to ``ok`` or a classified error; never fails.

    Empty -> ``empty``; declared vs real type mismatch -> ``type_mismatch``;
    otherwise the bytes are decoded (TXT1) and the extractor of the declared
    type gets the text (by default HTML main text, or the text itself); a type
    without an extractor, or an extractor returning null, is ``corrupted``
    (S23).
    """
    extractors = extractors or {"html": html_text, "htm": html_text, "txt": lambda t: t, "md": lambda t: t}
    t = decode_files(file_types(files, path, content), content).withColumnRenamed("text", "_decoded").drop("char_count")
    text = F.lit(None).cast("string")
    for typ in reversed(list(extractors)):
        text = F.when(F.col("declared_type") == typ, extractors[typ](F.col("_decoded"))).otherwise(text)
    empty = F.coalesce(F.length(F.col(content)), F.lit(0)) == 0
    t = t.withColumn("_text", F.when(~empty & ~F.col("is_mismatch"), text))
    status = F.when(empty | F.col("is_mismatch") | F.col("_text").isNull(), F.lit("error")).otherwise(F.lit("ok"))
    etype = F.when(empty, F.lit("empty")).when(F.col("is_mismatch"), F.lit("type_mismatch")).when(
        F.col("_text").isNull(), F.lit("corrupted"))
    emsg = F.when(empty, F.lit("file is empty")).when(F.col("is_mismatch"), F.col("issue")).when(
        F.col("_text").isNull(), F.concat(F.lit("no extractor produced text for ."), F.col("declared_type")))
    return t.withColumn("status", status).withColumn("error_type", etype).withColumn("error_message", emsg).withColumn(
        "text", F.when(F.col("status") == "ok", F.col("_text"))).withColumn(
        "char_count", F.when(F.col("status") == "ok", F.length("_text"))).drop("_text", "_decoded")


# ---------------------------------------------------------------------------
# TXT5: table rows -> records
# ---------------------------------------------------------------------------


def html_cells(pages: DataFrame, file: str = "file", html: str = "html") -> DataFrame:
    """TXT5: cells ``(file, table_no, row_no, col_no, text)`` of all tables of
    HTML files (all numbers from 0); text as in TXT3."""
    inside = lambda c, tag: F.regexp_extract_all(c, F.lit(rf"(?is)(<{tag}\b.*?</{tag}\s*>)"), 1)
    t = pages.select(F.col(file).alias("file"), F.posexplode(inside(F.col(html), "table")).alias("table_no", "_t"))
    r = t.select("file", "table_no", F.posexplode(inside(F.col("_t"), "tr")).alias("row_no", "_r"))
    c = r.select("file", "table_no", "row_no", F.posexplode(inside(F.col("_r"), "t[hd]")).alias("col_no", "_c"))
    return c.select("file", "table_no", "row_no", "col_no", html_text(F.col("_c")).alias("text"))


def records_from_cells(cells: DataFrame, keys: Sequence[str] = ("file", "table_no")) -> DataFrame:
    """TXT5: cells ``(keys..., row_no, col_no, text)`` -> one record per data
    row, ``map(header[col] -> cell)``; row 0 is the header. The header is
    joined back per table (no table is collected whole)."""
    keys = list(keys)
    header = cells.filter(F.col("row_no") == 0).select(*keys, "col_no", F.col("text").alias("name"))
    body = cells.filter(F.col("row_no") > 0).join(header, [*keys, "col_no"], "left")
    entries = F.transform(
        F.sort_array(F.collect_list(F.struct("col_no", "name", "text"))),
        lambda x: F.struct(F.coalesce(x["name"], F.concat(F.lit("col_"), x["col_no"].cast("string"))).alias("k"),
                           x["text"].alias("v")))
    rec = body.groupBy(*keys, "row_no").agg(F.map_from_entries(entries).alias("record"))
    return rec


# ---------------------------------------------------------------------------
# TXT10 / AGG19 / AGG18 / FUN4: chunking
# ---------------------------------------------------------------------------


def fixed_chunks(docs: DataFrame, size: int, overlap: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT10, native variant: fixed-window chunks of ``size`` characters advancing by
    ``size - overlap``: ``(id, chunk_index, start, chunk)``; the last window may
    be shorter; windows wholly inside the previous one are not emitted."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    n = F.length(F.col(text))
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / step) + 1)
    d = docs.select(F.col(id_col).alias(id_col), F.col(text).alias("_t"), count.cast("int").alias("_n"))
    d = d.select(id_col, "_t", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("chunk_index"))
    start = F.col("chunk_index") * step + 1
    return d.select(id_col, "chunk_index", start.alias("start"), F.substring("_t", start, size).alias("chunk"))


def chunk_sweep(docs: DataFrame, sizes: Sequence[int], overlaps: Sequence[int], id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """AGG19 / WIN5: chunk counts and mean length for a grid of (size, overlap), plus
    the extra chunks over the smallest overlap of the same size. The grid is
    exploded per document (one row per setting), chunk counts and lengths are
    computed arithmetically without materialising chunks."""
    grid = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(o).alias("overlap")) for s in sizes for o in overlaps])
    n = F.length(F.col(text))
    d = docs.select(n.alias("n"), F.explode(grid).alias("g")).select("n", "g.size", "g.overlap")
    step = F.col("size") - F.col("overlap")
    cnt = F.when(F.col("n") <= F.col("size"), F.lit(1)).otherwise(F.ceil((F.col("n") - F.col("size")) / step) + 1)
    last_len = F.col("n") - (cnt - 1) * step
    total_len = (cnt - 1) * F.col("size") + last_len
    d = d.withColumn("cnt", cnt.cast("bigint")).withColumn("len", total_len.cast("bigint"))
    g = d.groupBy("size", "overlap").agg(F.sum("cnt").alias("chunks"), F.sum("len").alias("_len"))
    g = g.withColumn("mean_length", F.round(F.col("_len") / F.col("chunks"), 4))
    w = Window.partitionBy("size").orderBy("overlap").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return g.withColumn("extra_chunks", F.col("chunks") - F.first("chunks").over(w)).drop("_len")


def char_length(s: str) -> int:
    return len(s)


def word_tokens(s: str) -> int:
    """Default token length: word and punctuation pieces (no model files)."""
    import re

    return len(re.findall(r"\w+|[^\w\s]", s))


DEFAULT_SEPARATORS = ["\n\n", "\n", " ", ""]
MARKDOWN_SEPARATORS = ["\n## ", "\n### ", "\n\n", "\n", ". ", " ", ""]


def _windows(sizes: Sequence[int], gap: int, limit: int, shared: int) -> list[tuple[int, int]]:
    """Runs ``[i, j)`` of consecutive pieces, joined by ``gap``: each as long as
    fits into ``limit`` (at least one new piece); the next one starts at the
    first piece from which what it repeats is at most ``shared`` long and leaves
    room for the piece after it (empty pieces are repeated without asking for
    room). Found by bisection in the prefix sums of the sizes."""
    ends = list(accumulate((n + gap for n in sizes), initial=0))
    width = lambda i, j: ends[j] - ends[i] - gap if j > i else 0
    out, i, j, n = [], 0, 0, len(sizes)
    while j < n:
        j = max(bisect_right(ends, limit + gap + ends[i]) - 1, j + 1)
        out.append((i, j))
        if j < n:
            first = lambda at: bisect_left(ends, at - gap)
            i = min(max(first(ends[j] - shared), min(first(ends[j + 1] - limit), first(ends[j]))), j)
    return out


def split_text(text: str, size: int, overlap: int, separators: Sequence[str] = DEFAULT_SEPARATORS, length=char_length) -> list[str]:
    """Recursive splitting. A text is cut at the first separator that occurs in
    it; neighbouring pieces shorter than ``size`` are joined into chunks of at
    most ``size`` that share up to ``overlap`` (:func:`_windows`); a longer
    piece is cut in turn at the separators after that one, and stands as it is
    when none is left. Chunks are stripped, empty ones dropped."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    sep, finer = separators[at], separators[at + 1:]
    pieces = text.split(sep) if sep else list(text)
    out: list[str] = []
    for small, run in groupby(pieces, key=lambda p: length(p) < size):
        if small:
            run = list(run)
            joined = (sep.join(run[i:j]) for i, j in _windows([length(p) for p in run], length(sep), size, overlap))
            out.extend(c for c in map(str.strip, joined) if c)
        else:
            for p in run:
                out.extend(split_text(p, size, overlap, finer, length) if finer else [p])
    return out


CHUNK_ROWS = 4096  # chunks that a task gives out at a time


def recursive_chunks(docs: DataFrame, size: int = 512, overlap: int = 50, separators: Sequence[str] = DEFAULT_SEPARATORS,
                     length: Callable[[str], int] = char_length, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT10 / UDF5: recursive chunks per document ``(id, chunk_index, chunk,
    length)`` computed over Arrow batches of documents (documents are never
    grouped or collected); a task holds one document's chunks and some rows."""
    id_type = docs.schema[id_col].dataType.simpleString()
    seps = list(separators)

    def rows(batch):
        for i, t in zip(batch.column(0), batch.column(1), strict=True):
            for j, c in enumerate(split_text(t.as_py() or "", size, overlap, seps, length)):
                yield i.as_py(), j, c, length(c)

    def fn(batches):
        for b in batches:
            chunked = rows(b)
            while part := list(islice(chunked, CHUNK_ROWS)):
                ids, idx, chunks, lens = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(idx, pa.int32()), pa.array(chunks, pa.string()), pa.array(lens, pa.int32())],
                                                 [id_col, "chunk_index", "chunk", "length"])

    from .common import ensure_parallel

    return ensure_parallel(docs.select(id_col, text)).mapInArrow(
        fn, f"{id_col} {id_type}, chunk_index int, chunk string, length int")


def section_of(chunk: Column) -> Column:
    """FUN4: first Markdown heading (levels 1-3) of a chunk, or null."""
    h = F.trim(F.regexp_extract(chunk, r"(?m)^[ \t]*#{1,3}[ \t]+(.+?)[ \t]*$", 1))
    return F.when(h != "", h)


def chunk_stats(chunks: DataFrame, length: str = "length") -> DataFrame:
    """AGG18: count, integer mean, min and max chunk length."""
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.avg(length).cast("bigint").alias("avg_length"),
                      F.min(length).alias("min_length"), F.max(length).alias("max_length"))


def token_count(text: Column) -> Column:
    """Word and punctuation pieces of a text, as a column."""
    return F.size(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"), 1))


def chunk_points(chunks: DataFrame, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """TXT11: chunks ``(id, source, chunk_index, chunk)`` -> index rows with a
    stable id ``sha2(source | id | chunk_index)`` for upserts, section (FUN4),
    token count and hashed embedding."""
    from .embed import hashed_embedding

    point = F.sha2(F.concat_ws("|", F.col(source), F.col(id_col).cast("string"), F.col("chunk_index").cast("string")), 256)
    ch = chunks.select(point.alias("point_id"), id_col, source, "chunk_index", "chunk", section_of(F.col("chunk")).alias("section"),
                       token_count(F.col("chunk")).alias("token_count"))
    return ch.join(hashed_embedding(ch.select("point_id", "chunk"), "point_id", "chunk"), "point_id", "left")


def build_chunk_index(docs: DataFrame, size: int = 500, overlap: int = 50, id_col: str = "doc_id", text: str = "text",
                      source: str = "source", length: Callable[[str], int] = word_tokens) -> DataFrame:
    """TXT11 over recursive chunks (Markdown separators, word tokens)."""
    ch = recursive_chunks(docs, size, overlap, MARKDOWN_SEPARATORS, length, id_col, text)
    return chunk_points(ch.join(docs.select(id_col, source), id_col), id_col, source)


# ---------------------------------------------------------------------------
# TXT6 / TXT7 / WIN3: caption cleaning
# ---------------------------------------------------------------------------

# Fixed value: the time line that opens a cue.
CUE_TIME = r"^\d{2}:\d{2}:\d{2}\.\d{3}\s*-->"
# Entity replacements in the order they are applied (S20).
CAPTION_ENTITIES = [("&gt;", ""), ("&lt;", ""), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]


def clean_caption_line(line: Column) -> Column:
    """FUN2: tags stripped, entities replaced, white space squeezed."""
    t = F.regexp_replace(line, "<[^>]+>", "")
    t = F.regexp_replace(t, r"^\s+|\s+$", "")
    for ent, rep in CAPTION_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(rep))
    t = F.regexp_replace(t, r"\s+", " ")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def clean_captions(lines: DataFrame, file: str = "file", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """TXT6 / WIN3 / FUN3: caption lines -> one cleaned text per file.

    A time line opens a cue, a blank line (after strip) closes it; the last
    non-empty cleaned line of each cue is kept (so text after a blank-looking
    line is lost, S20); consecutive repeats are dropped; lines are joined with
    spaces, whitespace squeezed and sentences broken after ``.!?``. Ordering
    is per file only; the lines are read once.
    """
    l = lines.select(F.col(file).alias("file"), F.col(line_no).alias("line_no"), F.col(line).alias("line"))
    is_time = F.col("line").rlike(CUE_TIME)
    is_blank = F.col("line").rlike(r"^\s*$")
    l = l.withColumn("_time", is_time).withColumn("_blank", is_blank & ~is_time)
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.col("_time") | F.col("_blank")
    l = l.filter(F.col("file").isNotNull()).withColumn("seg", F.sum(mark.cast("int")).over(w)).withColumn(
        "in_cue", F.last(F.when(mark, F.col("_time")), ignorenulls=True).over(w))
    body = l.filter(~F.col("_time") & ~F.col("_blank") & F.col("in_cue"))
    body = body.withColumn("clean", clean_caption_line(F.col("line"))).filter(F.length("clean") > 0)
    cues = body.groupBy("file", "seg").agg(F.max_by("clean", "line_no").alias("clean"))
    wd = Window.partitionBy("file").orderBy("seg")
    cues = cues.withColumn("_prev", F.lag("clean").over(wd)).filter(
        F.col("_prev").isNull() | (F.col("_prev") != F.col("clean")))
    doc = cues.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("seg", "clean"))).alias("_c"))
    text = F.array_join(F.transform("_c", lambda x: x["clean"]), " ")
    text = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"^\s+|\s+$", "")
    text = F.regexp_replace(text, r"([.!?])\s+", "$1\n")
    return doc.select("file", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))


def caption_corpus(captions: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """TXT7: the cleaned texts in file order as one corpus, each followed by a
    blank line (one column, ready for a text writer)."""
    return captions.orderBy(file).select(F.concat(F.col(text), F.lit("\n")).alias("value"))


# ---------------------------------------------------------------------------
# TXT8 / AGG17: dictionary repair with per-rule counts
# ---------------------------------------------------------------------------


WORD = r"[\p{L}\p{N}_]+"
PIECES = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"


def _cap(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))


def repair(df: DataFrame, noise: Sequence[str], exact: dict[str, str], variants: dict[str, Sequence[str]],
           proper: Sequence[str], text: str = "text", id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """TXT8: ordered passes - noise markers removed (then runs of spaces and
    spaces after newlines squeezed), exact whole-word fixes, name variants to a
    canonical form, and capitalisation of known proper nouns that are not at a
    sentence start (the previous non-space/tab character exists and is not
    ``.!?`` or a newline). Returns the repaired rows and per-rule counts
    ``(rule, n)`` (AGG17), counted on the text each pass sees.

    Whole words are handled at token level: the text is split once into
    alternating word runs (``[\\p{L}\\p{N}_]+``) and separator runs, each
    rule is an element-wise transform of that array, and the pieces are joined
    back - no look-around, so any regular-expression engine gives the same
    result."""
    counts: list[str] = []
    cur = df.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    for m in noise:
        name = f"noise:{m}"
        n = (F.length("t") - F.length(F.replace(F.col("t"), F.lit(m), F.lit("")))) / F.lit(len(m))
        cur = cur.withColumn(name, n.cast("bigint")).withColumn("t", F.replace(F.col("t"), F.lit(m), F.lit("")))
        counts.append(name)
    cur = cur.withColumn("t", F.regexp_replace(F.regexp_replace("t", "  +", " "), "\n +", "\n"))
    cur = cur.withColumn("p", F.regexp_extract_all(F.col("t"), F.lit(PIECES), 1))

    def word_rule(name: str, old: str, new: Column | str, cond=None):
        nonlocal cur
        hit = lambda x, i: (x == F.lit(old)) & (cond(x, i) if cond else F.lit(True))
        cur = cur.withColumn(name, F.size(F.filter(F.col("p"), lambda x, i: hit(x, i))).cast("bigint"))
        repl = (lambda x: F.lit(new)) if isinstance(new, str) else new
        cur = cur.withColumn("p", F.transform(F.col("p"), lambda x, i: F.when(hit(x, i), repl(x)).otherwise(x)))
        counts.append(name)

    for bad, good in exact.items():
        word_rule(f"exact:{bad}->{good}", bad, good)
    for canon, vs in variants.items():
        for v in vs:
            word_rule(f"variant:{v}->{canon}", v, canon)

    def not_sentence_start(x: Column, i: Column) -> Column:
        # separator before the word: 0-based i is the previous piece's 1-based position
        prev = F.try_element_at(F.col("p"), F.greatest(i, F.lit(1)))
        stripped = F.regexp_replace(prev, "[ \t]+$", "")
        last = F.substring(stripped, -1, 1)
        inner = F.when(F.length(stripped) > 0, ~last.isin(".", "!", "?", "\n")).otherwise(i >= 2)
        return F.when(i >= 1, inner).otherwise(F.lit(False))

    for w in proper:
        cap = w[:1].upper() + w[1:]
        word_rule(f"cap:{w}->{cap}", w, _cap, not_sentence_start)
    fixed = cur.select(F.col("id").alias(id_col), F.array_join("p", "").alias(text))
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n")) for n in counts]))
    per_rule = cur.select(stack.alias("r")).groupBy("r.rule").agg(F.sum("r.n").alias("n")).filter(F.col("n") > 0)
    return fixed, per_rule


def _quote(s: str) -> str:
    import re

    return re.escape(s)


# ---------------------------------------------------------------------------
# TXT9 / FIL14 / TXT12: dataset cleaning, quality rules, versions
# ---------------------------------------------------------------------------


def clean_dataset(df: DataFrame, key: str, order: str, labels: Sequence[str], corrections: DataFrame | None = None,
                  required: Sequence[str] | None = None) -> DataFrame:
    """TXT9: keep the first row (lowest ``order``) per key, drop rows with a
    null in ``required`` columns (all by default), lower-case label columns,
    then apply point corrections ``(key, column, value)`` (one left join on
    the key after pivoting the corrections per column)."""
    w = Window.partitionBy(key).orderBy(order)
    d = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    d = d.dropna(how="any", subset=list(required) if required else None)
    for c in labels:
        d = d.withColumn(c, F.lower(F.col(c)))
    if corrections is not None:
        piv = corrections.groupBy(key).pivot("column").agg(F.first("value"))
        fix_cols = [c for c in piv.columns if c != key]
        # corrections are usually few, but their size is not bounded: let the
        # planner choose the join (AQE broadcasts it when it is small)
        d = d.join(piv.select(key, *[F.col(c).alias(f"_fix_{c}") for c in fix_cols]), key, "left")
        for c in fix_cols:
            d = d.withColumn(c, F.coalesce(F.col(f"_fix_{c}").cast(df.schema[c].dataType), F.col(c))).drop(f"_fix_{c}")
    return d


def quality_rules(df: DataFrame, key: str, labels: Sequence[str], expected_rows: Column | int,
                  spot: Sequence[tuple[str, object, str, object]] = ()) -> DataFrame:
    """FIL14: one pass of violation counts -> ``(rule, violations, passed)``.

    Rules: unique key, no null/empty cell, lower-case labels, exact row count,
    and spot checks ``(key_value, column, ...)`` given as ``(name, key_value,
    column, expected)``."""
    cols = df.columns
    empty_cell = F.lit(0)
    for c in cols:
        v = F.col(c)
        empty_cell = empty_cell + F.when(v.isNull() | (v.cast("string") == ""), 1).otherwise(0)
    lower_bad = F.lit(0)
    for c in labels:
        lower_bad = lower_bad + F.when(F.col(c) != F.lower(F.col(c)), 1).otherwise(0)
    aggs = [
        (F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("unique_ids"),
        F.sum(F.when(empty_cell > 0, 1).otherwise(0)).alias("no_empties"),
        F.sum(lower_bad).alias("lowercase_labels"),
        F.abs(F.count(F.lit(1)) - (expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows))).alias("row_count"),
    ]
    for name, kv, c, expected in spot:
        aggs.append(F.sum(F.when((F.col(key) == F.lit(kv)) & ~F.col(c).eqNullSafe(F.lit(expected)), 1).otherwise(0)).alias(name))
    one = df.agg(*aggs)
    names = ["unique_ids", "no_empties", "lowercase_labels", "row_count"] + [s[0] for s in spot]
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("violations")) for n in names]))
    return one.select(stack.alias("r")).select("r.rule", F.coalesce("r.violations", F.lit(0)).alias("violations")).withColumn(
        "passed", F.col("violations") == 0)


def diff_versions(a: DataFrame, b: DataFrame) -> DataFrame:
    """TXT12 / SET3: rows removed from ``a`` and added in ``b`` (multiset difference)."""
    removed = a.exceptAll(b).agg(F.count(F.lit(1)).alias("n")).select(F.lit("removed").alias("change"), "n")
    added = b.exceptAll(a).agg(F.count(F.lit(1)).alias("n")).select(F.lit("added").alias("change"), "n")
    return removed.unionByName(added)


def content_hash(df: DataFrame) -> Column:
    """Order-free content hash of a table: sum of 64-bit row hashes."""
    return F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)"))


def commit_version(df: DataFrame, root: str, tag: str, mode: str = "errorifexists") -> DataFrame:
    """TXT12: write ``df`` as version ``tag`` under ``root`` and return its
    manifest row ``(version, rows, content_hash)``; existing versions are kept
    (``mode='errorifexists'``) so two versions can be switched between."""
    path = f"{root.rstrip('/')}/version={tag}"
    df.write.mode(mode).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.lit(tag).alias("version"), F.count(F.lit(1)).alias("rows"), content_hash(back).alias("content_hash"))


def upsert(existing: DataFrame, new: DataFrame, key: str = "point_id") -> DataFrame:
    """SNK10: keep existing points whose key is not re-sent, add the new ones
    (write the result to a new version; ``recreate`` is simply ``new``)."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def read_version(spark, root: str, tag: str) -> DataFrame:
    """TXT12: switch to a stored version by tag (versions are never
    overwritten, so switching back and forth is a read)."""
    return spark.read.parquet(f"{root.rstrip('/')}/version={tag}")
