"""Registered document queries over ``pages``, ``documents``, ``conversations``,
``orders``, ``nation``/``region`` and ``labels``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import documents as D
from ..session import scratch_path
from ..sources.tables import table
from .registry import register

# ---------------------------------------------------------------------------
# TXT3 HTML main text
# ---------------------------------------------------------------------------


def _sql_html_text(col: str) -> str:
    t = col
    for tag in D.DROPPED_TAGS:
        t = f"regexp_replace({t}, '(?is)<{tag}\\b.*?</{tag}\\s*>', chr(1), 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', chr(1), 'g')"
    t = f"regexp_replace({t}, '(?s)<!doctype[^>]*>|<!DOCTYPE[^>]*>', chr(1), 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]*>', chr(1), 'g')"
    for ent, rep in D.ENTITIES:
        t = f"replace({t}, '{ent}', '{rep.replace(chr(39), chr(39) * 2)}')"
    return (f"array_to_string(list_filter(list_transform(string_split({t}, chr(1)), "
            f"lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) > 0), chr(10))")


SQL_HTML = f"""
SELECT page_id, length(html) AS raw_size, length(text) AS text_size,
       round(CASE WHEN length(html) > 0 THEN length(text) / length(html) ELSE 0.0 END, 4) AS useful_ratio, text
FROM (SELECT page_id, html, {_sql_html_text('html')} AS text FROM pages)
"""


@register("html_main_text", sql=SQL_HTML, ops="TXT3")
def html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    p = D.html_main_text(table(spark, sf, "pages"))
    return p.select("page_id", F.col("raw_size").cast("bigint"), F.col("text_size").cast("bigint"),
                    F.round("useful_ratio", 4).alias("useful_ratio"), "text")


# ---------------------------------------------------------------------------
# TXT2 / TXT4 / AGG23: raw files from pages (stand-in bytes)
# ---------------------------------------------------------------------------


def raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in files: the UTF-8 bytes of every page as ``.html``; beside them
    a copy declared ``.pdf`` of each third page, and an empty file for each
    seventh."""
    p = table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    named = lambda d, mark, suffix: d.select(
        "page_id", F.concat(F.lit(mark), F.col("page_id").cast("string"), F.lit(suffix)).alias("path"), "content")
    wrong = named(p.filter(F.col("page_id") % 3 == 0), "copy_", ".pdf")
    empty = named(p.filter(F.col("page_id") % 7 == 0).withColumn("content", F.lit(b"").cast("binary")), "empty_", ".html")
    return named(p, "page_", ".html").unionByName(wrong).unionByName(empty)


SQL_FILES = """
files AS (
  SELECT page_id, 'page_' || page_id || '.html' AS path, html AS body FROM pages
  UNION ALL SELECT page_id, 'copy_' || page_id || '.pdf', html FROM pages WHERE page_id % 3 = 0
  UNION ALL SELECT page_id, 'empty_' || page_id || '.html', '' FROM pages WHERE page_id % 7 = 0),
typed AS (
  SELECT page_id, path, body, lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS declared_type,
         CASE WHEN length(body) = 0 THEN NULL
              WHEN starts_with(body, '%PDF') THEN 'pdf'
              WHEN instr(lower(left(body, 512)), '<html') > 0 OR instr(lower(left(body, 512)), '<!doctype') > 0 THEN 'html'
         END AS detected_type
  FROM files),
typed2 AS (
  SELECT *, CASE WHEN length(body) = 0 THEN true ELSE coalesce(detected_type <> declared_type, false) END AS is_mismatch
  FROM typed),
typed3 AS (
  SELECT *, CASE WHEN length(body) = 0 THEN 'empty file'
                 WHEN is_mismatch THEN 'declared .' || declared_type || ' but detected ' || detected_type END AS issue
  FROM typed2)
"""


@register("type_mismatch", sql=f"""WITH {SQL_FILES}
SELECT page_id, path, declared_type, detected_type, is_mismatch, issue FROM typed3""", ops="TXT2 FUN7")
def type_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    t = D.file_types(raw_files(spark, sf))
    return t.select("page_id", "path", "declared_type", "detected_type", "is_mismatch", "issue")


SQL_PARSE = f"""WITH {SQL_FILES},
parsed AS (
  SELECT page_id, path, declared_type, is_mismatch, issue, length(body) = 0 AS empty,
         CASE WHEN length(body) > 0 AND NOT is_mismatch AND declared_type IN ('html', 'htm')
              THEN {_sql_html_text('body')} END AS txt
  FROM typed3)
SELECT page_id, path,
       CASE WHEN empty OR is_mismatch OR txt IS NULL THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN empty THEN 'empty' WHEN is_mismatch THEN 'type_mismatch' WHEN txt IS NULL THEN 'corrupted' END AS error_type,
       CASE WHEN empty THEN 'file is empty' WHEN is_mismatch THEN issue
            WHEN txt IS NULL THEN 'no extractor produced text for .' || declared_type END AS error_message,
       CASE WHEN NOT (empty OR is_mismatch OR txt IS NULL) THEN length(txt) END AS char_count
FROM parsed
"""


@register("parse_status", sql=SQL_PARSE, ops="TXT4 UDF6 D16")
def parse_status(spark: SparkSession, sf: str) -> DataFrame:
    p = D.parse_files(raw_files(spark, sf))
    return p.select("page_id", "path", "status", "error_type", "error_message", F.col("char_count").cast("bigint"))


@register("parse_summary", sql=f"""WITH q AS ({SQL_PARSE})
SELECT status, error_type, count(*) AS n FROM q GROUP BY ALL""", ops="AGG23")
def parse_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG23: files by status and error type."""
    return parse_status(spark, sf).groupBy("status", "error_type").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# TXT5 table records: nations of each region laid out as a table
# ---------------------------------------------------------------------------


def nation_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in cells: one table per region, header row then nations by key."""
    n = table(spark, sf, "nation")
    rows = n.select(F.col("n_regionkey").cast("bigint").alias("table_no"),
                    F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("row_no"),
                    F.col("n_nationkey").cast("string").alias("c0"), F.col("n_name").alias("c1"))
    header = n.select(F.col("n_regionkey").cast("bigint").alias("table_no")).distinct().select(
        "table_no", F.lit(0).alias("row_no"), F.lit("key").alias("c0"), F.lit("name").alias("c1"))
    both = rows.unionByName(header)
    return both.select(F.lit("nations.html").alias("file"), "table_no", "row_no",
                       F.explode(F.array(F.struct(F.lit(0).alias("col_no"), F.col("c0").alias("text")),
                                         F.struct(F.lit(1).alias("col_no"), F.col("c1").alias("text")))).alias("c")
                       ).select("file", "table_no", "row_no", "c.col_no", "c.text")


@register("html_table_records", sql="""
WITH r AS (SELECT n_regionkey AS table_no, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS row_no,
                  CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation)
SELECT CAST(table_no AS BIGINT) AS table_no, CAST(row_no AS INTEGER) AS row_no, 'key' AS field, key AS value FROM r
UNION ALL
SELECT CAST(table_no AS BIGINT), CAST(row_no AS INTEGER), 'name', name FROM r
""", ops="TXT5 D17")
def html_table_records(spark: SparkSession, sf: str) -> DataFrame:
    rec = D.records_from_cells(nation_cells(spark, sf))
    return rec.select("table_no", F.col("row_no").cast("int"), F.explode("record").alias("field", "value"))


# ---------------------------------------------------------------------------
# TXT10 / AGG19 chunking over documents
# ---------------------------------------------------------------------------

CHUNK_SIZE, CHUNK_OVERLAP = 512, 50
SWEEP_SIZES = (256, 512, 1024, 2048)
SWEEP_OVERLAPS = (0, 50, 100, 200)


@register("fixed_chunks", sql=f"""
WITH d AS (SELECT doc_id, text, length(text) AS n,
                  CASE WHEN length(text) <= {CHUNK_SIZE} THEN 1
                       ELSE CAST(ceil((length(text) - {CHUNK_SIZE}) / {CHUNK_SIZE - CHUNK_OVERLAP}) AS INTEGER) + 1 END AS cnt
           FROM documents),
c AS (SELECT doc_id, text, CAST(unnest(range(cnt)) AS INTEGER) AS chunk_index FROM d)
SELECT doc_id, chunk_index, CAST(chunk_index * {CHUNK_SIZE - CHUNK_OVERLAP} + 1 AS INTEGER) AS start,
       length(substring(text, chunk_index * {CHUNK_SIZE - CHUNK_OVERLAP} + 1, {CHUNK_SIZE})) AS n_chars,
       md5(substring(text, chunk_index * {CHUNK_SIZE - CHUNK_OVERLAP} + 1, {CHUNK_SIZE})) AS chunk_md5
FROM c
""", ops="TXT10")
def fixed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = D.fixed_chunks(table(spark, sf, "documents"), CHUNK_SIZE, CHUNK_OVERLAP)
    return c.select("doc_id", "chunk_index", "start", F.length("chunk").cast("bigint").alias("n_chars"),
                    F.md5("chunk").alias("chunk_md5"))


_GRID = ", ".join(f"({s}, {o})" for s in SWEEP_SIZES for o in SWEEP_OVERLAPS)


@register("chunk_sweep", sql=f"""
WITH g AS (SELECT * FROM (VALUES {_GRID}) t(size, overlap)),
d AS (SELECT length(text) AS n FROM documents),
x AS (SELECT size, overlap, n,
             CASE WHEN n <= size THEN 1 ELSE CAST(ceil((n - size) / (size - overlap)) AS BIGINT) + 1 END AS cnt
      FROM d, g),
y AS (SELECT size, overlap, CAST(sum(cnt) AS BIGINT) AS chunks,
             sum((cnt - 1) * size + (n - (cnt - 1) * (size - overlap))) AS len FROM x GROUP BY size, overlap)
SELECT size, overlap, chunks, round(len / chunks, 4) AS mean_length,
       chunks - first_value(chunks) OVER (PARTITION BY size ORDER BY overlap) AS extra_chunks
FROM y
""", ops="AGG19 WIN5")
def chunk_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return D.chunk_sweep(table(spark, sf, "documents"), SWEEP_SIZES, SWEEP_OVERLAPS)


@register("recursive_chunks", ops="TXT10 UDF5")
def recursive_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Recursive character chunks (512 / 50) of every document; rows-only check
    (Python splitting), properties in tests/test_documents.py."""
    c = D.recursive_chunks(table(spark, sf, "documents"), CHUNK_SIZE, CHUNK_OVERLAP)
    return c.select("doc_id", "chunk_index", "length", F.md5("chunk").alias("chunk_md5"))


@register("chunk_index_stats", ops="TXT11 FUN4")
def chunk_index_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk index build (500/50 word-token chunks, section, hashed embedding,
    stable ids) and its statistics per source; rows-only check."""
    idx = D.build_chunk_index(table(spark, sf, "documents"), 500, 50)
    return idx.groupBy("source").agg(
        F.count(F.lit(1)).alias("chunks"), F.avg("token_count").cast("bigint").alias("avg_tokens"),
        F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens"),
        F.count("section").alias("with_section"), F.count_distinct("point_id").alias("distinct_ids"))


# ---------------------------------------------------------------------------
# TXT6 captions from conversations, TXT8 repair counts
# ---------------------------------------------------------------------------


def caption_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in caption files: per turn a cue (time line, previous text line,
    the text with <c> tags around alternate words, blank line); every cue is
    written twice to mimic rolling captions."""
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    txt = F.regexp_replace(F.col("text"), "\n", " ")
    c = c.select("conv_id", "turn", txt.alias("t"), F.coalesce(F.lag(txt).over(w), F.col("role")).alias("prev"))
    sec = lambda x: F.lpad((x % 60).cast("string"), 2, "0")
    time_line = F.concat(F.lit("00:00:"), sec(F.col("turn")), F.lit(".000 --> 00:00:"), sec(F.col("turn") + 1), F.lit(".000"))
    tagged = F.array_join(F.transform(F.split(F.col("t"), " "),
                                      lambda x, i: F.when(i % 2 == 1, F.concat(F.lit("<c>"), x, F.lit("</c>"))).otherwise(x)), " ")
    lines = F.array(time_line, F.col("prev"), tagged, F.lit(""))
    c = c.select("conv_id", "turn", F.posexplode(F.concat(lines, lines)).alias("j", "line"))
    return c.select(F.col("conv_id").alias("file"), (F.col("turn") * 8 + F.col("j")).alias("line_no"), "line")


def _sql_caption_clean(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    t = f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
    for ent, rep in D.CAPTION_ENTITIES:
        t = f"replace({t}, '{ent}', '{rep.replace(chr(39), chr(39) * 2)}')"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"


SQL_CAPTIONS = f"""
c0 AS (
  SELECT conv_id, turn, replace(text, chr(10), ' ') AS t,
         coalesce(lag(replace(text, chr(10), ' ')) OVER (PARTITION BY conv_id ORDER BY turn), role) AS prev
  FROM conversations),
c1 AS (
  SELECT conv_id, turn,
         ['00:00:' || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') || '.000 --> 00:00:' || lpad(CAST((turn + 1) % 60 AS VARCHAR), 2, '0') || '.000',
          prev,
          array_to_string(list_transform(string_split(t, ' '), lambda x, i: CASE WHEN (i - 1) % 2 = 1 THEN '<c>' || x || '</c>' ELSE x END), ' '),
          ''] AS l
  FROM c0),
lines AS (
  SELECT conv_id AS file, turn * 8 + j - 1 AS line_no, line
  FROM (SELECT conv_id, turn, unnest(l || l) AS line, unnest(range(1, 9)) AS j FROM c1)),
lk AS (
  SELECT *, regexp_matches(line, '^\\d{{2}}:\\d{{2}}:\\d{{2}}\\.\\d{{3}}\\s*-->') AS is_time,
         regexp_matches(line, '^\\s*$') AND NOT regexp_matches(line, '^\\d{{2}}:\\d{{2}}:\\d{{2}}\\.\\d{{3}}\\s*-->') AS is_blank
  FROM lines),
seg AS (SELECT *, sum(CAST(is_time OR is_blank AS INTEGER)) OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS seg FROM lk),
starts AS (SELECT file, seg, is_time AS in_cue FROM seg WHERE is_time OR is_blank),
body AS (
  SELECT s.file, s.seg, s.line_no, {_sql_caption_clean('s.line')} AS clean
  FROM seg s JOIN starts USING (file, seg) WHERE NOT s.is_time AND NOT s.is_blank AND starts.in_cue),
cues AS (SELECT file, seg, arg_max(clean, line_no) AS clean FROM body WHERE length(clean) > 0 GROUP BY file, seg),
dd AS (SELECT *, lag(clean) OVER (PARTITION BY file ORDER BY seg) AS prev FROM cues),
kept AS (SELECT * FROM dd WHERE prev IS NULL OR prev <> clean),
joined AS (SELECT file, string_agg(clean, ' ' ORDER BY seg) AS t FROM kept GROUP BY file),
captions AS (
  SELECT file, regexp_replace(regexp_replace(regexp_replace(t, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'),
                              '([.!?])\\s+', '\\1' || chr(10), 'g') AS text FROM joined)
"""


@register("clean_captions", sql=f"WITH {SQL_CAPTIONS} SELECT file, text, length(text) AS n_chars FROM captions",
          ops="TXT6 WIN3 FUN2 FUN3")
def clean_captions(spark: SparkSession, sf: str) -> DataFrame:
    return D.clean_captions(caption_lines(spark, sf))


@register("caption_corpus", sql=f"""WITH {SQL_CAPTIONS}
SELECT count(*) AS files, CAST(sum(length(text)) + 2 * (count(*) - 1) AS BIGINT) AS total_chars FROM captions""",
          ops="TXT7")
def caption_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus put together (texts in file order with a blank line between
    them), written as text and measured there."""
    c = D.clean_captions(caption_lines(spark, sf))
    path = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    D.caption_corpus(c).write.text(path)
    lines = spark.read.text(path)
    files = c.agg(F.count(F.lit(1)).alias("files"))
    chars = lines.agg((F.sum(F.length("value") + 1) - 2).cast("bigint").alias("total_chars"))
    return files.join(chars, F.lit(True))  # one row each


# Fixed rule tables (our own words, chosen to fire on the stand-in text).
NOISE = ["[music]", "[applause]"]
EXACT = {"th": "the", "ha": "has", "ed": "Ed"}
VARIANTS = {"Thorne": ["thnt", "thorn", "thornt"]}
PROPER = ["der", "die", "que", "und"]


def _asr_sql() -> str:
    def q(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    steps = ["s0 AS (SELECT file, text AS t FROM captions)"]
    names: list[str] = []
    k = 0

    def add(body: str) -> None:
        nonlocal k
        steps.append(f"s{k + 1} AS ({body} FROM s{k})")
        k += 1

    for m in NOISE:
        name = f"noise:{m}"
        names.append(name)
        add(f"SELECT * REPLACE (replace(t, {q(m)}, '') AS t), "
            f"CAST((length(t) - length(replace(t, {q(m)}, ''))) / {len(m)} AS BIGINT) AS \"{name}\"")
    add("SELECT * REPLACE (regexp_replace(regexp_replace(t, '  +', ' ', 'g'), chr(10) || ' +', chr(10), 'g') AS t)")
    add("SELECT *, regexp_extract_all(t, '([\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+)', 1) AS p")

    def word(name: str, old: str, new_expr: str, cond: str = "true") -> None:
        names.append(name)
        hit = f"x = {q(old)} AND ({cond})"
        add(f"SELECT * REPLACE (list_transform(p, lambda x, i: CASE WHEN {hit} THEN {new_expr} ELSE x END) AS p), "
            f"CAST(len(list_filter(p, lambda x, i: {hit})) AS BIGINT) AS \"{name}\"")

    for bad, good in EXACT.items():
        word(f"exact:{bad}->{good}", bad, q(good))
    for canon, vs in VARIANTS.items():
        for v in vs:
            word(f"variant:{v}->{canon}", v, q(canon))
    stripped = "rtrim(p[i - 1], ' ' || chr(9))"
    cond = (f"i > 1 AND CASE WHEN length({stripped}) > 0 THEN right({stripped}, 1) NOT IN ('.', '!', '?', chr(10)) "
            f"ELSE i > 2 END")
    for w in PROPER:
        word(f"cap:{w}->{w[:1].upper() + w[1:]}", w, "upper(left(x, 1)) || substring(x, 2)", cond)
    cols = ", ".join(f'"{n}"' for n in names)
    return f"""WITH {SQL_CAPTIONS}, {", ".join(steps)},
long AS (SELECT rule, n FROM (SELECT {cols} FROM s{k}) UNPIVOT (n FOR rule IN ({cols}))),
per_rule AS (SELECT rule, CAST(sum(n) AS BIGINT) AS n FROM long GROUP BY rule HAVING sum(n) > 0)
SELECT rule, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM per_rule ORDER BY n DESC, rule LIMIT 30"""


@register("asr_repair_counts", sql=_asr_sql(), ops="TXT8 AGG17 SRT2")
def asr_repair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary repair of the cleaned captions; per-rule counts, top 30 by
    count (SRT2), with the total over all rules."""
    caps = D.clean_captions(caption_lines(spark, sf))
    _, counts = D.repair(caps, NOISE, EXACT, VARIANTS, PROPER, text="text", id_col="file")
    counts = counts.withColumn("n", F.col("n").cast("bigint"))
    total = counts.select(F.sum("n")).scalar()
    return counts.orderBy(F.col("n").desc(), F.col("rule")).limit(30).withColumn("total", total.cast("bigint"))


# ---------------------------------------------------------------------------
# TXT9 / FIL14 / TXT12 on orders with injected dirt
# ---------------------------------------------------------------------------

CORRECTED_PRIORITY = "3-medium"


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in dirty dataset v1 from ``orders``: rows with key % 10 = 0 appear
    twice (the copy later and with another price), null priority where
    key % 17 = 0, upper-case status where key % 5 = 0 (already upper in the
    data, lower-cased by the cleaning)."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, F.upper("o_orderstatus")).otherwise(F.col("o_orderstatus")))
    base = o.withColumn("pos", F.col("o_orderkey") * 2)
    rep = o.filter(F.col("o_orderkey") % 10 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1.0).withColumn(
        "pos", F.col("o_orderkey") * 2 + 1)
    return base.unionByName(rep)


def corrections(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter(F.col("o_orderkey") % 1000 == 1)
    return o.select("o_orderkey", F.lit("o_orderpriority").alias("column"), F.lit(CORRECTED_PRIORITY).alias("value"))


def clean_v2(spark: SparkSession, sf: str) -> DataFrame:
    d = D.clean_dataset(dirty_orders(spark, sf), "o_orderkey", "pos", ["o_orderstatus", "o_orderpriority"],
                        corrections(spark, sf))
    return d.drop("pos")


SQL_DIRTY = """
o AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 5 = 0 THEN upper(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders),
v1 AS (
  SELECT *, o_orderkey * 2 AS pos FROM o
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, o_orderdate, o_orderpriority, o_orderkey * 2 + 1
  FROM o WHERE o_orderkey % 10 = 0),
first AS (SELECT * FROM v1 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY pos) = 1),
v2 AS (
  SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 1000 = 1 THEN '""" + CORRECTED_PRIORITY + """' ELSE lower(o_orderpriority) END AS o_orderpriority
  FROM first
  WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL
    AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL)
"""


@register("dataset_clean_v2", sql=f"WITH {SQL_DIRTY} SELECT * FROM v2", ops="TXT9 D20")
def dataset_clean_v2(spark: SparkSession, sf: str) -> DataFrame:
    return clean_v2(spark, sf)


@register("quality_rules", sql=f"""WITH {SQL_DIRTY},
exp AS (SELECT count(DISTINCT o_orderkey) AS n FROM first WHERE o_orderpriority IS NOT NULL),
agg AS (
  SELECT count(*) - count(DISTINCT o_orderkey) AS unique_ids,
         sum(CASE WHEN o_orderpriority IS NULL OR o_orderpriority = '' OR o_orderstatus = '' THEN 1 ELSE 0 END) AS no_empties,
         sum(CASE WHEN o_orderstatus <> lower(o_orderstatus) THEN 1 ELSE 0 END)
           + sum(CASE WHEN o_orderpriority <> lower(o_orderpriority) THEN 1 ELSE 0 END) AS lowercase_labels,
         abs(count(*) - (SELECT n FROM exp)) AS row_count,
         sum(CASE WHEN o_orderkey % 1000 = 1 AND o_orderpriority IS DISTINCT FROM '{CORRECTED_PRIORITY}' THEN 1 ELSE 0 END) AS corrections_applied
  FROM v2)
SELECT rule, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
FROM agg UNPIVOT (violations FOR rule IN (unique_ids, no_empties, lowercase_labels, row_count, corrections_applied))
""", ops="FIL14")
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    v2 = clean_v2(spark, sf)
    d = dirty_orders(spark, sf)
    first = d.withColumn("_rn", F.row_number().over(Window.partitionBy("o_orderkey").orderBy("pos"))).filter("_rn = 1")
    expected = first.filter(F.col("o_orderpriority").isNotNull()).select(F.count_distinct("o_orderkey")).scalar()
    spot = []
    # every corrected key must carry the corrected value
    keys = v2.filter(F.col("o_orderkey") % 1000 == 1)
    q = D.quality_rules(v2, "o_orderkey", ["o_orderstatus", "o_orderpriority"], expected, spot)
    bad = keys.select(F.sum(F.when(~F.col("o_orderpriority").eqNullSafe(F.lit(CORRECTED_PRIORITY)), 1).otherwise(0)).cast("bigint")
                      .alias("violations")).select(F.lit("corrections_applied").alias("rule"),
                                                   F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))
    bad = bad.withColumn("passed", F.col("violations") == 0)
    return q.unionByName(bad)


@register("version_diff", sql=f"""WITH {SQL_DIRTY},
a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM v1),
b AS (SELECT * FROM v2)
SELECT 'removed' AS change, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'added', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
""", ops="TXT12 SET3")
def version_diff(spark: SparkSession, sf: str) -> DataFrame:
    return D.diff_versions(dirty_orders(spark, sf).drop("pos"), clean_v2(spark, sf))


# ---------------------------------------------------------------------------
# JON7 referential check
# ---------------------------------------------------------------------------


@register("qrels_integrity", sql="""
WITH miss AS (SELECT l.doc_id FROM labels l ANTI JOIN documents d ON d.doc_id = l.doc_id)
SELECT (SELECT count(*) FROM labels) AS n_labels, (SELECT count(*) FROM miss) AS n_missing,
       coalesce((SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)
                 FROM (SELECT doc_id FROM miss ORDER BY doc_id LIMIT 3)), '') AS sample
""", ops="JON7 SET3")
def qrels_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """JON7 / SET3: labels whose document is missing, with three samples."""
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents")
    miss = labels.join(docs, "doc_id", "left_anti")
    sample = miss.select("doc_id").orderBy("doc_id").limit(3).agg(
        F.coalesce(F.array_join(F.sort_array(F.collect_list(F.col("doc_id").cast("string"))), ","), F.lit("")))
    return labels.agg(F.count(F.lit(1)).alias("n_labels")).select(
        "n_labels", miss.select(F.count(F.lit(1))).scalar().alias("n_missing"), sample.scalar().alias("sample"))
