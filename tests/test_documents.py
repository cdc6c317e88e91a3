import pytest
from pyspark.sql import functions as F

from ragloom.operators import documents as D


def test_decode_files(spark):
    rows = [
        ("bom.html", b"\xef\xbb\xbf<p>Hi</p>"),
        ("cp1251.html", "Привет мир, это текст".encode("windows-1251")),
        ("latin1.txt", "Grüße aus München, schöne Straße".encode("latin-1")),
        ("utf8.txt", "plain ascii and é".encode("utf-8")),
        ("empty.txt", b""),
    ]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {r["path"]: r for r in D.decode_files(df).collect()}
    assert got["bom.html"]["had_bom"] and got["bom.html"]["text"] == "<p>Hi</p>"
    assert got["cp1251.html"]["encoding"] == "windows-1251" and got["cp1251.html"]["text"].startswith("Привет")
    assert got["latin1.txt"]["encoding"] == "ISO-8859-1" and "München" in got["latin1.txt"]["text"]
    assert got["utf8.txt"]["encoding"] == "utf-8"
    assert got["empty.txt"]["char_count"] == 0


def test_file_types_and_safe_parse(spark):
    rows = [
        ("a.html", b"%PDF-1.7 fake"),
        ("b.pdf", b"<!DOCTYPE html><html><body><p>x</p></body></html>"),
        ("c.xlsx", b"PK\x03\x04....[Content_Types].xml xl/workbook.xml"),
        ("d.pdf", b""),
        ("e.bin", b"\x00\x01\x02 no idea"),
        ("f.html", b"<html><body><p>Hello</p><script>var t='</p>';</script><p>World</p></body></html>"),
    ]
    df = spark.createDataFrame(rows, "path string, content binary")
    t = {r["path"]: r for r in D.file_types(df).collect()}
    assert t["a.html"]["detected_type"] == "pdf" and t["a.html"]["is_mismatch"]
    assert t["b.pdf"]["detected_type"] == "html" and t["b.pdf"]["issue"] == "declared .pdf but detected html"
    assert t["c.xlsx"]["detected_type"] == "xlsx" and not t["c.xlsx"]["is_mismatch"]
    assert t["d.pdf"]["is_mismatch"] and t["d.pdf"]["issue"] == "empty file"
    assert t["e.bin"]["detected_type"] is None and not t["e.bin"]["is_mismatch"]  # unknown is not a mismatch
    p = {r["path"]: r for r in D.parse_files(df).collect()}
    assert p["d.pdf"]["error_type"] == "empty"
    assert p["a.html"]["error_type"] == "type_mismatch"
    assert p["e.bin"]["error_type"] == "corrupted"
    assert p["f.html"]["status"] == "ok" and p["f.html"]["text"] == "Hello\nWorld"


def test_html_text_drops_blocks(spark):
    html = ("<html><head><title>T &amp; co</title><style>p{}</style></head><body><nav><a>menu</a></nav>"
            "<div><div><p> Main  text </p><!-- note --></div></div><footer>foot</footer><aside>ad</aside></body></html>")
    r = spark.createDataFrame([(html,)], "html string").select(D.html_text(F.col("html")).alias("t")).first()
    assert r["t"] == "T & co\nMain  text"


def _lines(spark, text):
    rows = [(1, i, ln) for i, ln in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "file int, line_no int, line string")


def test_captions_rules(spark):
    vtt = "\n".join([
        "WEBVTT", "",
        "00:00:01.000 --> 00:00:02.000", "hello", "hello <c>world</c>", "",
        "00:00:02.000 --> 00:00:03.000", "hello <c>world</c>", "",           # repeated cue -> dropped
        "00:00:03.000 --> 00:00:04.000", " ", "lost text", "",                # blank-looking line closes the cue
        "00:00:04.000 --> 00:00:05.000", "a &amp;gt; b. next  one",          # missing final blank line
    ])
    r = D.clean_captions(_lines(spark, vtt)).first()
    assert r["text"] == "hello world a &gt; b.\nnext one"


def test_caption_lines_are_read_once(spark):
    lines = _lines(spark, "00:00:01.000 --> 00:00:02.000\na").unionByName(_lines(spark, "b").select(
        F.lit(None).cast("int").alias("file"), "line_no", "line"))
    out = D.clean_captions(lines)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["file"], r["text"]) for r in out.collect()] == [(1, "a")]


def test_recursive_chunks_properties(spark):
    text = ("Para one sentence. " * 40 + "\n\n" + "Second paragraph words here. " * 30 + "\n" + "x" * 700)
    chunks = D.split_text(text, 200, 0)
    assert all(len(c) <= 200 for c in chunks)
    # with no overlap, chunks cover the text in order (whitespace aside)
    assert "".join(c.replace(" ", "").replace("\n", "") for c in chunks) == text.replace(" ", "").replace("\n", "")
    ov = D.split_text(text, 200, 50)
    assert len(ov) >= len(chunks)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert D.recursive_chunks(df, 200, 0).count() == len(chunks)


def test_fixed_chunks_cover_text(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, "")], "doc_id long, text string")
    rows = D.fixed_chunks(df, 4, 1).orderBy("doc_id", "chunk_index").collect()
    assert [r["chunk"] for r in rows if r["doc_id"] == 1] == ["abcd", "defg", "ghij"]


def test_repair_rules_and_counts(spark):
    df = spark.createDataFrame([(1, "[music] th cat.  der der der x. der end\nder go")], "id int, text string")
    fixed, counts = D.repair(df, ["[music]"], {"th": "the"}, {}, ["der"], text="text", id_col="id")
    assert fixed.first()["text"] == " the cat. der Der Der x. der end\nder go"  # first one starts a sentence
    c = {r["rule"]: r["n"] for r in counts.collect()}
    assert c == {"noise:[music]": 1, "exact:th->the": 1, "cap:der->Der": 2}


def test_clean_dataset_and_rules(spark):
    df = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (2, None, 3), (3, "C", 4)], "id int, label string, pos int")
    corr = spark.createDataFrame([(3, "label", "fixed")], "id int, column string, value string")
    out = {r["id"]: r["label"] for r in D.clean_dataset(df, "id", "pos", ["label"], corr).collect()}
    assert out == {1: "a", 3: "fixed"}
    q = {r["rule"]: r["passed"] for r in D.quality_rules(D.clean_dataset(df, "id", "pos", ["label"]), "id", ["label"], 2).collect()}
    assert all(q.values())


def test_versions_commit_diff_and_switch(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ragloom-versions-")
    v1 = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, label string")
    v2 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, label string")
    m1 = D.commit_version(v1, root, "v1").first()
    m2 = D.commit_version(v2, root, "v2").first()
    assert (m1["rows"], m2["rows"]) == (3, 2) and m1["content_hash"] != m2["content_hash"]
    assert D.read_version(spark, root, "v1").count() == 3
    diff = {r["change"]: r["n"] for r in D.diff_versions(v1, v2).collect()}
    assert diff == {"removed": 1, "added": 0}


def test_pluggable_embedder_batches_and_normalises(spark):
    import numpy as np
    from ragloom.operators.embed import embed

    def factory():
        return lambda texts: np.array([[len(t), t.count("a"), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "a" * i + "b") for i in range(1, 30)], "id int, text string")
    out = {r["id"]: r["embedding"] for r in embed(df, "text", factory, id_col="id", batch=4, prefix="q: ").collect()}
    assert len(out) == 29
    assert all(abs(sum(x * x for x in v) - 1.0) < 1e-5 for v in out.values())


def test_recursive_chunks_in_small_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "word " * 400), (2, ""), (3, None), (None, "a b c"), (5, "x" * 900)], "doc_id long, text string").coalesce(1)
    rows = lambda: sorted(D.recursive_chunks(docs, 50, 10).collect(), key=lambda r: (r[0] or 0, r[1]))
    whole = rows()
    monkeypatch.setattr(D, "CHUNK_ROWS", 3)
    assert rows() == whole and len({r["doc_id"] for r in whole}) >= 3
