import hashlib
import random
import re

from ragloom.llm import queries, secret_scan as S

from .helpers import DOC_ROWS, documents, empty_documents

SF = "/root/testdata/sf0.01"
PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def plain(text):
    spans = [(m.start(), k, n, m.end()) for k, (n, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m)]
    return [(s, e, n) for s, _, n, e in sorted(spans)]


def check(rows, texts):
    assert len(rows) == len(texts)
    want = {}
    for d, t in texts:
        base = plain(t)
        want.setdefault(d, []).append((hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, e, n in base).encode()).hexdigest(),
                                       *(sum(x[2] == k for x in base) for k in ("assign", "access", "hex"))))
    for r in rows:
        assert (r.base_sha256, r.n_assign, r.n_access, r.n_hex) in want[r.doc_id]


TRICKY = [
    "token=token:abcdefgh", "PassWord : 'abc123'", "api_key==x/y+z=1", 'secret"="short"', "AKIA" + "A" * 15, "xAKIA" + "B" * 16 + "c",
    "AKIAAKIA" + "Z" * 12, "f" * 23, "g" + "0a" * 12 + "G", "ſecret=abcdef", "toKen=abcdef", "passwd=\nabcdef", "apikey: " + "e" * 30,
    "🙂🙂 password=hunter22 é token = deadbeefdeadbeefdeadbeef", "secret=ab token=abcdef", "token token=secret=abcdef",
]


def test_base_spans_follow_the_contract():
    rng = random.Random(5)
    parts = ["token", "SECRET", "=", ":", " ", '"', "'", "ab", "abcdef0", "AKIA", "Z9", "0" * 10, "\n", "passwd", "api_key", "é", "-", "."]
    for t in TRICKY + ["".join(rng.choice(parts) for _ in range(40)) for _ in range(2000)]:
        assert S.base_spans(t) == plain(t), t


def test_query_and_edge_rows(spark):
    check(queries.op5_secret_scan(spark, SF).collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    rows = DOC_ROWS + [(100 + i, t) for i, t in enumerate(TRICKY)]
    check(S.scan(documents(spark, rows)).collect(), rows)
    assert S.scan(empty_documents(spark)).collect() == []


def test_novelty_reports_random_strings_in_sensitive_context_only():
    rng = random.Random(3)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
    found = lambda t: [t[s:e] for s, e, k in S.all_spans(t, S.NoveltyRule())[1] if k == "novel"]
    assert found(f"Authorization header uses bearer {key} today") == [key]
    assert found(f"the value {key} stands alone") == []
    assert found("bearer configuration_connection_string_default") == []
    assert found(f"x = {key}\nprivate key {key}") == []  # known from the surrounding code
    base, every = S.all_spans(f"token={key} bearer {key[::-1]}", S.NoveltyRule())
    assert set(base) <= set(every) and [k for _, _, k in every] == ["assign", "novel"]


def test_redaction(spark):
    text = "a password=abcdef1 b " + "0a" * 20 + " c"
    assert S.redact(text, S.base_spans(text)) == "a [SECRET] b [SECRET] c"
    assert S.redact("x", []) == "x" and S.redact(None, []) is None
    df = documents(spark, [(1, text), (2, None), (3, "clean"), (None, "")])
    out = S.redact_documents(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a [SECRET] b [SECRET] c", 2: None, 3: "clean", None: ""}


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_the_whole_of_a_wrapped_key_is_found():
    rng = random.Random(7)
    lines = ["".join(rng.choice(BASE64) for _ in range(n)) for n in [64] * 24 + [20]]
    for kind in ("RSA PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY"):
        for brk in ("\n", "\r\n", "\\n", "\n    ", '\\n"\n  "'):
            for head in ("", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,3F17F5316E2BAC89\n\n"):
                text = f"key:{brk}-----BEGIN {kind}-----{brk}{head}{brk.join(lines)}{brk}-----END {kind}-----{brk}thanks for reading"
                left = S.redact(text, S.all_spans(text, S.NoveltyRule())[1])
                assert not any(line in left for line in lines), (kind, brk, head)
                assert f"-----END {kind}-----{brk}thanks for reading" in left
    text = "bearer " + "\n".join(lines[:3]) + "\nthanks\nfor reading"
    assert S.redact(text, S.all_spans(text, S.NoveltyRule())[1]) == "bearer [SECRET]\nthanks\nfor reading"
    text = "secret=" + "\n".join(lines)
    assert S.redact(text, S.all_spans(text, S.NoveltyRule())[1]) == "[SECRET]\n[SECRET]"


def test_long_random_strings_of_small_alphabets_are_found():
    rng = random.Random(8)
    for letters in ("0123456789ABCDEF", "GHIJKLMN", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", BASE64):
        for n in (32, 64, 96, 128, 512, 2000):
            found = 0
            for _ in range(50):
                key = "".join(rng.choice(letters) for _ in range(n))
                found += S.all_spans(f"it uses bearer {key} today", S.NoveltyRule())[1] == [(15, 15 + n, "novel")]
            assert found >= 49, (letters, n, found)
    for plain_run in ("=" * 80, "=-" * 50, "GHIJKLMNOP" * 10):
        assert S.all_spans(f"bearer {plain_run}", S.NoveltyRule())[1] == [], plain_run
