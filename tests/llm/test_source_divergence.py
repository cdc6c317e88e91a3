import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ragloom.llm import queries
from ragloom.llm import source_divergence as D

from .helpers import EXTRA, EXTRA_ROW, LONG
from .test_oracle import duck_rows

SF = "/root/testdata/sf0.01"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs, top=50):
    """The whole definition over ``(lang, source, text)`` rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        terms = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text.translate(UPPER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        share = {}
        for s in sources:
            size = sum(counts[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (size + 5 * len(kept)) for t in kept}
        every = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (n + 5) // (sum(every.values()) + 5 * len(kept)) for t, n in every.items()}
        for s in sources:
            pairs = [(o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, share[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and share[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made_rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "von", "été", "ÉTÉ", "日本", "a", "b1c", "x_y", "don't", "ſ", "🙂", "\x00n"] + ["w%s" % c for c in "abcdefgh"]
    return [(rng.choice(["en", "en", "en", "fr", None, ""]), rng.choice(["hot", "hot", "s1", "s2", None, "zz", "ä"]),
             rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 30)))])) for _ in range(n)]


EDGE = [("one", "only", "alone here"), ("none", "a", None), ("none", "b", "1 2 3"), ("none", "c", ""), ("en", "hot", LONG), ("en", "hot", LONG), (None, None, None)]


@pytest.mark.parametrize("cells", [8, 1 << 20])
@pytest.mark.parametrize("min_docs", [1, 4])
def test_equal_to_the_definition(spark, monkeypatch, cells, min_docs):
    monkeypatch.setattr(D, "CELLS", cells)
    rows = made_rows(1, 200) + EDGE
    df = spark.createDataFrame([(*r, *EXTRA_ROW) for r in rows], "lang string, source string, text string, " + EXTRA.replace("_text", "term")).repartition(5)
    assert got(D.audit(df, min_docs)) == plain(rows, min_docs)


def test_query_against_sql_and_definition(spark):
    rows = got(queries.op11_source_divergence(spark, SF))
    by_name = [tuple(r[i] for i in (3, 0, 2, 5, 1, 4)) for r in rows]  # columns by name: item, lang, part, rank, source, value
    assert sorted(by_name) == duck_rows("op11_source_divergence", SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()
    assert rows == plain([tuple(r) for r in docs], 30)


def test_empty_table(spark):
    assert got(D.audit(spark.createDataFrame([], "lang string, source string, text string"))) == []


@pytest.mark.parametrize("held", [1, 50, 10**6])
def test_partial_tables_add_up(monkeypatch, held):
    monkeypatch.setattr(D, "TABLE_ROWS", held)
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    rows = [tuple(x or "" for x in r) for r in made_rows(2, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["lang", "source", "text"])
    sums, docs = Counter(), Counter()
    for b in D.count_terms(iter([batch.slice(0, 120), batch.slice(120), batch.slice(0, 0)])):
        for r in b.to_pylist():
            sums[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    want, want_docs = Counter(), Counter()
    for lang, source, text in rows:
        terms = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text.translate(UPPER))
        want.update((lang, source, t) for t in terms)
        want_docs.update((lang, source, t) for t in set(terms))
        want[lang, source, None] += 0
    assert sums == want and +docs == want_docs


def test_share_is_exact_for_large_counts(spark):
    values = [(0, 0, 0), (10**15, 9 * 10**15, 10**9), (9 * 10**18 // 10, 9 * 10**18 // 10, 1), (7, 10**18 + 3, 12345), (5, 5, 1)]
    df = spark.createDataFrame(values, "c bigint, n bigint, v bigint")
    for r in df.select("c", "n", "v", D._share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.c + 5) // max(r.n + 5 * r.v, 1)
