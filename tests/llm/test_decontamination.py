import random
import re

import numpy as np

from ragloom.llm import decontamination as D
from ragloom.llm import queries

from .helpers import DOC_ROWS, LONG, documents, empty_documents, prose

SF = "/root/testdata/sf0.01"
WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def bag(words, k):
    out = {}
    for i in range(len(words) - k + 1):
        s = tuple(words[i:i + k])
        out[s] = out.get(s, 0) + 1
    return out


def plain(text, item, least=0.8):
    """Best window by trying all of them."""
    w, v = WORD.findall((text or "").lower()), WORD.findall((item or "").lower())
    k = min(5, len(v))
    if not k or len(w) < k or not set(bag(w, k)) & set(bag(v, k)):
        return None
    b, n = bag(v, k), min(len(v), len(w))
    best = None
    for i in range(len(w) - n + 1):
        a = bag(w[i:i + n], k)
        low = sum(min(c, b.get(s, 0)) for s, c in a.items())
        sim = low / (sum(a.values()) + sum(b.values()) - low)
        if sim >= least and (best is None or sim > best[0]):
            best = (sim, i, i + n)
    return best


def check(rows, docs, items):
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.item_id), []).append((r.similarity, r.word_start, r.word_end))
    want = {}
    for d, t in docs:
        for i, x in items:
            if (m := plain(t, x)) is not None:
                want.setdefault((d, i), []).append(m)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return want


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert check(queries.op4_decontamination(spark, SF).collect(), docs, items)


ITEMS = [(1, prose(40, 11)), (2, prose(12, 12)), (3, "two words"), (4, ""), (5, None), (6, prose(40, 11)), (None, prose(25, 13)), (7, "one"),
         (8, "a b a b a b a b a b a b a b a b")]


def edge_docs():
    rng = random.Random(4)
    item = prose(40, 11).split()
    docs = list(DOC_ROWS)
    for e in range(7):  # edits, cut and grown passages around the threshold
        changed = list(item)
        for _ in range(e):
            changed[rng.randrange(len(changed))] = "zz%d" % rng.randrange(99)
        docs.append((100 + e, prose(30, e) + " " + " ".join(changed) + ", " + prose(10, e)))
        docs.append((200 + e, " ".join(item[e:])))
        docs.append((300 + e, " ".join(item[:20] + ["new"] * e + item[20:]).upper()))
    docs += [(400, prose(25, 13)), (401, LONG + " " + prose(12, 12) + " " + LONG), (402, "b a " * 60), (403, "x " + " ".join(item) + " y " + " ".join(item))]
    return docs


def test_edge_rows_equal_brute_force(spark):
    items = spark.createDataFrame([(*i, 1, "q") for i in ITEMS], "item_id bigint, text string, doc_id int, _text string")
    docs = edge_docs()
    got = D.matches(documents(spark, docs), items).collect()
    want = check(got, docs, ITEMS)
    assert len({s for v in want.values() for s, _, _ in v}) > 3
    # items in several blocks give the same rows
    more = D.matches(documents(spark, docs), items, block_chars=200).collect()
    assert sorted(map(str, more)) == sorted(map(str, got))
    left = {r.doc_id for r in D.clean(documents(spark, docs), items).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_empty(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.matches(empty_documents(spark), items).collect() == []
    assert D.matches(documents(spark), none).collect() == []
    assert D.clean(documents(spark), none).count() == len(DOC_ROWS)


def test_blocks_find_everything_within_the_radius():
    rng = np.random.default_rng(2)
    match = D.Match()
    index = D.ItemIndex(list(range(300)), [prose(30, s) for s in range(300)], match)
    key = next(iter(index.hamming))
    own, prints, _ = index.hamming[key]
    probes = np.unpackbits(prints[rng.integers(0, 300, 400)], axis=1)
    for row in probes:  # flip up to radius + 4 bits
        row[rng.choice(256, rng.integers(0, match.radius + 5), replace=False)] ^= 1
    probes = np.packbits(probes, axis=1)
    w, j, far = index._near(probes, key, own)
    exact = (np.unpackbits(probes, axis=1)[:, None, :] != np.unpackbits(prints, axis=1)[None, :, :]).sum(axis=2)
    assert set(zip(w.tolist(), j.tolist(), far.tolist(), strict=True)) == {(a, b, exact[a, b]) for a, b in zip(*np.nonzero(exact <= match.radius), strict=True)}


def test_the_tables_prune_unrelated_fingerprints():
    """The share of unrelated pairs that the blocks let through to the distance."""
    index = D.ItemIndex(list(range(400)), [prose(30, s) for s in range(400)], D.Match())
    key = max(index.hamming, key=lambda k: len(index.hamming[k][0]))
    probes = np.random.default_rng(5).integers(0, 256, (2000, 32), dtype=np.uint8)
    index._near(probes, key, index.hamming[key][0])
    assert index.passed <= 0.003 * index.asked


def test_repetitive_text_beside_a_passage(spark):
    """A repeated shingle weighs by its square in the fingerprint, not in the
    similarity: such windows are not held to the radius."""
    item = prose(504, 21)
    text = " ".join(item.split()[:449]) + " again" * 55
    items = spark.createDataFrame([(7, item)], "item_id smallint, text string")
    docs = [(1, text), (2, text + " " + prose(300, 4)), (3, prose(500, 5))]
    rows = D.matches(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    want = check(rows, docs, [(7, item)])
    assert set(want) == {(1, 7), (2, 7)} and all(r.hamming > 62 for r in rows)
    assert D.clean(spark.createDataFrame(docs, "doc_id bigint, text string"), items).count() == 1
