import random
import re
from collections import Counter

import numpy as np
import pytest

from ragloom.llm import minhash_dedup as M
from ragloom.llm import queries
from ragloom.llm import shingles as S

from .helpers import DOC_ROWS, documents, empty_documents, prose

SF = "/root/testdata/sf0.01"
WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def bag(text):
    w = WORD.findall(text.lower())
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def plain(rows, least=0.8):
    """Class of each id, all pairs tried that share a shingle."""
    rows = [(d, t) for d, t in rows if d is not None]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    texts = {}
    for d, t in rows:
        if t is not None:
            link(texts.setdefault(t, d), d)
    bags = {t: bag(t) for t in texts}
    where = {}
    for t, b in bags.items():
        for s in b:
            where.setdefault(s, []).append(t)
    for t, b in bags.items():
        for o in {o for s in b for o in where[s] if o < t}:
            low = sum((b & bags[o]).values())
            if low / (sum(b.values()) + sum(bags[o].values()) - low) >= least:
                link(texts[t], texts[o])
    return {d: root(d) for d, _ in rows}


def classes(df):
    return {r.doc_id: r.class_id for r in M.near_duplicates(df).collect() if r.doc_id is not None}


def test_registers_agree_as_often_as_weighted_jaccard():
    rng = random.Random(1)
    for keep in (0.5, 0.8, 0.95):
        off = []
        for _ in range(40):
            a = [str(rng.randrange(60)) for _ in range(200)]  # weights above one
            b = [x if rng.random() < keep else f"z{rng.randrange(40)}" for x in a]
            v, c, o = S.counted(*S.word_hashes([" ".join(a), " ".join(b)]))
            r = M.signatures(v, c, o, 240)
            low = sum((Counter(a) & Counter(b)).values())
            off.append((r[0] == r[1]).mean() - low / (400 - low))
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.05


def test_signature_does_not_depend_on_company():
    texts = [prose(n, n) for n in (1, 3, 6, 12, 70, 600, 3000)]
    v, c, o = M.multisets(texts)
    whole = M.signatures(v, c, o, 64)
    for i, t in enumerate(texts):
        assert (M.signatures(*M.multisets([t]), 64)[0] == whole[i]).all()
    assert np.isfinite(whole).all()


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op7_minhash_dedup(spark, SF).collect()
    assert {r.doc_id: r.class_id for r in rows} == plain(docs)
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_edge_rows(spark):
    assert classes(documents(spark)) == plain(DOC_ROWS)
    got = M.near_duplicates(documents(spark)).collect()
    assert [(r.class_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert M.near_duplicates(empty_documents(spark)).collect() == []
    # one id with two texts joins both texts' classes
    rows = [(1, prose(50, 1)), (2, prose(50, 2)), (3, prose(50, 1)), (3, prose(50, 2))]
    assert classes(documents(spark, rows)) == {1: 1, 2: 1, 3: 1}


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("spread", [1, 6, 12])
def test_large_groups_around_the_threshold(spark, spread):
    """Copies of one text with few to many edits, chains of edits, and texts
    that only share half of their words: no link between classes is lost."""
    rng = random.Random(spread)
    base, half = prose(150, 5).split(), prose(60, 6)
    rows = [(i, edited(base, rng.randint(0, spread), rng)) for i in range(120)]
    chain = base
    for i in range(40):
        chain = edited(chain, 2, rng).split()
        rows.append((500 + i, " ".join(chain)))
    rows += [(1000 + i, half + " " + prose(50, 1000 + i)) for i in range(60)]
    rng.shuffle(rows)
    assert classes(documents(spark, rows)) == plain(rows)
