from collections import defaultdict

import pytest

from ragloom.llm import chat_format, queries

from .test_oracle import duck_rows

SF = "/root/testdata/sf0.01"


def plain(rows):
    """Brute force: each conversation against all others."""
    talks = defaultdict(list)
    for c, t, r, x in rows:
        talks[c].append((t, r, x))
    lists = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: (y[0] is None, y[0]))] for c, v in talks.items()}
    kept = {}
    for c, v in lists.items():
        if not any(o != c and w[:len(v)] == v and (len(w) > len(v) or (o is not None and (c is None or o < c))) for o, w in lists.items()):
            kept[c] = (len(v), sum(w == v for w in lists.values()))
    return kept


TALKS = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(6)] + \
    [(2, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(4)] + \
    [(3, i + 10, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(6)] + \
    [(4, 0, "user", "t0"), (4, 1, "assistant", "other"), (5, 0, None, None), (6, 0, "", ""), (7, None, "user", "no turn"),
     (None, 0, "user", "t0"), (8, 0, "user", "t0"), (9, 0, "user", "dup"), (9, 0, "user", "dup"), (10, 0, "user", "dup"),
     (11, 0, "user", "x <|im_end|> y"), (12, 0, "user", "long " * 30_000)]
KIND = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("block", [1, 2, 512])
def test_collapse_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(chat_format.positioned, "__defaults__", (block,))
    df = spark.createDataFrame([(*t, 1, "p", 3) for t in TALKS], KIND + ", part int, _conv string, _n int")
    got = chat_format.format_conversations(df).collect()
    assert {r.conv_id: (r.n_turns, r.copies) for r in got} == plain(TALKS)
    text = {r.conv_id: r.rendered for r in got}
    assert text[1] == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, _, r, x in TALKS[:6])
    assert text[11].count("<|im_end|>") == 1 and text[12].count("long") == 30_000


def test_parts_of_a_long_conversation(spark):
    turns = [(1, i, "user", str(i)) for i in range(23)]
    got = chat_format.format_conversations(spark.createDataFrame(turns, KIND), part_turns=5).orderBy("part").collect()
    assert [r.part for r in got] == [0, 1, 2, 3, 4] and {r.n_turns for r in got} == {23}
    assert "".join(r.rendered for r in got) == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(23))


def test_empty(spark):
    assert chat_format.format_conversations(spark.createDataFrame([], KIND)).collect() == []


def test_query_against_sql(spark):
    df = queries.op2_chat_formatting(spark, SF)
    assert sorted(map(tuple, df.select(sorted(df.columns)).collect())) == duck_rows("op2_chat_formatting", SF)
