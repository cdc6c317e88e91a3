import corpus_pipeline as P
import sentencepiece
from pyspark.sql import functions as F

from ragloom.llm import queries

from .helpers import documents
from .test_decontamination import plain as leak
from .test_minhash_dedup import plain as classes
from .test_secret_scan import plain as secrets

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sp = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    seen = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        seen.append({r.doc_id: r for r in rows})
        assert len(rows) == len(seen[-1])
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    start, clean, single, free, safe, ids = seen
    gone = set(start) - set(clean)
    assert not [d for d in gone if labels.get(d) == 0] and not [d for d in clean if labels.get(d) == 1]
    root = classes([(d, r.text) for d, r in clean.items()])
    assert set(single) == {d for d, c in root.items() if d == c}
    assert set(free) == {d for d, r in single.items() if not any(leak(r.text, x) for x in items)}
    assert set(safe) == set(free) and all(r.text == clean[d].text for d, r in free.items())
    for d, r in safe.items():
        had = secrets(free[d].text)
        assert (r.text == free[d].text and r.n_chars == free[d].n_chars) if not had else ("[SECRET]" in r.text and not secrets(r.text) and r.n_chars == len(r.text))
    assert {d: r.ids for d, r in ids.items()} == {d: sp.encode(r.text, add_bos=True, add_eos=True) for d, r in safe.items()}
    assert P.run(spark, SF).count() == len(ids)


def test_minhash_stage_with_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, "a b c d e f"), (None, None), (4, ""), (5, "")]
    out = P.minhash_stage(spark, documents(spark, rows), SF)
    assert sorted((r.doc_id or -1, r.text or "-") for r in out.collect()) == [(-1, "-"), (-1, "a b c d e f"), (1, "a b c d e f"), (3, "-"), (4, "-")]
    assert out.columns == documents(spark).columns


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_minhash_stage_keeps_a_row_of_every_class_of_a_repeated_id(spark):
    one, two = "a b c d e f", "u v w x y z"
    rows = [(-3, one), (7, one), (7, two), (9, two), (12, one), (20, two), (20, None)]
    out = P.minhash_stage(spark, documents(spark, rows), SF)
    assert sorted((r.doc_id, r.text or "-") for r in out.collect()) == [(-3, one), (7, two), (20, "-")]


def test_minhash_stage_keeps_columns_of_any_name_and_the_smallest_row(spark):
    rows = [(1, "a b c d e f", "x", 3), (1, "a b c d e f", "x", 1), (2, "other words stay here too", "y", 2), (None, "n", "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string, _ROW_ int").repartition(3)
    out = P.minhash_stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(1, "a b c d e f", "x", 1), (2, "other words stay here too", "y", 2), (None, "n", "z", 5)]
