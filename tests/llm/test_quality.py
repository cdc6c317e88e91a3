import numpy as np
from pyspark.sql import functions as F

from ragloom.llm import quality, queries

from .helpers import DOC_ROWS, documents, empty_documents, prose

SF = "/root/testdata/sf0.1"


def test_query_on_held_out_rows(spark):
    rows = queries.op10_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    low = [p for p, y, _ in held if y == 0]
    high = [p for p, y, _ in held if y == 1]
    assert sum(low) <= 0.15 * len(low) and sum(high) >= 0.98 * len(high)
    # calibrated: among confident rows about as many are right as the score says
    sure = [(s, y) for _, y, s in held if s > 0.5]
    assert abs(np.mean([s for s, _ in sure]) - np.mean([y for _, y in sure])) < 0.05


def labelled(spark, n=200):
    rows = [(i, prose(40, i).upper() + "!!" if i % 2 else prose(40, i), i % 2) for i in range(n)] + [(None, None, 1), (900, "x", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int")


def test_edge_rows(spark):
    net = quality.fit(labelled(spark), "quality")
    rows = [*DOC_ROWS, (70, prose(50, 8).upper() + "!!"), (71, prose(50, 8))]
    got = quality.score(documents(spark, rows), net).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[70] > 0.7 and score[71] < 0.3 and score[3] == score[5] == score[10]
    assert quality.score(empty_documents(spark), net).collect() == []


def test_no_labels_and_one_class(spark):
    kind = "doc_id bigint, text string, quality int"
    assert quality.fit(spark.createDataFrame([], kind), "quality").predict(["a", None]).tolist() == [0.5, 0.5]
    net = quality.fit(labelled(spark).where(F.col("quality") == 1), "quality")
    assert net.predict(["a b c"])[0] > 0.9


def test_vectors_come_from_neighbours():
    settings = quality.QualitySettings(size=64)
    v = quality.unit_vectors(["red car drives", "red bus drives", "blue sky shines"] * 3, settings)
    unit = lambda w: quality.units([w])[0][0]
    assert v[unit("car")] @ v[unit("bus")] > 0.9 > 0.8 > v[unit("car")] @ v[unit("sky")]


def test_query_sums_the_vectors_of_all_documents(spark, tmp_path, monkeypatch):
    texts = [f"{a} {b} end" for a in ("red", "blue") for b in ("car", "bus", "sky")] + ["unlabelled words stand here", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    used = []
    score = quality.score
    monkeypatch.setattr(quality, "score", lambda docs, network, *a, **kw: used.append(network) or score(docs, network, *a, **kw))
    queries.op10_quality(spark, str(tmp_path)).collect()
    assert np.array_equal(used[0].vectors, quality.unit_vectors(texts, quality.QualitySettings()))
    assert np.abs(used[0].vectors[quality.units(["words"])[0][0]]).sum() > 0
