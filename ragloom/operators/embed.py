"""RET9 / UDF4: batch text embedding.

``hashed_embedding`` is the offline default: a hashed bag of ``[a-z0-9]+``
tokens, L2-normalised, computed with built-in columns only (token bucket =
first two hex digits of ``md5(token)``, reproducible in any SQL engine).
``embed`` runs any model over Arrow batches with ``mapInPandas``; the model is
built once per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .retrieval import tokenize

HASH_DIM = 256


def token_bucket(term) -> F.Column:
    return F.conv(F.substring(F.md5(term), 1, 2), 16, 10).cast("int")


def hashed_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Sparse form ``(id, bucket, weight)`` with unit L2 norm per id."""
    t = df.select(F.col(id_col).alias("id"), F.explode(tokenize(F.col(text_col))).alias("term"))
    counts = t.groupBy("id", token_bucket(F.col("term")).alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))
    norms = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("cnt") * F.col("cnt"))).alias("nrm"))
    return counts.join(norms, "id").select("id", "bucket", (F.col("cnt") / F.col("nrm")).alias("weight"))


def hashed_embedding(df: DataFrame, id_col: str, text_col: str, dim: int = HASH_DIM) -> DataFrame:
    """RET9: dense ``(id, embedding array<double>)`` of length ``dim`` (=256) in one
    pass over Arrow batches (no shuffle): tokens, md5 bucket per distinct term
    (memoised per task), counts, L2 normalisation. Rows without tokens are
    dropped. Equal to the sparse form of :func:`hashed_terms`."""
    import hashlib
    import re

    if dim != HASH_DIM:
        raise ValueError("the bucket rule (two hex digits of md5) fixes dim = 256")
    token_re = re.compile(r"[a-z0-9]+")
    id_type = df.schema[id_col].dataType.simpleString()

    def fn(batches):
        memo: dict[str, int] = {}
        for pdf in batches:
            ids, vecs = [], []
            for i, t in zip(pdf[id_col].tolist(), pdf[text_col].tolist()):
                toks = token_re.findall((t or "").lower())
                if not toks:
                    continue
                v = np.zeros(dim)
                for tok in toks:
                    bkt = memo.get(tok)
                    if bkt is None:
                        bkt = int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:2], 16)
                        memo[tok] = bkt
                    v[bkt] += 1.0
                ids.append(i)
                vecs.append(v / np.sqrt((v * v).sum()))
            yield pd.DataFrame({id_col: ids, "embedding": vecs})

    from .common import ensure_parallel

    return ensure_parallel(df.select(id_col, text_col)).mapInPandas(fn, f"{id_col} {id_type}, embedding array<double>")


def embed(df: DataFrame, text_col: str, model_factory: Callable[[], Callable[[list[str]], np.ndarray]],
          id_col: str = "id", batch: int = 256, prefix: str = "", normalize: bool = True) -> DataFrame:
    """UDF4: pluggable embedder: ``model_factory()`` returns ``texts -> (n, d)``
    matrix. Batches of ``batch`` texts, optional query prefix (FUN18), float32
    output, L2-normalised; input order inside a partition is kept."""
    id_type = df.schema[id_col].dataType.simpleString()

    def fn(it):
        model = model_factory()
        for pdf in it:
            texts = [prefix + (t or "") for t in pdf[text_col].tolist()]
            out = []
            for i in range(0, len(texts), batch):
                m = np.asarray(model(texts[i:i + batch]), dtype=np.float32)
                if normalize:
                    n = np.linalg.norm(m, axis=1, keepdims=True)
                    n[n == 0] = 1.0
                    m = m / n
                out.extend(list(m))
            yield pd.DataFrame({id_col: pdf[id_col], "embedding": out})

    return df.select(id_col, text_col).mapInPandas(fn, f"{id_col} {id_type}, embedding array<float>")
