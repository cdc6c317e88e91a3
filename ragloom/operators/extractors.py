"""One file to many rows by Python table functions (UDF6, TXT13)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

ROW = "part int, field string, value string, error string"

Extractor = Callable[[bytes], Iterator[tuple[str, str]]]


def text_lines(content: bytes) -> Iterator[tuple[str, str]]:
    """Non-blank lines of a UTF-8 text, without surrounding blanks."""
    for line in content.decode("utf-8").split("\n"):
        if line.strip():
            yield "line", line.strip()


def json_records(content: bytes) -> Iterator[tuple[str, str]]:
    """Fields of a JSON list of objects."""
    for record in json.loads(content):
        for field, value in record.items():
            yield field, value if isinstance(value, str) else json.dumps(value)


EXTRACTORS: dict[str, Extractor] = {"txt": text_lines, "md": text_lines, "json": json_records}


@udtf(returnType=ROW)
class ExtractRows:
    """UDF6: rows ``(part, field, value, error)`` of one file by the extractor
    of its type. A failure is a row with an error, after the rows that came
    before it; so is a type without an extractor. Null content is an empty
    file, which has no rows."""

    def eval(self, kind: str, content: bytes):
        part = 0
        try:
            for field, value in EXTRACTORS[kind](bytes(content or b"")) if content else ():
                yield part, field, value, None
                part += 1
        except KeyError:
            yield part, None, None, f"no extractor for {kind}"
        except Exception as e:  # noqa: BLE001 - any failure of an extractor is a row
            yield part, None, None, type(e).__name__


def extract_rows(spark: SparkSession, files: DataFrame, kind: str = "kind", content: str = "content") -> DataFrame:
    """TXT13 / UDF6: every file's rows beside its own columns but ``content``, by
    a lateral join; ``files`` may be a stream of arriving files."""
    spark.udtf.register("extract_rows", ExtractRows)
    keep = [c for c in files.columns if c != content]
    sent = files.select(*keep, F.col(kind).alias("_kind"), F.col(content).alias("_content"))
    rows = sent.lateralJoin(ExtractRows(F.col("_kind").outer(), F.col("_content").outer()))
    return rows.select(*keep, "part", "field", "value", "error")
