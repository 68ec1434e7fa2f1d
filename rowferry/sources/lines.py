"""Text lines, one raw JSON record each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.formats.parse import evaluate_once
from rowferry.functions.records import name

# Fixed value: all characters that count as white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def clean_lines(df: DataFrame, column: str = "raw_json") -> DataFrame:
    """Trim white space of any kind off the line and drop it when nothing is left.

    A line whose ends are printable ASCII, as nearly all are, is left as it is.
    """
    first, last = F.ascii(F.left(name(column), F.lit(1))), F.ascii(F.right(name(column), F.lit(1)))
    plain = first.between(33, 126) & last.between(33, 126)
    trimmed = F.when(plain, name(column)).otherwise(F.trim(name(column), F.lit(WHITE_SPACE)))
    made = evaluate_once(df, "_line", trimmed).where(F.col("_line") != "")
    return made.select(*[F.col("_line").alias(c) if c == column else name(c) for c in df.columns])


def read_lines(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """``raw_json STRING`` from a folder of text files, compressed ones included."""
    reader = spark.readStream if stream else spark.read
    lines = reader.options(**options).text(path).withColumnRenamed("value", "raw_json")
    return clean_lines(lines.select("raw_json"))
