"""Page snapshots: reading (SRC1) and decoding (SRC2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """Stored pages as ``(page_id, url, html)``.

    ``parquet``, ``orc`` and ``json`` hold the table itself; ``text`` and ``binaryFile``
    are folders of one file per page, keyed by a hash of the file's path.
    """
    reader = spark.readStream if stream else spark.read
    if fmt in ("parquet", "orc", "json"):
        return reader.schema(PAGE_SCHEMA).format(fmt).load(path)
    if fmt == "text":
        raw = reader.format("text").option("wholetext", "true").load(path).select(
            F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    elif fmt == "binaryFile":
        raw = decode_pages(reader.format("binaryFile").load(path).select(
            F.col("path").alias("url"), "content"), "content").drop("decoded_as", "content")
        raw = raw.withColumnRenamed("text", "html")
    else:
        raise ValueError(f"unknown page format {fmt!r}")
    return raw.select(F.xxhash64("url").alias("page_id"), "url", "html")


def _single_byte(raw: Column, codec: str) -> Column:
    """Decode a single-byte code page on the JVM: Latin-1, then a character map."""
    high = bytes(range(128, 256))
    latin = high.decode("latin-1")
    mapped = high.decode(codec, errors="replace")
    return F.translate(F.decode(raw, "ISO-8859-1"), latin, mapped)


def decode_pages(df: DataFrame, bytes_col: str, declared_col: str | None = None) -> DataFrame:
    """Bytes to text: declared charset, then cp1251, then UTF-8, then UTF-8 with
    replacement characters. ``decoded_as`` tells which attempt worked.

    An unknown declared charset is skipped; strict decoding fails on bytes the
    code page does not define (0x98 in cp1251).
    """
    raw = F.col(bytes_col)
    as_utf8 = raw.cast("string")
    utf8_ok = F.is_valid_utf8(as_utf8)
    cyrillic = _single_byte(raw, "cp1251")
    cyrillic_ok = ~F.contains(cyrillic, F.lit("�"))
    attempts = [("cp1251", cyrillic_ok, cyrillic), ("utf-8", utf8_ok, as_utf8)]
    if declared_col:
        name = F.lower(F.trim(F.col(declared_col)))
        attempts = [
            ("declared", name.isin("utf-8", "utf8") & utf8_ok, as_utf8),
            ("declared", name.isin("windows-1251", "cp1251") & cyrillic_ok, cyrillic),
            ("declared", name.isin("iso-8859-1", "latin-1", "latin1"), F.decode(raw, "ISO-8859-1")),
            ("declared", name.isin("us-ascii", "ascii") & ~F.hex(raw).rlike("^(?:..)*[89A-F]."),
             F.decode(raw, "ISO-8859-1")),
        ] + attempts
    text, label = F.make_valid_utf8(as_utf8), F.lit("utf-8-replace")
    for used, ok, value in reversed(attempts):
        ok = F.coalesce(ok, F.lit(False))
        text = F.when(ok, value).otherwise(text)
        label = F.when(ok, F.lit(used)).otherwise(label)
    return df.withColumn("text", text).withColumn("decoded_as", label)
