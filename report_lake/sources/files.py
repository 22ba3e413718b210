"""Report file sources: listing, splittable line reads, UTF-8 gate, line relation.

Report files are read by Spark's text source with ``\\n`` as the only line
break, so a large file is read in splits by many tasks and no task ever holds a
whole file. A split's start (``file_block_start``) orders the blocks of a file,
and the row number inside the scanning task orders the lines of a block; the
line relation is written once with both before anything else reads it.
"""

from __future__ import annotations

from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import as_col, plain_path


def any_of(globs: Iterable[str]) -> Optional[str]:
    """One path glob for several name globs; None for "every name"."""
    globs = list(globs)
    if "*" in globs:
        return None
    return globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"


def _reader(spark: SparkSession, fmt: str, glob: Optional[str], recursive: bool):
    reader = spark.read.format(fmt).option("recursiveFileLookup", str(recursive).lower())
    return reader.option("pathGlobFilter", glob) if glob else reader


def list_files(spark: SparkSession, paths, glob: Optional[str] = None, recursive: bool = False) -> DataFrame:
    """Listing of the files below one or more folders (or of the files given):
    ``path, modificationTime, length``. The bodies are not read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _reader(spark, "binaryFile", glob, recursive).load(paths).select("path", "modificationTime", "length")


def read_whole(spark: SparkSession, paths, globs: Iterable[str] = ("*",), recursive: bool = False) -> DataFrame:
    """Files as one row each, ``path, content``: for archives, whose format needs it."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _reader(spark, "binaryFile", any_of(globs), recursive).load(paths).select("path", "content")


def read_lines(spark: SparkSession, paths, globs: Iterable[str] = ("*",), recursive: bool = False, on_bad_utf8: str = "strict",
               written: Optional[tuple] = None) -> DataFrame:
    """The line relation ``(path, blk, pos, line, bad)`` of report files; with
    ``written`` of those last written in that time range (inclusive), which the
    listing decides, and without an error for files that go meanwhile.

    strict: a line that is not valid UTF-8 is marked ``bad``, which fails its
    file; replace: invalid sequences become U+FFFD. A trailing ``\\r`` stays on
    the line and goes with normalisation (a lone ``\\r`` is no line break).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _reader(spark, "text", any_of(globs), recursive).option("lineSep", "\n")
    raw = reader.option("ignoreMissingFiles", str(written is not None).lower()).load(paths)
    if written is not None:
        at = F.col("_metadata.file_modification_time")
        raw = raw.where((at >= F.lit(written[0])) & (at <= F.lit(written[1])))
    line, bad = checked_text(F.col("value"), on_bad_utf8)
    return raw.select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("blk"),
        (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("pos"),
        line.alias("line"),
        bad.alias("bad"),
    )


def checked_text(text, mode: str = "strict"):
    """(text, bad) for a string column that may hold invalid UTF-8."""
    if mode == "replace":
        return F.make_valid_utf8(text), F.lit(False)
    if mode != "strict":
        raise ValueError("mode must be 'strict' or 'replace'")
    return text, ~F.is_valid_utf8(text)


def utf8_gate(content, mode: str = "strict"):
    """(text, bad) for a binary ``content`` column; strict: bad text is NULL."""
    text, bad = checked_text(as_col(content).cast("string"), mode)
    return F.when(~bad, text), bad


def text_lines(df: DataFrame, path_col, text_col) -> DataFrame:
    """Split a text column into the line relation ``(path, pos, line)`` on ``\\n``.

    A trailing ``\\r`` stays on the line and is removed by normalisation, so
    CRLF and LF files give the same lines (a lone ``\\r`` is not a line break).
    """
    return df.select(
        as_col(path_col).alias("path"),
        F.posexplode(F.split(as_col(text_col), "\n", -1)).alias("pos", "line"),
    ).withColumn("pos", F.col("pos").cast("long"))


def content_lines(files: DataFrame, on_bad_utf8: str = "strict") -> DataFrame:
    """The line relation of reports that come as rows ``(path, content)``
    (archive members, fetched bodies)."""
    text, bad = checked_text(F.col("content").cast("string"), on_bad_utf8)
    rows = files.where(F.col("content").isNotNull()).select("path", text.alias("text"), bad.alias("bad"))
    rows = rows.select("path", "bad", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return rows.select("path", F.col("pos").cast("long").alias("pos"), "line", "bad")


def _file_writer(folder_uri: str):
    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder_uri)
        fs.create_dir(root, recursive=True)
        for pdf in batches:
            names, sizes = [], []
            for name, content in zip(pdf["name"], pdf["content"]):
                data = bytes(content)
                with fs.open_output_stream(f"{root}/{name}") as f:
                    f.write(data)
                names.append(name)
                sizes.append(len(data))
            yield pd.DataFrame({"name": names, "bytes": sizes})

    return run


def write_named_files(files: DataFrame, folder: str) -> DataFrame:
    """Write rows ``(name, content)`` as files ``folder/name`` from the tasks that
    hold them (pyarrow file system of the folder's URI). Returns ``name, bytes``
    lazily; run an action to write."""
    from ..session import to_local_or_uri

    return files.select("name", "content").mapInPandas(_file_writer(to_local_or_uri(folder)), "name string, bytes long")
