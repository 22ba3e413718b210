"""Zip archives of reports.

Each archive is one row; ``mapInPandas`` opens it with the standard library and
gives one row at a time, name and bytes of a member, nothing more. What a member
is follows from its name, by Column expressions (:func:`member_names`): report
members are extracted as ``{stem}{year}.{ext}``, a nested ``.zip`` is expanded in
a further pass with the outer archive's year, everything else is a status. The
year is the last four characters of the outermost archive's stem. An archive or
member that cannot be read is a row with an error; the others go on.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_extension, file_stem
from ..session import stage

# Extensions of report members.
REPORT_EXTENSIONS = ("TXT", "txt")
MSG_NO_YEAR = "error: could not extract year from zip file name"
_READ = tuple(f".{e}" for e in (*REPORT_EXTENSIONS, "zip"))


def _members(batches):
    for pdf in batches:
        for root, archive, content in zip(pdf["root"], pdf["archive"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    for info in z.infolist():
                        data, error = None, None
                        if info.filename.endswith(_READ):
                            try:
                                data = z.read(info)
                            except Exception as e:  # a damaged member is a row
                                error = f"error: {e}"
                        yield _row(root, archive, info.filename, error, data)
            except Exception as e:  # so is a damaged archive
                yield _row(root, archive, None, f"error: {e}", None)


def _row(*values) -> pd.DataFrame:
    return pd.DataFrame([values], columns=["root", "archive", "member", "error", "content"])


def expand_archives(archives: DataFrame) -> DataFrame:
    """Rows ``(path, content)`` of zip archives -> ``archive, member, year,
    out_name, status, content``, one row per member (see module rules)."""
    out, level = None, archives.select(F.col("path").alias("root"), F.col("path").alias("archive"), "content")
    while True:
        got = level.mapInPandas(_members, "root string, archive string, member string, error string, content binary")
        got = stage(got.select("*", *member_names(F.col("root"), F.col("member"))), "members")
        nested = got.where("status = 'nested' and error is null")
        rows = got.where("status <> 'nested' or error is not null or status is null").select(
            "archive", "member", "year", "out_name",
            F.coalesce("error", F.when(F.col("status") == "error", F.lit(MSG_NO_YEAR)), "status").alias("status"),
            F.when(F.col("status") == "extracted", F.col("content")).alias("content"),
        )
        out = rows if out is None else out.unionByName(rows)
        if nested.isEmpty():
            return out
        level = nested.select("root", F.concat("archive", F.lit("!"), "member").alias("archive"), "content")


def member_names(archive: Column, member: Column) -> list:
    """The name rules as Column expressions: ``year, out_name, status`` for an
    ``(archive, member)`` pair."""
    year = F.right(file_stem(archive), F.lit(4))
    year = F.when(year.rlike("^[0-9]{4}$"), year.cast("int"))
    mstem, mext = file_stem(member), file_extension(member)
    parts = F.split(F.replace(member, F.lit("\\"), F.lit("/")), "/")
    unsafe = member.startswith("/") | member.startswith("\\") | F.array_contains(parts, "..") | parts[0].contains(":")
    status = (
        F.when(year.isNull(), F.lit("error"))
        .when(member.endswith("/"), F.lit("directory"))
        .when(unsafe, F.lit("unsafe"))
        .when(mext.isNull() | (mstem == ""), F.lit("skipped"))
        .when(mext == "zip", F.lit("nested"))
        .when(mext.isin(*REPORT_EXTENSIONS), F.lit("extracted"))
        .otherwise(F.lit("skipped"))
    )
    out_name = F.when(status == "extracted", F.concat(mstem, year.cast("string"), F.lit("."), mext))
    return [year.alias("year"), out_name.alias("out_name"), status.alias("status")]
