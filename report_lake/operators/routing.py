"""Report-type routing and file-name checks as Column expressions.

The spec registry is a small driver-side dict, folded into ``CASE`` expressions
(constant folding); no lookup table is joined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import as_col, file_extension
from ..spec import SPECS

# Messages of the type and extension checks.
MSG_BAD_TYPE = "Invalid report type: "
MSG_BAD_EXT = "Invalid file extension. Expected: {expected}, Got: "


def report_type_of(name) -> Column:
    """Case-insensitive report-type name -> canonical name, NULL when unknown."""
    key = F.lower(F.trim(as_col(name)))
    out = None
    for k in SPECS:
        out = (F.when(key == k, F.lit(k)) if out is None else out.when(key == k, F.lit(k)))
    return out


def _per_spec(rt: Column, attr) -> Column:
    out = None
    for k, spec in SPECS.items():
        v = F.lit(attr(spec))
        out = F.when(rt == k, v) if out is None else out.when(rt == k, v)
    return out


def route(name_col, type_col) -> list:
    """``report_type, prefix, extension, valid_extension, message`` for a file
    name and a requested report type."""
    rt = report_type_of(type_col)
    prefix = _per_spec(rt, lambda s: s.prefix)
    ext = _per_spec(rt, lambda s: s.extensions[0])
    name = as_col(name_col)
    valid = F.lower(name).endswith(F.lower(ext))
    got = F.coalesce(file_extension(name), F.lit("none"))
    message = (
        F.when(rt.isNull(), F.concat(F.lit(MSG_BAD_TYPE), as_col(type_col)))
        .when(~valid, F.concat(F.lit(MSG_BAD_EXT.split("{")[0]), ext, F.lit(MSG_BAD_EXT.split("}")[1]), got))
    )
    return [
        rt.alias("report_type"),
        prefix.alias("prefix"),
        ext.alias("extension"),
        F.coalesce(valid, F.lit(False)).alias("valid_extension"),
        message.alias("message"),
    ]


# Separators of the two error-message forms.
RECOVERABLE_SEP = " - "
PARSE_SEP = ": "


def error_text(context, details, recoverable) -> Column:
    """Error message of a file status: ``context - details`` for a recoverable
    (field/file format) error, ``context: details`` otherwise."""
    rec = recoverable if isinstance(recoverable, Column) else F.lit(bool(recoverable))
    c, d = as_col(context), as_col(details)
    return F.when(rec, F.concat_ws(RECOVERABLE_SEP, c, d)).otherwise(F.concat_ws(PARSE_SEP, c, d))
