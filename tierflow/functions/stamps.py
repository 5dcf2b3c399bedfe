"""Column stamps (P6–P10): constants, load time, lineage, record → JSON text."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_stamp(as_of: _dt.datetime | Column | None = None) -> Column:
    """The load time — ``as_of`` when given (reproducible runs), else query start time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of)


def to_payload(record: Column, keep_null_fields: bool = True) -> Column:
    """P10: serialise a struct as compact JSON text.

    ``keep_null_fields`` writes ``"k":null`` instead of dropping the key, so a
    key-presence contract still sees every field.
    """
    opts = {"ignoreNullFields": "false" if keep_null_fields else "true"}
    return F.to_json(record, opts)
