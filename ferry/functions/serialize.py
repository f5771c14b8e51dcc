"""Record -> compact JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferry.functions.strict_json import DEFAULT_TIMESTAMP_FORMAT


def serialize(record: Column | str, timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT) -> Column:
    """JSON text of a struct in declared field order, null fields omitted.

    ``ignoreNullFields`` is set explicitly so a session-level default cannot
    change the bytes. Characters are written plainly (no HTML escaping), so
    ``<``, ``>``, ``&``, ``=`` and ``'`` differ in bytes but not in value
    from the reference's writer.
    """
    col = F.col(record) if isinstance(record, str) else record
    return F.to_json(col, {"ignoreNullFields": "true", "timestampFormat": timestamp_format})
