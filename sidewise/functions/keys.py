"""Storage keys, batch ids and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .measures import as_col

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
SCHEMA_VERSION = "1.0"
CLIENT_VERSION = "2.0.0"


def _segments(**parts: Column | str) -> Column:
    pieces = [F.concat(F.lit(f"{name}="), as_col(value).cast("string")) for name, value in parts.items()]
    return F.concat_ws("/", *pieces)


def partition_key(tournament: Column | str, season: Column | str, day: Column | str) -> Column:
    return _segments(tournament_id=tournament, season_id=season, date=day)


def event_partition_key(
    tournament: Column | str, season: Column | str, day: Column | str, event: Column | str
) -> Column:
    """The finer variant, one more level for the event id."""
    return _segments(tournament_id=tournament, season_id=season, date=day, match_id=event)


def object_key(data_type: str, partition: Column, batch: Column | str) -> Column:
    return F.concat(F.lit(f"{data_type}/"), partition, F.lit("/batch_"), as_col(batch), F.lit(".ndjson"))


def bronze_path(data_type: str, partition: Column, batch: Column | str) -> Column:
    return F.concat(F.lit("bronze/"), object_key(data_type, partition, batch))


def params_json(**params: Column | str) -> Column:
    """Request parameters as JSON text with sorted names, numbers bare."""
    pieces = [
        F.concat(F.lit(f'"{name}": '), as_col(params[name]).cast("string")) for name in sorted(params)
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}"))


def batch_id(endpoint: Column | str, params: Column) -> Column:
    """Deterministic id: the first 16 hex digits of SHA-256 over endpoint and parameters."""
    return F.substring(F.sha2(F.concat(as_col(endpoint), F.lit(":"), params), 256), 1, 16)


def incremental_batch_id(tournament: Column | str, season: Column | str, day: Column | str) -> Column:
    return F.concat_ws(
        "_", F.lit("incremental"), *[as_col(c).cast("string") for c in (tournament, season, day)]
    )


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
