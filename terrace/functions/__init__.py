"""Column functions: pure Spark expressions, safe under ANSI mode."""

from terrace.functions.keys import foreign_key, surrogate_key
from terrace.functions.status import RESULT_STATUS_CODES, map_status
from terrace.functions.text import nfkd_strip, normalize_text, slug
from terrace.functions.times import (
    parse_duration,
    parse_race_time_ms,
    race_timestamp,
    record_text,
)

__all__ = [
    "RESULT_STATUS_CODES",
    "foreign_key",
    "map_status",
    "nfkd_strip",
    "normalize_text",
    "parse_duration",
    "parse_race_time_ms",
    "race_timestamp",
    "record_text",
    "slug",
    "surrogate_key",
]
