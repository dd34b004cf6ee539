"""Column → Column functions (names, identifiers, semantic shortening)."""

from berth.functions.text import (  # noqa: F401
    ascii_fold,
    nfc,
    norm_key,
    safe_name,
    snake,
    sql_identifier,
)
from berth.functions.stems import (  # noqa: F401
    extension,
    landing_name,
    parse_stem,
    stem,
    strip_timestamp,
    strip_version,
    ts_to_int,
    with_parsed_stem,
)
from berth.functions.shorten import (  # noqa: F401
    collapse_dup_prefix, semantic_name, with_semantic_name, with_semantic_name_distinct)
