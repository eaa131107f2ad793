"""DataFrame -> DataFrame operators."""

from .flatten import flatten, project_paths  # noqa: F401
from .funnel import first_event_dedup, funnel_counts, lead_flags  # noqa: F401
from .guards import (  # noqa: F401
    complex_to_json,
    ensure_column,
    ensure_columns,
    parse_or_null,
    safe_scalar,
    safe_struct,
)
from .joins import left_join_one_to_many, lookup, role_lookups  # noqa: F401
from .pivot import channel_pivot, union_channels  # noqa: F401
