"""Column functions (all JVM-side expressions, no Python UDFs)."""

from indicata.functions.text import (  # noqa: F401
    cell_text_legacy,
    cell_text_xlsx,
    empty_to_null,
    file_name,
    file_stem,
    float_text,
    fold_name,
    iso_utc,
    json_number_text,
    null_to_empty,
    url_last_segment,
    url_template,
)
from indicata.functions.numeric import (  # noqa: F401
    backoff_seconds,
    safe_rate,
    status_class,
)
