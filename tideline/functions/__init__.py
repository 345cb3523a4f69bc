"""Column functions. All but two (YAML fields, unified diff) stay in the JVM."""

from tideline.functions.documents import (
    classify_path,
    document_sections,
    front_matter_fields,
    front_matter_parts,
    lines_of,
    unified_diff,
)
from tideline.functions.scalars import (
    blank_to_null,
    days_before,
    normalise_text,
    regex_extract_null,
    required,
    safe_divide,
    sentinel_to_null,
    short_message,
    starts_with_mark,
    years_before,
)

__all__ = [
    "blank_to_null",
    "classify_path",
    "days_before",
    "document_sections",
    "front_matter_fields",
    "front_matter_parts",
    "lines_of",
    "normalise_text",
    "regex_extract_null",
    "required",
    "safe_divide",
    "sentinel_to_null",
    "short_message",
    "starts_with_mark",
    "unified_diff",
    "years_before",
]
