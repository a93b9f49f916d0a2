"""Column functions: safe casts and JSON-text lists."""

from .casts import CASTS, convert, was_lost
from .json_lists import LIST_FAULTS, element_rows, fill_key, list_faults, open_elements, parse_list

__all__ = [
    "CASTS", "LIST_FAULTS", "convert", "was_lost", "element_rows", "fill_key", "list_faults", "open_elements", "parse_list",
]
