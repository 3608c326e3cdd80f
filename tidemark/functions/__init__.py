from tidemark.functions.text import fit_width, too_wide, utf16_length
from tidemark.functions.values import convert, required, to_boolean, to_integer, to_text

__all__ = [
    "convert",
    "fit_width",
    "required",
    "to_boolean",
    "to_integer",
    "to_text",
    "too_wide",
    "utf16_length",
]
