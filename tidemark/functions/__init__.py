from tidemark.functions.columns import count_when, format_offsets, numeric_guard, quoted_column

__all__ = ["count_when", "format_offsets", "numeric_guard", "quoted_column"]
