"""Training-data operators: deduplication, extraction, filtering, packing and
formatting of document tables. Nothing outside this subpackage imports it."""
