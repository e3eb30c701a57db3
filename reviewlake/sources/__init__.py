"""Readers of landed files (S1-S7). They return DataFrames; nothing is collected."""

from reviewlake.sources.readers import (  # noqa: F401
    parse_robots, parse_sitemaps, read_hotel_documents, read_markers, read_pages,
    read_review_objects, read_robots, read_sitemaps, url_at, url_counts,
)
