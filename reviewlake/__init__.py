"""reviewlake: landed web-crawl files to clean hotel-review data, on Spark.

Sub-packages:

- ``functions``  column expressions (keys, dates, ratings, HTML text, language)
- ``sources``    readers for sitemaps, robots text, pages, hotel documents,
                 review objects and progress markers
- ``sinks``      writers for hotel documents, split reviews, roll-ups, run logs
- ``operators``  table-level operators (shards, documents, roll-up, extraction,
                 pagination, run log)
- ``plans``      composed batch jobs and the fixture views over driver tables
- ``streaming``  the incremental split job (Structured Streaming)
"""

__version__ = "0.1.0"
