"""Row layouts. Readers use these; nothing is ever inferred from the data."""

RAW_PAGE = "url STRING, status INT, headers MAP<STRING,STRING>, html STRING, error STRING"
PARSED_PAGE = "url STRING, segments ARRAY<STRUCT<text: STRING, language: STRING>>, parsed_urls ARRAY<STRING>"
SEGMENT = "round INT, language STRING, text STRING"
FRONTIER = "pos BIGINT, url STRING"
SEEN = "url STRING"
ROBOTS_DOC = "origin STRING, status INT, content_type STRING, content STRING, fetched_at TIMESTAMP"
INDEX_ROW = "url STRING, url_host_registered_domain STRING, content_languages STRING"
LANGUAGE_ROW = "language STRING, iso6393 STRING, iso15924 STRING"
COVERAGE_ROW = "domain STRING, language STRING, count_google BIGINT, count_commoncrawl BIGINT"
DATASET_ROW = "text STRING, language STRING, script STRING"
