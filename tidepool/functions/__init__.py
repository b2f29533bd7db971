"""Column-level functions: log parsing, text rules, vector text forms, time helpers."""

from tidepool.functions.accesslog import (  # noqa: F401
    ACCESS_LOG_PATTERN, GROUP_NAMES, log_group, log_matches, matched_or, parse_access_log,
    parse_log, status_class, status_code, to_records, to_rows, to_status_classes, to_strict_urls,
    to_visits, url_loose, url_strict,
)
from tidepool.functions.text import (  # noqa: F401
    STOP_WORDS, content_words, hashtags, is_hashtag, is_stop_word, java_trim, split_words,
    tokenize, utf16_length,
)
from tidepool.functions.timecols import epoch_seconds, from_epoch_seconds  # noqa: F401
from tidepool.functions.vectors import parse_labeled_point, parse_vector  # noqa: F401
