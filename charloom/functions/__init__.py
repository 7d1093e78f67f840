from charloom.functions.text import (  # noqa: F401
    NEWLINES,
    clean_line,
    decode_ignore,
    drop_last_char,
    grader_view,
    is_blank,
    last_char,
    nfc,
    scoring_suffix,
)
