"""Row-level and set-level operators over DataFrames."""
