"""Table schemas and fixed values."""

from __future__ import annotations

# Data contract shared with every producer and consumer of these tables.
PLATFORM_NAMES = {"googleplay": "Google Play", "apple": "Apple App Store"}
SENTIMENTS = ["positive", "neutral", "negative", "unrated"]
RATED_SENTIMENTS = ["positive", "neutral", "negative"]
SPLITS = ["train", "val", "test"]
RUN_STATES = ["running", "success", "failed"]
REQUIRED_COLUMNS = [
    "review_id", "app_name", "user", "star_rating", "date", "review", "review_length", "sentiment",
]
OPTIONAL_COLUMNS = ["title", "word_count"]
STAR_RULE = "star_rule"
ANONYMOUS = "anonymous"
MIN_CHARS = 3
WORD_TIERS = ([0, 4, 9, 19, None], ["<5", "5-9", "10-19", "20+"])
LENGTH_BUCKETS = (
    [0, 9, 19, 49, 99, 199, 500],
    ["0-9", "10-19", "20-49", "50-99", "100-199", "200-500"],
)
USER_BUCKETS = ([0, 1, 2, 5, None], ["1", "2", "3-5", "6+"])


# Schemas are DDL strings, as reader.schema() takes them.
RAW_REVIEWS = (
    "review_id string, app_name string, user string, star_rating string, date string, "
    "review string"
)

WAREHOUSE = {
    "platforms": "id long, platform_key string, display_name string",
    "apps": "id long, app_name string, platform_fk long",
    "users": "id long, username string, platform_fk long",
    "reviews": (
        "id long, review_id string, app_fk long, user_fk long, platform_fk long, "
        "star_rating int, review_date date, review_text string, review_length int, "
        "word_count int, title string, ingestion_run long"
    ),
    "sentiment_labels": (
        "id long, review_fk long, sentiment string, label_method string, labelled_at timestamp"
    ),
    "ingestion_runs": (
        "id long, run_at timestamp, source_file string, source_checksum string, "
        "platform_key string, rows_in_file long, rows_inserted long, rows_skipped long, "
        "rows_rejected long, rows_unlabelled long, status string"
    ),
}

DATASET_SPLITS = (
    "id long, split_at timestamp, db_source string, platform_filter string, "
    "app_filter string, label_method string, cutoff_train date, cutoff_val date, "
    "train_ratio double, val_ratio double, test_ratio double, n_total long, n_train long, "
    "n_val long, n_test long, dist_train string, dist_val string, dist_test string, "
    "train_file string, val_file string, test_file string, train_md5 string, val_md5 string, "
    "test_md5 string, stratified int, random_seed int, notes string"
)

METADATA_FEATURES = [
    "review_length", "word_count", "avg_word_len", "exclamation_count", "question_count",
    "ellipsis_count", "uppercase_ratio", "star_rating", "has_title",
]
