"""Names shared by every layer."""

# --- fixed values: load modes, processing states, control columns -----------
FULL = "FULL"
INCREMENTAL = "INCREMENTAL"
FULL_RESET = "FULL_RESET"
LOAD_MODES = (FULL, INCREMENTAL, FULL_RESET)

PENDING = "PENDING"
IN_PROGRESS = "IN_PROGRESS"
COMPLETED = "COMPLETED"
FAILED = "FAILED"

VALID_FROM = "_etl_valid_from"
VALID_TO = "_etl_valid_to"
IS_CURRENT = "_etl_is_current"
IS_DELETED = "_etl_is_deleted"
HASHDIFF = "_etl_hashdiff"
RUN_ID = "_etl_run_id"
SCD2_COLUMNS = (VALID_FROM, VALID_TO, IS_CURRENT, IS_DELETED, HASHDIFF, RUN_ID)

LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"
FILE_LOG_ID = "_sftp_log_id"
RAW_LINEAGE_COLUMNS = (LOADED_AT, SOURCE_FILE, FILE_LOG_ID)
# As of when a row was true, a total order over all loads: extraction time, file, row in the file.
EXTRACTED_AT, EXTRACT_FILE, SOURCE_ROW = "_etl_extracted_at", "_etl_extract_file", "_etl_source_row"
ROW_POSITION = (EXTRACTED_AT, EXTRACT_FILE, SOURCE_ROW)

# Columns that never take part in change detection.
HASH_EXCLUDED = frozenset(
    {"usr_crt", "dat_crt", "usr_mod", "dat_mod", LOADED_AT, SOURCE_FILE, FILE_LOG_ID}
)
NO_HASH = "no_hash"

# Extraction states that let a landed file through.
READY_STATES = ("completed", "ready_for_phase2")

# Tables extracted in several configurations: their files are never merged.
SEPARATE_FILE_TABLES = ("lisval",)

EXTENT_DELIMITER = ";"
# --- end of fixed values -----------------------------------------------------
