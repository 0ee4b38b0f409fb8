"""Fixed values of the corpus format.

Results depend on these exact names and numbers, so they are listed plainly.
"""

# Columns that hold a transcript. Every one that is present must be non-empty.
TEXT_COLUMNS = ["text", "transcript", "sentence", "normalized_text", "target_text"]

# Smallest accepted value of each duration column.
DURATION_MINIMUMS = {
    "duration": 0.03,
    "audio_duration": 0.03,
    "duration_s": 0.03,
    "duration_ms": 30.0,
}

# Smallest accepted value of each frame or sample count column.
FRAME_MINIMUMS = {
    "num_frames": 1.0,
    "n_frames": 1.0,
    "input_frames": 1.0,
    "num_samples": 400.0,
    "n_samples": 400.0,
    "audio_num_samples": 400.0,
}

# Struct columns that carry audio as (bytes, path).
AUDIO_COLUMNS = ["audio", "speech"]

# In-file language columns; the partition key replaces them.
LANGUAGE_COLUMNS = ["language", "lang"]

# Short language code to script-qualified label.
SCRIPT_LABELS = {"sna": "sna_Latn", "lug": "lug_Latn", "lin": "lin_Latn"}

# (source role, source split, destination split) when two corpora are combined.
TWO_CORPUS_SPLITS = [
    ("first", "train", "train"),
    ("first", "dev", "train"),
    ("first", "test", "train"),
    ("second", "train", "train"),
    ("second", "test", "train"),
    ("second", "validation", "validation"),
]

# Source splits that stay apart as validation when many roots are combined.
VALIDATION_SPLITS = ["validation", "valid", "dev"]

# Validation split names by falling priority, and the default.
VALID_SPLIT_PRIORITY = ["dev", "validation", "valid"]
DEFAULT_VALID_SPLIT = "dev"

# Splits a raw shard may be named after.
SHARD_SPLITS = ["train", "test", "validation"]

SAMPLE_RATE = 16000
MAX_AUDIO_SECONDS = 40.0
MIN_AUDIO_SAMPLES = 32_000
MAX_AUDIO_SAMPLES = {"ctc": 960_000, "llm": 320_000}
SAMPLING_BETA = 0.5
BATCH_SIZE = 4
CHUNK_SIZE = 256

# Counters of one composition manifest row.
MANIFEST_COUNTERS = [
    "parquet_files",
    "rows_before",
    "rows_after",
    "dropped_rows",
    "dropped_files",
    "normalized_audio_paths",
]

# Training-log fields.
LOG_STEP = "Step"
LOG_LOSS = "CTC Loss"
LOG_WER = "Word Error Rate (WER)"
LOG_UER = "Unit Error Rate (UER)"
LOG_LR = "Learning Rate"

# Where a checkpoint directory keeps its model weights.
CHECKPOINT_WEIGHTS = "model/pp_00/tp_00/sdp_00.pt"
