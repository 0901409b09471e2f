"""Names, templates, limits and defaults that results depend on."""

# Reserved column names of a dataset.
TEXT = "text"
INSTRUCTION = "instruction"
INPUT = "input"
COMPLETION = "completion"
MESSAGES = "messages"
INFERENCE = "inference"

# Keys of a prompt configuration; `name` in the file becomes `dataset_config`.
CONFIG_KEYS = (
    "dataset_format",
    "instruction",
    "text_format",
    "chat_template",
    "instruction_part",
    "response_part",
)

# Text templates and instructions. The two helpful-assistant sentences differ on
# purpose: training ends with a period, the request service does not.
DEFAULT_TEXT_FORMAT = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{response}"
TRAINING_INSTRUCTION = "You are an helpful assistant."
SERVICE_INSTRUCTION = "You are an helpful assistant"

# Default splits of the two entry points.
TRAINING_SPLIT = "train"
INFERENCE_SPLIT = "eval"

# Folders of the storage layout.
DATASETS_FOLDER = "datasets"
CONFIGS_FOLDER = "extras"
COMPLETIONS_FOLDER = "completions"

# Limits.
MAX_SEQ_LENGTH = 8192
MAX_INPUT_TOKENS = 7500
TOKENIZER_LIMIT_CEILING = 1_000_000
PARAM_LENGTH_LIMIT = 250
TASK_TTL_SECONDS = 600

# Sampling defaults, as the JSON text of each value.
BATCH_SAMPLING = {
    "seed": "0",
    "temperature": "0",
    "max_tokens": "2048",
    "skip_special_tokens": "true",
}
SERVICE_SAMPLING = {
    "seed": "0",
    "temperature": "0",
    "max_tokens": "1024",
    "skip_special_tokens": "true",
}

# Task states in the order they are reached; the position breaks ties on time.
TASK_STATES = ("queued", "running", "done", "error")

# Extraction chat layout.
EXTRACTION_SYSTEM = "You are NuExtract, an information extraction tool created by NuMind."
EXTRACTION_SCHEMA = (
    '{"entities": [{"entity": "verbatim-string", "entity_type": ["RESEARCH_INFRASTRUCTURE", "FUNDER", '
    '"PRIVATE_COMPANY"], "grant_ids": ["verbatim-string"], "grant_programs": ["verbatim-string"], '
    '"other_ids": ["verbatim-string"]}]}'
)
