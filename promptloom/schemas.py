"""Schemas of the tables and streams, as DDL."""

MESSAGE = "struct<role: string, content: string>"
MESSAGES = f"array<{MESSAGE}>"

CONFIG = (
    "dataset_name string, dataset_config string, dataset_format string, instruction string, "
    "text_format string, chat_template string, instruction_part string, response_part string"
)

REQUEST = (
    "task_id string, prompts array<string>, "
    "prompts_params struct<instruction: string, text_format: string, chat_template: string>, "
    "sampling_params map<string, string>, _corrupt_record string"
)

TASK_EVENT = "task_id string, status string, event_at double, error string"

LINEAGE = (
    "name string, split string, source_type string, source string, commit_hash string, "
    "num_rows bigint, schema string"
)
