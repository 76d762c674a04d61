"""Schemas of the records that are read; always given, never inferred."""

EXPECTATIONS = "array<struct<text:string,passed:boolean,evidence:string>>"
GRADING = (
    f"expectations {EXPECTATIONS}, summary struct<passed:bigint,failed:bigint,total:bigint,pass_rate:double>, "
    "execution_metrics struct<tool_calls:map<string,bigint>,total_tool_calls:bigint,total_steps:bigint,errors_encountered:bigint,output_chars:bigint,transcript_chars:bigint>, "
    "timing struct<executor_duration_seconds:double,grader_duration_seconds:double,total_duration_seconds:double>, "
    "claims array<struct<claim:string,type:string,verified:boolean,evidence:string>>, "
    "user_notes_summary struct<uncertainties:array<string>,needs_review:array<string>,workarounds:array<string>>, "
    "eval_feedback struct<suggestions:array<struct<assertion:string,reason:string>>,overall:string>, _corrupt_record string"
)
TIMING = "total_tokens bigint, duration_ms bigint, total_duration_seconds double, _corrupt_record string"
METADATA = "eval_id bigint, eval_name string, prompt string, assertions array<string>, _corrupt_record string"
FEEDBACK = "reviews array<struct<run_id:string,feedback:string,timestamp:string>>, status string, _corrupt_record string"
TRIGGER_SET = "query string, should_trigger boolean"
EVENT = "type string, event struct<type:string,content_block:struct<type:string,name:string>,delta:struct<type:string,partial_json:string>>, message struct<content:array<struct<type:string,name:string,input:map<string,string>>>>"
SOURCE = "id bigint, type string, handle string, platform_id string, first_tracked_at timestamp"
RESEARCH_ITEM = "id bigint, source_id bigint, original_url string, ingested_at timestamp, raw_text string, cleaned_text string, content_hash string, simhash bigint, extras map<string,string>"
MEDIA_ASSET = "id bigint, research_item_id bigint, kind string, storage_path string, original_url string, duration double, size_bytes bigint"
STRUCTURED_FIELD = "id bigint, research_item_id bigint, name string, value string, origin string, model string, prompt_version string, confidence double"
NOTE = "id bigint, research_item_id bigint, body string, author string, created_at timestamp"
