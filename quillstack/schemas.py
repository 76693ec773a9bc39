"""Row types, as DDL."""

ENTRY = (
    "rel string, dataset_key string, doc_category string, sub_category string, flood_event string, doc_type string, year string, source_format string, quality string,"
    " responsible_dept string, doc_nature string, location string, flood_magnitude string, skip_reason string, duplicate_of string, sha256 string"
)
TRIAGE = "rel string, ok boolean, content string, writing string, quality string, readable boolean, issues array<string>, summary string, error string"
TRANSCRIPTION = "rel string, bucket string, endpoint string, model string, prompt_sha string, ok boolean, text string, low_conf boolean, notes string, error string"
CHUNK = "id string, doc_id string, pos int, content string, doc_type string, keywords array<string>, questions array<string>, positions array<array<int>>, available boolean, tag_feas map<string, int>"
QUESTION = (
    "id string, text string, dataset_ids array<string>, use_kg boolean, meta_data_filter struct<method: string, logic: string, conditions: array<struct<key: string, op: string, value: string>>>,"
    " expected_keywords array<string>, category string"
)
CASE = (
    "id string, tier string, layer string, question string, datasets array<string>, use_kg boolean, meta_filter string,"
    " gold struct<numbers: array<string>, keywords: array<string>, answer: string, source_rel: array<string>>, threshold struct<min_keywords: int>"
)
STATE = "rel string, status string, dataset_key string, doc_id string, error string, seq bigint"
DOCUMENT = "id string, name string, size bigint, run string, progress double, chunk_count int, meta_fields map<string, string>"
