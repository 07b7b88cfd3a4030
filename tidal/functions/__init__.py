from tidal.functions.codec import decode_json, decode_json_report, encode_json, to_topic_rows
from tidal.functions.predicates import null_safe_contains

__all__ = ["decode_json", "decode_json_report", "encode_json", "to_topic_rows", "null_safe_contains"]
