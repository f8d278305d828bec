from tidemark.functions.keys import blank_to_null, hash_key, usable_key
from tidemark.functions.names import (
    delete_table_name,
    name_parts,
    strip_key_list,
    table_for_view,
)
from tidemark.functions.payload import fields_from_payload, payload_field
from tidemark.functions.scores import failure_ratio, result_status
from tidemark.functions.times import batch_id_from, batch_number, iso_text, moment

__all__ = [
    "batch_id_from",
    "batch_number",
    "blank_to_null",
    "delete_table_name",
    "failure_ratio",
    "fields_from_payload",
    "hash_key",
    "iso_text",
    "moment",
    "name_parts",
    "payload_field",
    "result_status",
    "strip_key_list",
    "table_for_view",
    "usable_key",
]
