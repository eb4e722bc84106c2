from tidemark.sources.feeds import (  # noqa: F401
    cdc_files,
    decode_envelope,
    decode_feed,
    flatten_debezium,
    from_json_lines,
    full_load_files,
    read_change_files,
    read_feed,
    start_options,
    stream_cdc_files,
    stream_change_dir,
)
from tidemark.sources.avro_schema import schema_from_avsc  # noqa: F401
