from lodestar.streaming.uploads import header_schema, ingest_uploads, survey_upload_stream

__all__ = ["header_schema", "ingest_uploads", "survey_upload_stream"]
