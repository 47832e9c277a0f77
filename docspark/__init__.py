"""Document analytics on Spark DataFrames: detect, parse, describe, identify language, unpack."""

from docspark.operators.errors import raise_on_error, split_errors, validate_input
from docspark.operators.language import detect_language, language_confidence, train_language_profiles, with_language
from docspark.operators.media_types import detect_media_type, media_type_registry
from docspark.plans.documents import analyze_documents, parse_documents, parse_to_string, unpack
from docspark.session import configure
from docspark.sources.files import documents_from_table, read_files
from docspark.sources.sinks import chunk_content, write_embedded, write_extracted
from docspark.streaming.ingest import parse_stream, read_files_stream, read_split, write_stream, write_stream_split

__all__ = [
    "analyze_documents", "chunk_content", "configure", "detect_language", "detect_media_type",
    "documents_from_table", "language_confidence", "media_type_registry", "parse_documents", "parse_stream",
    "parse_to_string", "raise_on_error", "read_files", "read_files_stream", "read_split", "split_errors",
    "train_language_profiles", "unpack", "validate_input", "with_language", "write_embedded", "write_extracted",
    "write_stream", "write_stream_split",
]
