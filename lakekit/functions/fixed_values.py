"""Lookup tables, names and patterns whose text decides results."""

import mimetypes

# Export formats per source mime type (target, mime type, file extension).
DOCUMENT_MIME = "application/vnd.google-apps.document"
SPREADSHEET_MIME = "application/vnd.google-apps.spreadsheet"
PRESENTATION_MIME = "application/vnd.google-apps.presentation"
FOLDER_MIME = "application/vnd.google-apps.folder"

EXPORT_FORMATS = (
    (DOCUMENT_MIME, "Word", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "docx"),
    (DOCUMENT_MIME, "OpenDocument", "application/vnd.oasis.opendocument.text", "odt"),
    (DOCUMENT_MIME, "RichText", "application/rtf", "rtf"),
    (DOCUMENT_MIME, "PDF", "application/pdf", "pdf"),
    (DOCUMENT_MIME, "PlainText", "text/plain", "txt"),
    (DOCUMENT_MIME, "HTML", "application/zip", "zip"),
    (DOCUMENT_MIME, "EPUB", "application/epub+zip", "epub"),
    (SPREADSHEET_MIME, "Excel", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "xlsx"),
    (SPREADSHEET_MIME, "OpenDocument", "application/x-vnd.oasis.opendocument.spreadsheet", "ods"),
    (SPREADSHEET_MIME, "PDF", "application/pdf", "pdf"),
    (SPREADSHEET_MIME, "HTML", "application/zip", "zip"),
    (SPREADSHEET_MIME, "CSV", "text/csv", "csv"),
    (SPREADSHEET_MIME, "TSV", "text/tab-separated-values", "tsv"),
    (PRESENTATION_MIME, "PowerPoint",
     "application/vnd.openxmlformats-officedocument.presentationml.presentation", "pptx"),
    (PRESENTATION_MIME, "ODP", "application/vnd.oasis.opendocument.presentation", "odp"),
    (PRESENTATION_MIME, "PDF", "application/pdf", "pdf"),
    (PRESENTATION_MIME, "PlainText", "text/plain", "txt"),
)

# Mime types by file extension: the standard library's own table, whatever the machine's files say, and after it
# fixed values for newer or differing names; anything else takes the caller's default.
MIME_BY_EXTENSION = {
    **{ending[1:]: kind for strict in (False, True) for ending, kind in mimetypes.MimeTypes().types_map[strict].items()},
    "txt": "text/plain", "md": "text/markdown", "html": "text/html", "htm": "text/html",
    "css": "text/css", "csv": "text/csv", "tsv": "text/tab-separated-values",
    "js": "text/javascript", "json": "application/json", "xml": "text/xml",
    "pdf": "application/pdf", "zip": "application/zip", "gz": "application/gzip",
    "rtf": "application/rtf", "epub": "application/epub+zip",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "odt": "application/vnd.oasis.opendocument.text",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "odp": "application/vnd.oasis.opendocument.presentation",
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
    "svg": "image/svg+xml", "webp": "image/webp", "bmp": "image/bmp",
    "mp3": "audio/mpeg", "wav": "audio/wav", "mp4": "video/mp4", "mpeg": "video/mpeg",
    "mov": "video/quicktime", "avi": "video/x-msvideo", "webm": "video/webm", "ogg": "audio/ogg", "oga": "audio/ogg",
    "ogv": "video/ogg", "flac": "audio/flac", "m4a": "audio/mp4", "aac": "audio/aac", "ico": "image/x-icon",
    "tif": "image/tiff", "tiff": "image/tiff", "heic": "image/heic", "avif": "image/avif", "yaml": "text/yaml", "yml": "text/yaml",
    "doc": "application/msword", "xls": "application/vnd.ms-excel", "ppt": "application/vnd.ms-powerpoint",
    "tar": "application/x-tar", "bz2": "application/x-bzip2", "7z": "application/x-7z-compressed", "wasm": "application/wasm",
    "parquet": "application/vnd.apache.parquet", "woff": "font/woff", "woff2": "font/woff2", "ttf": "font/ttf", "otf": "font/otf",
}
OCTET_STREAM = "application/octet-stream"
TEXT_PLAIN = "text/plain"

# Fixed value: `type/subtype` with optional `;name=value` parameters.
MIME_PATTERN = (
    r"^[A-Za-z0-9!#$%&'*+.^_`|~-]+/[A-Za-z0-9!#$%&'*+.^_`|~-]+"
    r"(\s*;\s*[A-Za-z0-9!#$%&'*+.^_`|~-]+=([A-Za-z0-9!#$%&'*+.^_`|~-]+|\"[^\"]*\"))*\s*;?$"
)

# Resource name patterns.
RESOURCE_PATTERNS = {
    "service": r"projects/(.+)/locations/(.+)/services/(.+)",
    "job": r"projects/(.+)/locations/(.+)/jobs/(.+)",
    "execution": r"projects/(.+)/locations/(.+)/jobs/(.+)/executions/(.+)",
}

# Status and state names by wire text, with the default last.
JOB_STATUS = {"DONE": "Done", "PENDING": "Pending", "RUNNING": "Running"}
JOB_STATUS_DEFAULT = "Unknown"
CONDITION_TYPE = {
    "Started": "Started", "ContainerReady": "ContainerReady",
    "ResourcesAvailable": "ResourcesAvailable", "Completed": "Completed", "Retry": "Retry",
}
CONDITION_TYPE_DEFAULT = "Undefined"
CONDITION_STATE = {
    "STATE_UNSPECIFIED": "Unspecified", "CONDITION_PENDING": "Pending",
    "CONDITION_RECONCILING": "Reconciling", "CONDITION_FAILED": "Failed",
    "CONDITION_SUCCEEDED": "Succeeded",
}
CONDITION_STATE_DEFAULT = "Unspecified"

# Error kinds by code, and the stand-ins for missing parts.
ERROR_KIND = {404: "NotFound", 403: "Forbidden"}
ERROR_KIND_DEFAULT = "Undefined"
ERROR_CODE_DEFAULT = 500
ERROR_MESSAGE_DEFAULT = "Unknown error"

# Model publishers by model name prefix.
MODEL_PUBLISHER = {"gemini": "google", "claude": "anthropic"}
MODEL_PUBLISHER_DEFAULT = "google"

# Embedding task types.
EMBED_TASK_TYPES = (
    "SEMANTIC_SIMILARITY", "CLASSIFICATION", "CLUSTERING", "RETRIEVAL_DOCUMENT",
    "RETRIEVAL_QUERY", "QUESTION_ANSWERING", "FACT_VERIFICATION", "CODE_RETRIEVAL_QUERY",
)

# Declared column type when read, and when written.
READ_TYPE = {
    "STRING": "STRING", "FLOAT": "FLOAT", "INTEGER": "INTEGER", "NUMERIC": "FLOAT",
    "BOOLEAN": "BOOLEAN", "TIMESTAMP": "TIMESTAMP", "DATE": "DATE", "DATETIME": "DATETIME",
    "TIME": "TIME", "RECORD": "RECORD", "JSON": "JSON",
}
READ_TYPE_DEFAULT = "UNKNOWN"
WRITE_TYPE = {
    "STRING": "STRING", "FLOAT": "NUMERIC", "INTEGER": "INTEGER", "BOOLEAN": "BOOLEAN",
    "TIMESTAMP": "TIMESTAMP", "DATETIME": "DATETIME", "DATE": "DATE", "TIME": "TIME",
    "RECORD": "RECORD", "JSON": "JSON",
}
MODES = ("REQUIRED", "NULLABLE", "REPEATED")
MODE_DEFAULT = "UNKNOWN"
