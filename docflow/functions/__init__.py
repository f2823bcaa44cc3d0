"""Column functions. All are built-in expressions; none runs Python on executors."""

from .classify import doc_type, evidence_tier, language, modality, population, topics
from .dates import month_number, partial_date, utc_stamp
from .licenses import normalize_license
from .text import clean_title, content_hash, original_uri

__all__ = [
    "clean_title", "content_hash", "doc_type", "evidence_tier", "language", "modality", "month_number", "normalize_license", "original_uri", "partial_date", "population", "topics", "utc_stamp",
]
