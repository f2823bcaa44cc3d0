"""Strict configuration and the fixed enumerations of the front-matter contract."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from pathlib import Path

import yaml
from pydantic import BaseModel, ConfigDict, Field, field_validator, model_validator

# Enumerations in their contract's order, and ISO 639-2 to 639-1.
DOC_TYPES = ("guideline", "systematic_review", "meta_analysis", "rct", "observational", "narrative_review", "consensus", "patient_education", "other")
MODALITIES = ("hemodialysis", "peritoneal_dialysis", "ckd_non_dialysis", "transplant", "unspecified")
POPULATIONS = ("adult", "pediatric", "mixed", "unspecified")
STATUSES = ("pending", "approved", "rejected", "suspended")
METHODS = ("source", "rule", "llm", "manual")
AUDIENCES = ("clinician", "patient")
SCHEMA_VERSION = 2
LANGUAGES = {
    "eng": "en", "ita": "it", "fre": "fr", "fra": "fr", "ger": "de", "deu": "de", "spa": "es", "por": "pt", "dut": "nl", "nld": "nl", "rus": "ru", "pol": "pl", "tur": "tr", "jpn": "ja",
    "chi": "zh", "zho": "zh", "kor": "ko", "ara": "ar", "swe": "sv", "dan": "da", "nor": "no", "fin": "fi", "cze": "cs", "ces": "cs", "hun": "hu", "gre": "el", "ell": "el", "heb": "he",
}


class Strict(BaseModel):
    model_config = ConfigDict(extra="forbid")


class Ncbi(Strict):
    tool: str
    email: str
    batch_size: int = Field(100, ge=1, le=500)
    timeout_s: float = Field(30, gt=0)
    max_retries: int = Field(5, ge=0, le=10)


class Search(Strict):
    query: str
    extra_filter: str | None = None
    max_results: int = Field(200, ge=1, le=10_000)
    sort: str = "pub_date"
    mindate: str | None = None
    maxdate: str | None = None

    @field_validator("mindate", "maxdate")
    @classmethod
    def _date(cls, value: str | None) -> str | None:
        if value is not None and not re.fullmatch(r"\d{4}(/\d{2}(/\d{2})?)?", value):
            raise ValueError("a date is YYYY, YYYY/MM or YYYY/MM/DD")
        return value

    @model_validator(mode="after")
    def _both_dates(self) -> Search:
        if (self.mindate is None) != (self.maxdate is None):
            raise ValueError("mindate and maxdate go together")
        return self

    @property
    def term(self) -> str:
        return f"({self.query}) AND ({self.extra_filter})" if self.extra_filter else self.query


class TypeRule(Strict):
    publication_type: str
    doc_type: str


class Mapping(Strict):
    publication_type_doc_type: list[TypeRule]
    evidence_tier: dict[str, int]
    mesh_modality: dict[str, str] = {}
    dialysis_mesh_terms: list[str] = []
    topics: dict[str, list[str]] = {}
    population_pediatric_mesh: list[str] = []
    population_adult_mesh: list[str] = []

    @model_validator(mode="after")
    def _total(self) -> Mapping:
        if set(self.evidence_tier) != set(DOC_TYPES) or not all(1 <= v <= 5 for v in self.evidence_tier.values()):
            raise ValueError("evidence_tier needs every doc type, 1 to 5")
        if bad := {r.doc_type for r in self.publication_type_doc_type} - set(DOC_TYPES) | set(self.mesh_modality.values()) - set(MODALITIES):
            raise ValueError(f"unknown values: {sorted(bad)}")
        return self


class Quality(Strict):
    min_body_chars: int = 1500
    allowed_languages: list[str]
    allowed_licenses: list[str]
    require_license: bool = True


class Corpus(Strict):
    corpus_dir: str = "corpus"
    rejected_dir: str = "rejected"
    max_pr_size: int = Field(20, ge=1)
    branch_prefix: str = "ingest/"


class Originals(Strict):
    dir: str = "originals"
    base_uri: str | None = None


class Config(Strict):
    ncbi: Ncbi
    search: Search
    mapping: Mapping
    quality: Quality
    corpus: Corpus
    originals: Originals


def _read(path: str | os.PathLike[str]) -> Config:
    return Config.model_validate(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def load_config(path: str | os.PathLike[str]) -> Config:
    """A configuration to run with; ValueError if its query or e-mail address is missing, which the default leaves open."""
    config = _read(path)
    if not config.search.query.strip():
        raise ValueError("search.query is empty")
    if not re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", config.ncbi.email):
        raise ValueError("ncbi.email is no address")
    return config


@lru_cache
def default_config() -> Config:
    return _read(Path(__file__).with_name("vocabulary.yaml"))


class Secrets(Strict):
    """From the environment only; never from files."""

    ncbi_api_key: str | None = None

    @classmethod
    def from_env(cls) -> Secrets:
        return cls(ncbi_api_key=os.environ.get("NCBI_API_KEY") or None)
