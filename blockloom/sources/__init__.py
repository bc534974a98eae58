"""Readers and writers."""

from blockloom.sources.readers import (
    Source,
    load_corpus,
    load_source,
    read_dir,
    read_instructions,
    read_json_text,
    read_text,
    scan_corpus_dirs,
)
from blockloom.sources.writers import materialize_once, write_corpus, write_provenance, write_source

__all__ = [
    "Source",
    "load_corpus",
    "load_source",
    "materialize_once",
    "read_dir",
    "read_instructions",
    "read_json_text",
    "read_text",
    "scan_corpus_dirs",
    "write_corpus",
    "write_provenance",
    "write_source",
]
