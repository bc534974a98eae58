"""Whole jobs: from sources to stored corpora."""

from blockloom.plans.corpora import build_instruction_corpus, build_pretraining_corpus, merge_sources

__all__ = ["build_instruction_corpus", "build_pretraining_corpus", "merge_sources"]
