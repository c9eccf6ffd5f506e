"""Imports every module that registers queries."""

from siltstone.llm import q_corpus, q_documents, q_records  # noqa: F401
from siltstone.llm.registry import ORACLES, QUERIES  # noqa: F401
