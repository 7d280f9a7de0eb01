"""All queries of this package."""

from newsloom.llm import align, bpe, decontaminate, lines, mixing, periodic, pii, quality, scoring, simhash, tokens, toxicity, warc  # noqa: F401
from newsloom.llm.registry import ORACLE, QUERIES  # noqa: F401
