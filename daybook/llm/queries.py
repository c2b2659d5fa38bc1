"""All registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from daybook.llm import conversations, decontamination, exact_dedup, filter_audit, jaccard_join, language_id, line_dedup, lm_scoring, mixing, quality, substring_dedup, token_counts, token_files  # noqa: F401
from daybook.llm.registry import ORACLES as CORPUS_ORACLES  # noqa: F401
from daybook.llm.registry import QUERIES as CORPUS_QUERIES  # noqa: F401
