"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from orchard.llm import (chat, collocations, decontaminate, embed_dedup, exact_dedup, lexical, line_dedup, ngram_join,
                         packing, pii, quality, suffix_dedup, toxicity)

# in the order of the operators' numbers
_MODULES = (quality, toxicity, chat, embed_dedup, decontaminate, line_dedup, pii, ngram_join, packing,
            suffix_dedup, collocations, exact_dedup, lexical)

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: sql for m in _MODULES for k, sql in getattr(m, "ORACLE", {}).items()}
