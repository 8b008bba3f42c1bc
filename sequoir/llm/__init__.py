"""Training-data operators: language id, token counts, archives, BPE, HTML,
decontamination, LM scoring, URL filtering, quality rules, near-duplicates,
alignments of tokenizers, vector codes and secret scans.

Nothing else in the package imports this subpackage.
"""

from sequoir.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
