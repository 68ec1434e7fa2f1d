"""All registered queries of this subpackage and their SQL."""

from __future__ import annotations

from rowferry.llm import (  # noqa: F401
    bpe, decontaminate, fuzzy_lines, html_text, jaccard_groups, manifest, ngram_model, passages, personal_data, quality,
    records, vector_graphs, whitening,
)
from rowferry.llm.common import ORACLES, QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
