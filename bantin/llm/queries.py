"""Imports every module of this package, so that its queries are registered."""

from bantin.llm import collocations, decontamination, jaccard_join, language_model, line_dedup, neighbours, packing, secret_scan, substring_dedup, suffix_dedup, token_files, toxicity, whitening  # noqa: F401
from bantin.llm.common import QUERIES, SQL  # noqa: F401
