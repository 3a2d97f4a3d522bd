"""The registered queries of this subpackage."""

from . import (  # noqa: F401
    exact_dedup,
    hard_negatives,
    language_id,
    manifest,
    mixing,
    packing,
    phrase_dedup,
    quality_rules,
    secret_scan,
    simhash,
    suffix_dedup,
    url_filters,
    word_bpe,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
