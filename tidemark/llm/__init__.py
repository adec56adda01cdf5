"""Operators of a training-data pipeline over documents, pages and conversations; nothing else imports this."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("line_dedup", "bpe", "language_id", "media", "url_filter", "mixing", "exact_dedup", "chat_format", "token_store", "near_dedup",
            "hard_negatives", "ann_search", "filter_audit")
QUERIES: dict = {}
ORACLES: dict = {}
for _name in _MODULES:
    _module = import_module(f"{__name__}.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
