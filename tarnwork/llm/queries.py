"""Brings together the queries of this folder."""

from __future__ import annotations

from tarnwork.llm import chat, collocations, decontam, fingerprints, jaccard_join, langid, licenses, mixing, packing, pii, sharding, spelling, warc  # noqa: F401
from tarnwork.llm.registry import QUERIES, SQL  # noqa: F401
