"""All registered queries of the corpus operators."""

from barograph.llm import (  # noqa: F401
    chat_format,
    decontaminate,
    jaccard_join,
    order_minhash,
    packing,
    patched_frames,
    repeated_strings,
    secret_scan,
    sharding,
    toxicity,
    url_filter,
    vector_codes,
    whitening,
)
from barograph.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
