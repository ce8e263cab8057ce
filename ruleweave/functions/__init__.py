"""Column expressions: no shuffles, no Python workers, usable on batch and streaming frames alike."""

from ruleweave.functions.draws import DRAW_BITS, draw
from ruleweave.functions.text import (
    build_prompt,
    clean_urls,
    digest,
    label_to_token,
    normalize_missing,
    pick_example,
    reply_to_label,
    sft_text,
    str_or_nan,
    strip_prompt,
)
from ruleweave.functions.vectors import (
    cosine_similarity,
    euclidean_distance,
    hashed_embedding,
    l2_normalize,
    nearest_side,
    zero_vector,
)

__all__ = [
    "DRAW_BITS",
    "build_prompt",
    "clean_urls",
    "cosine_similarity",
    "digest",
    "draw",
    "euclidean_distance",
    "hashed_embedding",
    "l2_normalize",
    "label_to_token",
    "nearest_side",
    "normalize_missing",
    "pick_example",
    "reply_to_label",
    "sft_text",
    "str_or_nan",
    "strip_prompt",
    "zero_vector",
]
