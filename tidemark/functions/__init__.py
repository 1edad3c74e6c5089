from tidemark.functions.labels import label_text
from tidemark.functions.numbers import python_float_text, round_exact, round_half_away
from tidemark.functions.text import fold_platform, json_quote, nonblank_or, threshold_band

__all__ = [
    "fold_platform",
    "json_quote",
    "label_text",
    "nonblank_or",
    "python_float_text",
    "round_exact",
    "round_half_away",
    "threshold_band",
]
