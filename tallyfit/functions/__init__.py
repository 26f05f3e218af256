"""Column expressions and user functions on text."""

from .text import hash_number, hash_percent, remove_characters, stop_words, with_tokens
from .user_functions import register_text_udf

__all__ = [
    "hash_number", "hash_percent", "register_text_udf", "remove_characters", "stop_words",
    "with_tokens",
]
