"""Small local stand-ins for a text model. They read the whole review and always answer the same."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

SENTENCE_END = r"[.!?。！？\n]+"


def keyword_classifier(words: Mapping[str, Sequence[str]], default: str):
    """The first label one of whose words occurs in the review, else the default."""

    def load():
        def answer(prompt: str, text: str) -> str:
            return next((label for label, ws in words.items() if any(w in text for w in ws)), default)

        return answer

    return load


def sentence_picker(max_chars: int = 30):
    """The longest sentence that fits, the first of equals; the shortest one if none fits."""

    def load():
        end = re.compile(SENTENCE_END)

        def answer(prompt: str, text: str) -> str:
            sentences = [s for s in (part.strip(" ") for part in end.split(text)) if s]
            fitting = [s for s in sentences if len(s) <= max_chars]
            if fitting:
                return max(fitting, key=len)
            return min(sentences, key=len, default="")

        return answer

    return load


def word_balance(positive: Sequence[str], negative: Sequence[str]):
    """Share of positive among all counted words, rounded half up to two decimals; 0.5 without any."""

    def load():
        def answer(prompt: str, text: str) -> str:
            good = sum(text.count(w) for w in positive)
            counted = good + sum(text.count(w) for w in negative)
            hundredths = (200 * good + counted) // (2 * counted) if counted else 50
            return f"{hundredths // 100}.{hundredths % 100:02d}"

        return answer

    return load
