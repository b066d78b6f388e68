"""What the quality rules need to know about a language: its marks, phrases and thresholds."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column

from . import lexicons as lex


@dataclass(frozen=True)
class LanguageProfile:
    """Rules are switched off by a None threshold or an empty list."""

    code: str
    script: str
    line_ends: str
    policy: tuple[str, ...]
    placeholders: tuple[str, ...]
    citation: str | None
    laughter: str | None
    specific: str | None = None
    low_script_reason: str = "low_script_ratio"
    low_specific_reason: str = "low_specific_ratio"
    # Thresholds whose values results depend on; fixed values.
    min_specific_ratio: float | None = None
    min_script_ratio: float = 0.5
    line_punct_thr: float = 0.091
    line_punct_exclude_zero: bool = True
    char_duplicates_ratio: float = 0.1
    new_line_ratio: float = 0.316
    min_doc_length: int = 100
    min_doc_words: int = 20
    short_line_thr: float = 0.67
    short_line_length: int = 30
    min_words_per_line: int = 2
    max_word_length: int = 100
    max_char_repetition: int = 5
    max_bullet_ratio: float = 0.9
    filter_curly_bracket: bool = True
    filter_javascript: bool = True
    filter_repetition: bool = True
    #: Own rules before all others: (test of a text column, reason) each.
    leading: tuple[tuple[Callable[[Column], Column], str], ...] = ()
    # Optional further rules; None leaves them out.
    min_avg_word_length: float | None = None
    max_avg_word_length: float | None = None
    dup_line_frac: float | None = None
    top_5_gram_frac: float | None = None
    top_10_gram_frac: float | None = None
    non_alpha_words_ratio: float | None = None
    lang_score_threshold: float | None = None

    @property
    def optional(self) -> bool:
        """Whether any optional rule is in force."""
        return any(getattr(self, n) is not None for n in ("min_avg_word_length", "max_avg_word_length", "dup_line_frac", "top_5_gram_frac", "top_10_gram_frac", "non_alpha_words_ratio", "lang_score_threshold"))

    def with_optional_rules(self) -> LanguageProfile:
        """The same profile with its configured optional rules in force."""
        return replace(self, **OPTIONAL.get(self.code, {}))


def _of(code: str, **own: object) -> LanguageProfile:
    marks = [r"\d+", "edit", "citation needed", *lex.CITATIONS[code]]
    return LanguageProfile(
        code=code,
        script=lex.SCRIPTS[code],
        line_ends=lex.LINE_ENDS[code],
        policy=(*lex.ENGLISH_POLICY, *lex.POLICY[code]),
        placeholders=(*lex.COMMON_PLACEHOLDERS, *lex.PLACEHOLDERS[code]),
        citation=r"\[(?:" + "|".join(marks) + r")\]",
        laughter="|".join(f"[{c}]{{4,}}" for c in lex.LAUGHTER[code]),
        specific=lex.SPECIFIC.get(code),
        **own,
    )


PROFILES = {
    "ar": _of("ar", min_script_ratio=0.3, line_punct_thr=0.05, char_duplicates_ratio=0.01, new_line_ratio=0.5, low_script_reason="low_arabic_ratio"),
    "tr": _of("tr", min_script_ratio=0.65, line_punct_exclude_zero=False, new_line_ratio=0.222, min_specific_ratio=0.01, low_specific_reason="low_turkish_char_ratio"),
    "hi": _of("hi"),
    "it": _of("it", min_script_ratio=0.65, line_punct_exclude_zero=False, new_line_ratio=0.25, min_specific_ratio=0.0, low_specific_reason="low_italian_char_ratio"),
    "th": _of("th"),
}

#: Thresholds of the optional rules; fixed values.
OPTIONAL = {
    "tr": {"min_avg_word_length": 3, "max_avg_word_length": 21, "dup_line_frac": 0.272, "top_5_gram_frac": 0.154, "top_10_gram_frac": 0.103, "lang_score_threshold": 0.875, "non_alpha_words_ratio": 0.773},
    "hi": {"min_avg_word_length": 2, "max_avg_word_length": 21, "dup_line_frac": 0.206, "top_5_gram_frac": 0.135, "top_10_gram_frac": 0.090, "lang_score_threshold": 0.692, "non_alpha_words_ratio": 0.837},
    "it": {"min_avg_word_length": 3, "max_avg_word_length": 21, "dup_line_frac": 0.25, "top_5_gram_frac": 0.15, "top_10_gram_frac": 0.10, "lang_score_threshold": 0.85, "non_alpha_words_ratio": 0.75},
    "th": {"min_avg_word_length": 2, "max_avg_word_length": 21, "dup_line_frac": 0.206, "top_5_gram_frac": 0.135, "top_10_gram_frac": 0.090, "lang_score_threshold": 0.692, "non_alpha_words_ratio": 0.837},
}

#: A lenient variant of the Arabic profile; fixed values.
LENIENT_ARABIC = replace(
    PROFILES["ar"], line_punct_thr=0.0, min_doc_length=50, min_doc_words=10, short_line_thr=0.75, short_line_length=25, min_words_per_line=1, max_word_length=150,
    char_duplicates_ratio=0.02, max_char_repetition=6, new_line_ratio=0.6, max_bullet_ratio=0.95, policy=(), citation=None, min_script_ratio=0.2,
)


def alternation(phrases: tuple[str, ...]) -> str:
    """A pattern that finds any of the phrases literally, with common beginnings merged: few branches at each place."""
    if "" in phrases:
        return ""
    tails: dict[str, list[str]] = {}
    for p in phrases:
        tails.setdefault(p[0], []).append(p[1:])
    parts = [re.sub(r"([\\.^$|()\[\]{}*+?])", r"\\\1", first) + alternation(tuple(rest)) for first, rest in sorted(tails.items())]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
