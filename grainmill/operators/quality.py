"""The ordered quality rules of a language: rewrite a text, or say why it is rejected.

The first rule that fails gives the reason. Intermediate results are bound by a one-row ``inline``: Catalyst does not
push predicates or projections through a generator, so each expensive expression is evaluated once, whatever is
filtered afterwards. Everything is a JVM expression; there is no shuffle.

Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import PROFILES, LanguageProfile, alternation
from ..functions.text import bind
from ..session import spread

LINE_REASONS = ["line_long_word", "line_javascript", "line_policy", "line_too_few_words"]


def _document_reason(p: LanguageProfile, s: Column, alpha: Column) -> Column:
    """Rules on the raw text, which has ``alpha`` letters."""
    rules: list[tuple[Column, str]] = [(test(s), reason) for test, reason in p.leading]
    if p.specific and p.min_specific_ratio:
        rules.append((T.ratio(T.class_count(s, p.specific), alpha) < p.min_specific_ratio, p.low_specific_reason))
    rules.append((F.length(s) < p.min_doc_length, "too_short_chars"))
    if p.filter_curly_bracket:
        rules.append((F.contains(s, F.lit("{")), "curly_bracket"))
    if p.placeholders:
        rules.append((F.lower(s).rlike(alternation(p.placeholders)), "lorem_ipsum"))
    rules.append((alpha == 0, "no_alpha_chars"))
    rules.append((T.ratio(T.class_count(s, p.script), alpha) < p.min_script_ratio, p.low_script_reason))
    return first_reason(rules)


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for test, reason in reversed(rules):
        out = F.when(test, F.lit(reason)).otherwise(out)
    return out


def _line_reason(p: LanguageProfile, line: Column) -> Column:
    low = F.lower(line)
    rules = []
    if p.max_word_length > 0:
        rules.append((T.has_word_longer_than(line, p.max_word_length), "line_long_word"))
    if p.filter_javascript:
        rules.append((F.contains(low, F.lit("javascript")), "line_javascript"))
    if p.policy:
        rules.append((low.rlike(alternation(p.policy)), "line_policy"))
    if p.min_words_per_line > 0:
        rules.append((~T.ends_with_any(line, p.line_ends) & ~T.has_words(line, p.min_words_per_line), "line_too_few_words"))
    return first_reason(rules)


class _Choice:
    """One profile, or the profile of each row's language. Only the branch of a row's language is evaluated."""

    def __init__(self, profiles: LanguageProfile | dict[str, LanguageProfile]) -> None:
        self.profiles = profiles

    def __call__(self, make: Callable[[LanguageProfile], Column], otherwise: Column | None = None) -> Column:
        if isinstance(self.profiles, LanguageProfile):
            return make(self.profiles)
        out = F.lit(None) if otherwise is None else otherwise
        for code, p in self.profiles.items():
            out = F.when(F.col("q_lang") == code, make(p)).otherwise(out)
        return out

    @property
    def optional(self) -> bool:
        own = [self.profiles] if isinstance(self.profiles, LanguageProfile) else self.profiles.values()
        return any(p.optional for p in own)


def marked_lines(df: DataFrame, profile: LanguageProfile | dict[str, LanguageProfile], text_col: str = "text") -> DataFrame:
    """Adds ``q_reason`` of the raw text and, where it has none, ``q_lines`` with the reason each line is dropped."""
    return _mark(spread(df), {"": _Choice(profile)}, text_col)


def _mark(df: DataFrame, judges: dict[str, _Choice], text_col: str) -> DataFrame:
    """``q_reason`` and ``q_lines`` of each judge, under names that end in its tag."""
    s = F.coalesce(F.col(text_col), F.lit(""))

    def marked(p: LanguageProfile) -> Column:
        body = F.regexp_replace(s, p.citation.replace(r"\d", r"\p{Nd}"), "") if p.citation else s
        return F.transform(T.lines(body), lambda x: F.struct(x.alias("line"), _line_reason(p, x).alias("reason")))

    df = bind(df, q_alpha=T.letter_count(s))  # asked for by several rules
    df = bind(df, **{f"q_reason{tag}": choose(lambda p: _document_reason(p, s, F.col("q_alpha")), F.lit("no_profile")) for tag, choose in judges.items()})
    return bind(df, **{f"q_lines{tag}": F.when(F.col(f"q_reason{tag}").isNull(), choose(marked)) for tag, choose in judges.items()})


def annotate(df: DataFrame, profile: LanguageProfile | dict[str, LanguageProfile], text_col: str = "text") -> DataFrame:
    """Adds ``reject_reason`` (null: kept) and ``filtered_text`` (null: rejected)."""
    names = [c for c in df.columns if c != "q_lang"]
    df = _judge(spread(df), {"": _Choice(profile)}, text_col)
    return df.select(*names, F.col("q_verdict").alias("reject_reason"), F.when(F.col("q_verdict").isNull(), F.col("q_text")).alias("filtered_text"))


def _judge(df: DataFrame, judges: dict[str, _Choice], text_col: str) -> DataFrame:
    """``q_text``, the kept lines, and ``q_verdict``, the first rule that fails, of each judge: every value is bound once
    for all of them, so a row is copied as often for five judges as for one."""
    df = _mark(df, judges, text_col)
    df = bind(df, **{f"q_kept{tag}": F.transform(F.filter(f"q_lines{tag}", lambda x: x.reason.isNull()), lambda x: x.line) for tag in judges})
    made: dict[str, Column] = {}
    for tag, choose in judges.items():
        made |= _measures(choose, F.col(f"q_kept{tag}"), tag)
    df = bind(df, **made)
    if lists := {f"q_list{tag}": T.words(F.col(f"q_text{tag}")) for tag, choose in judges.items() if choose.optional}:
        df = bind(df, **lists)
    scored = "lang_score" in df.columns
    return bind(df, **{f"q_verdict{tag}": F.coalesce(f"q_reason{tag}", choose(_rules_of(tag, scored))) for tag, choose in judges.items()})


def _measures(choose: _Choice, kept: Column, tag: str) -> dict[str, Column]:
    made = {
        "q_n": F.size(kept),
        "q_words": T.word_count(F.array_join(kept, "\n")),
        "q_ended": choose(lambda p: F.size(F.filter(kept, lambda x: T.ends_with_any(x, p.line_ends)))),
        "q_short": choose(lambda p: F.size(F.filter(kept, lambda x: F.length(x) <= p.short_line_length))),
        "q_bullets": F.size(F.filter(kept, T.starts_with_bullet)),
        "q_chars": T.total_length(kept),
        "q_repeats": T.duplicate_chars(kept),
        "q_text": F.array_join(kept, "\n"),
    }
    return {f"{n}{tag}": c for n, c in made.items()}


def _rules_of(tag: str, scored: bool) -> Callable[[LanguageProfile], Column]:
    return lambda p: first_reason(_text_rules(p, tag) + _optional_rules(p, tag, scored))


def _text_rules(p: LanguageProfile, tag: str) -> list[tuple[Column, str]]:
    """Rules on the kept lines, in order."""
    col = lambda n: F.col(f"q_{n}{tag}")
    n, r, s = col("n"), T.ratio, col("text")
    low_ends = r(col("ended"), n) < p.line_punct_thr
    rules = [
        (n == 0, "empty"),
        (col("words") < p.min_doc_words, "too_few_words"),
        (low_ends & (col("ended") > 0) if p.line_punct_exclude_zero else low_ends, "line_punct_ratio"),
        (r(col("short"), n) > p.short_line_thr, "short_line_ratio"),
        (r(col("bullets"), n) > p.max_bullet_ratio, "bullet_ratio"),
        (r(n - 1, col("words")) > p.new_line_ratio, "list_ratio"),
        (r(col("repeats"), col("chars")) > p.char_duplicates_ratio, "char_dup_ratio"),
    ]
    if p.filter_repetition:
        runs = T.has_char_run(s, p.max_char_repetition)
        rules.append((runs | s.rlike(p.laughter) if p.laughter else runs, "excessive_repetition"))
    return rules


def _optional_rules(p: LanguageProfile, tag: str, scored: bool) -> list[tuple[Column, str]]:
    """Rules that are off unless the profile gives their thresholds."""
    rules, kept, w = [], F.col(f"q_kept{tag}"), F.col(f"q_list{tag}")
    if not p.optional:
        return rules
    mean = T.ratio(F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)), F.size(w))
    if p.min_avg_word_length is not None:
        rules.append((mean < p.min_avg_word_length, "avg_word_too_short"))
    if p.max_avg_word_length is not None:
        rules.append((mean > p.max_avg_word_length, "avg_word_too_long"))
    if p.dup_line_frac is not None:
        rules.append((T.ratio(F.size(kept) - F.size(F.array_distinct(kept)), F.size(kept)) > p.dup_line_frac, "dup_line_frac"))
    for n, limit in ((5, p.top_5_gram_frac), (10, p.top_10_gram_frac)):
        if limit is not None:
            rules.append((top_ngram_share(w, F.length(f"q_text{tag}"), n) > limit, f"top_{n}_gram_frac"))
    if p.non_alpha_words_ratio is not None:
        with_letter = F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))
        rules.append((T.ratio(with_letter, F.size(w)) < p.non_alpha_words_ratio, "non_alpha_words"))
    if p.lang_score_threshold is not None and scored:
        rules.append((F.col("lang_score") < p.lang_score_threshold, "lang_score"))
    return rules


def top_ngram_share(w: Column, length: Column, n: int) -> Column:
    """Characters of the most frequent word n-gram's occurrences by those of the text; sorts, so n log n."""
    grams = F.array_sort(T.ngrams(w, n))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, g: Column) -> Column:
        run = F.when(g == acc.last, acc.run + 1).otherwise(F.lit(1))
        return F.struct(g.alias("last"), run.alias("run"), F.greatest(acc.best, F.when(run > 1, run * F.length(g)).otherwise(F.lit(0))).alias("best"))

    return T.ratio(F.aggregate(grams, start, step, lambda acc: acc.best), length)


def apply(df: DataFrame, profile: LanguageProfile, text_col: str = "text") -> DataFrame:
    """Kept rows with their text rewritten."""
    names = df.columns
    kept = annotate(df, profile, text_col).where(F.col("reject_reason").isNull())
    return kept.select(*(F.col("filtered_text").alias(c) if c == text_col else F.col(c) for c in names))


def annotate_by_language(df: DataFrame, lang_col: str = "lang", text_col: str = "text", profiles: dict[str, LanguageProfile] | None = None) -> DataFrame:
    """Every row by the profile of its language; rows of other languages have reason ``no_profile``. One scan."""
    return annotate(bind(df, q_lang=F.coalesce(language_code(F.col(lang_col)), F.lit("und"))), profiles or PROFILES, text_col)


def language_code(lang: Column) -> Column:
    """Two-letter code of ``it``, ``IT``, ``it-IT`` or ``ita_Latn``; null for other languages."""
    head = F.regexp_extract(F.lower(F.trim(lang)), "^([a-z]+)", 1)
    out = F.lit(None).cast("string")
    for code, names in {"ar": ("ar", "ara", "arb"), "tr": ("tr", "tur"), "hi": ("hi", "hin"), "it": ("it", "ita"), "th": ("th", "tha")}.items():
        out = F.when(head.isin(*names), code).otherwise(out)
    return out


def reason_histogram(df: DataFrame, profile: LanguageProfile, text_col: str = "text") -> DataFrame:
    return reason_histograms(df, {profile.code: profile}, text_col).drop("profile")


def line_drop_histogram(df: DataFrame, profile: LanguageProfile, text_col: str = "text") -> DataFrame:
    """How many lines each line rule dropped, in the documents that came as far as the lines."""
    return line_drop_histograms(df, {profile.code: profile}, text_col).drop("profile")


def _judges(profiles: dict[str, LanguageProfile]) -> dict[str, _Choice]:
    return {f"_{code}": _Choice(p) for code, p in profiles.items()}


def reason_histograms(df: DataFrame, profiles: dict[str, LanguageProfile], text_col: str = "text") -> DataFrame:
    """``profile, reason, documents`` of all profiles from one scan."""
    rows = _judge(spread(df.select(F.col(text_col).alias("text"))), _judges(profiles), "text")
    made = F.array(*(F.struct(F.lit(code).alias("profile"), F.coalesce(f"q_verdict_{code}", F.lit("kept")).alias("reason")) for code in profiles))
    return rows.select(F.inline(made)).groupBy("profile", "reason").agg(F.count("*").alias("documents"))


def _line_of(code: str) -> Callable[[Column], Column]:
    return lambda r: F.struct(F.lit(code).alias("profile"), F.coalesce(r, F.lit("kept")).alias("reason"))


def line_drop_histograms(df: DataFrame, profiles: dict[str, LanguageProfile], text_col: str = "text") -> DataFrame:
    """``profile, reason, lines`` of all profiles from one scan."""
    rows, none = _mark(spread(df.select(F.col(text_col).alias("text"))), _judges(profiles), "text"), F.array().cast("array<struct<profile:string,reason:string>>")
    every = F.flatten(F.array(*(F.coalesce(F.transform(f"q_lines_{code}.reason", _line_of(code)), none) for code in profiles)))
    return rows.select(F.inline(every)).groupBy("profile", "reason").agg(F.count("*").alias("lines"))
