"""Scalar text expressions as Column builders; everything stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicons as lex

#: The code points that separate words: Unicode blanks and the ASCII separators; fixed values.
WS = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


#: All other code points, the ranges of most letters first: a regex engine tries them in this order.
SOLID = r"\x{21}-\x{84}\x{A1}-\x{167F}\x{86}-\x{9F}\x{1681}-\x{1FFF}\x{3001}-\x{10FFFF}\x{00}-\x{08}\x{0E}-\x{1B}\x{200B}-\x{2027}\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}"
_BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(s: Column) -> Column:
    return F.btrim(s, F.lit(_BLANKS))


def collapse(s: Column) -> Column:
    """Words joined by one blank."""
    return F.btrim(F.regexp_replace(s, f"[^{SOLID}]+", " "))


def words(s: Column) -> Column:
    """Words of a text; an empty or blank one has none."""
    flat = collapse(s)
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def word_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(f"[{SOLID}]+"))


def has_word_longer_than(s: Column, n: int) -> Column:
    """Tried at word starts only, so linear in the text; most lines are too short to hold such a word."""
    return (F.length(s) > n) & s.rlike(f"(?:^|[^{SOLID}])[{SOLID}]{{{n + 1}}}")


def has_words(s: Column, n: int) -> Column:
    """Whether a text has at least ``n`` words; looks no further than that."""
    return s.rlike(f"^[^{SOLID}]*(?:[{SOLID}]++[^{SOLID}]++){{{n - 1}}}[{SOLID}]") if n > 0 else F.lit(True)


def doc_id(text: Column, length: int = 12) -> Column:
    """Content identity: hex digits of the md5 of the lower-cased text with blanks collapsed. 12 digits are 48 bits:
    expect n*n/2**49 colliding pairs, so use more at scale."""
    return F.substring(F.md5(collapse(F.lower(text)).cast("binary")), 1, length)


def content(text: Column) -> Column:
    """All 32 digits of the content's id, to group and join by; ``short_id`` is what is returned of it."""
    return doc_id(text, 32)


def short_id(id_col: str = "id") -> Column:
    return F.substring(id_col, 1, 12).alias(id_col)


def letter_count(s: Column) -> Column:
    return F.length(s) - F.length(F.regexp_replace(s, r"\p{L}++", ""))


def class_count(s: Column, char_class: str) -> Column:
    """Characters of a class; they are taken out by runs, not found one by one."""
    return F.length(s) - F.length(F.regexp_replace(s, f"[{char_class}]++", ""))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def lines(s: Column) -> Column:
    """Stripped lines without the blank ones."""
    return F.filter(F.transform(F.split(s, "\n"), strip), lambda x: x != "")


def ends_with_any(line: Column, marks: str) -> Column:
    return F.substring(line, -1, 1).isin(*marks)


def starts_with_bullet(line: Column) -> Column:
    return F.substring(line, 1, 1).isin(*lex.BULLETS)


def bind(df: DataFrame, **made: Column) -> DataFrame:
    """Adds columns that later operators see as values, not as expressions."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in made.items())))))


def total_length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc + F.length(x))


def duplicate_chars(parts: Column) -> Column:
    """Characters of all repeats of a line after its first."""
    return total_length(parts) - total_length(F.array_distinct(parts))


def has_char_run(s: Column, longest: int = 5) -> Column:
    """Whether a character other than a leader or newline stands more than ``longest`` times in a row."""
    marks = lex.LEADERS.replace("-", r"\-")
    return s.rlike(rf"([^{marks}\n])\1{{{longest},}}")


def ngrams(w: Column, n: int) -> Column:
    """Word n-grams of a list of words. ``w`` should be a bound column: the lambda reads it once per n-gram."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
    return F.when(F.size(w) >= n, F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def source_list(source: Column) -> Column:
    """A single source as a list; null and empty become ``unknown``."""
    return F.array(F.coalesce(F.nullif(source, F.lit("")), F.lit("unknown")))


def flat_sources(sources: Column, fallback: str = "consensus") -> Column:
    """A list of sources as text; null, empty or all-null lists give the fallback."""
    return F.coalesce(F.nullif(F.array_join(sources, ","), F.lit("")), F.lit(fallback))
