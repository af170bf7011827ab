"""Text functions on columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire import fixed

# Whitespace incl. no-break and other Unicode spaces and the four separators:
# as single characters for trimming, and as a class for patterns.
_SPACES = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_NOT_SPACE = _SPACE.replace("[", "[^", 1)
_WORD = r"\p{L}\p{N}_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    Without it a Column used n times is n copies in the plan, and nested uses
    multiply.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_title(title: Column | str) -> Column:
    """Strip Unicode whitespace at both ends."""
    return F.btrim(_col(title), F.lit(_SPACES))


def is_blank(text: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return ~F.coalesce(_col(text).rlike(_NOT_SPACE), F.lit(False))


def non_empty(text: Column | str) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(_col(text), F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(_col(text), F.lit(f"{_NOT_SPACE}+"))


def too_short(text: Column | str, min_words: int = fixed.SUMMARY_MIN_WORDS) -> Column:
    """True where the text has fewer than ``min_words`` words; reads no further than those."""
    if min_words <= 0:
        return _col(text).isNull() & F.lit(False)
    gaps = f"(?:{_NOT_SPACE}++{_SPACE}++){{{min_words - 1}}}"
    return ~_col(text).rlike(f"^{_SPACE}*+{gaps}{_NOT_SPACE}")


def truncate_text(text: Column | str, limit: int = fixed.BODY_CHARS_FOR_SUMMARY) -> Column:
    """The first ``limit`` characters."""
    return F.substring(_col(text), 1, limit)


def input_text(
    title: Column | str, body: Column | str, limit: int | None = fixed.BODY_CHARS_FOR_TOPICS
) -> Column:
    """Title and the head of the body, or all of it without a limit, as one text; the title where there is no body."""
    title, body = _col(title), _col(body)
    with_body = F.concat(title, F.lit(". "), body if limit is None else F.substring(body, 1, limit))
    return F.when(non_empty(body).isNotNull(), with_body).otherwise(title)


# --- whole-word hints --------------------------------------------------------


def _split_hints(hints: Sequence[str]) -> tuple[list[str], list[str]]:
    """Hints that are one word, and the other ones (phrases, hints with signs)."""
    lowered = list(dict.fromkeys(h.lower() for h in hints))
    single = [h for h in lowered if re.fullmatch(r"\w+", h)]
    return single, [h for h in lowered if h not in single]


def _edge(char: str, side: str) -> str:
    """Word boundary next to the first or last character of a hint."""
    inside = re.match(r"\w", char) is not None
    sign = "!" if inside else "="
    return f"(?{'<' if side == 'left' else ''}{sign}[{_WORD}])"


def hint_pattern(hint: str) -> str:
    """Java pattern that finds ``hint`` as a whole word in lower-case text."""
    body = "".join(c if re.match(r"[\w ]", c) else "\\" + c for c in hint)
    return _edge(hint[0], "left") + body + _edge(hint[-1], "right")


def words(text: Column | str) -> Column:
    """Lower-case words of a text."""
    return F.split(F.lower(_col(text)), f"[^{_WORD}]+")


def _hits(tokens: Column, lowered: Column, hints: Sequence[str]) -> Column:
    single, phrases = _split_hints([h for h in hints if h])
    count = F.lit(0)
    if single:
        count = F.size(F.array_intersect(tokens, F.array(*[F.lit(h) for h in single])))
    for phrase in phrases:
        count = count + lowered.rlike(hint_pattern(phrase)).cast("int")
    return F.coalesce(count, F.lit(0))


def hint_hit_count(text: Column | str, hints: Sequence[str]) -> Column:
    """How many different hints occur in the text as whole words, in any case.

    One-word hints cost one split of the text whatever their number; only
    phrases need a pattern each.
    """
    return _hits(words(text), F.lower(_col(text)), hints)


def hint_hit_counts(text: Column | str, lexicons: Sequence[Sequence[str]]) -> Column:
    """``hint_hit_count`` for several word lists as an array; the text is split once."""
    text = _col(text)
    return bind(
        words(text), lambda tokens: F.array(*[_hits(tokens, F.lower(text), h) for h in lexicons])
    )


def has_hint(text: Column | str, hints: Sequence[str] = fixed.BASE_HINTS) -> Column:
    """True where any hint occurs; false for null and blank text."""
    text = _col(text)
    single, phrases = _split_hints([h for h in hints if h])
    found = F.lit(False)
    if single:
        found = F.arrays_overlap(words(text), F.array(*[F.lit(h) for h in single]))
    for phrase in phrases:
        found = found | F.lower(text).rlike(hint_pattern(phrase))
    return F.coalesce(found, F.lit(False))


def matched_hints(text: Column | str, hints: Sequence[str]) -> Column:
    """The hints that occur, in the order of ``hints``."""
    text = _col(text)
    checks = [F.when(has_hint(text, [h]), F.lit(h.lower())) for h in hints]
    return F.array_compact(F.array(*checks))


def lead_summary(text: Column | str, max_words: int = fixed.SUMMARY_MAX_WORDS) -> Column:
    """The first three sentences, at most ``max_words`` words, single-spaced."""
    sentences = F.regexp_extract(_col(text), r"^[.!?]*+((?:[^.!?]++[.!?]*+){1,3})", 1)
    head = F.regexp_extract(
        sentences, f"^{_SPACE}*+((?:{_NOT_SPACE}++{_SPACE}*+){{0,{max_words}}})", 1
    )
    return trim_title(F.regexp_replace(head, f"{_SPACE}++", " "))
