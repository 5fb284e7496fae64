"""Column functions on text. Patterns and marks are parameters; defaults suit Chinese prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation that counts as equal after compatibility normalisation.
PUNCTUATION = {"“": '"', "”": '"', "„": '"', "‟": '"', "「": '"', "」": '"', "‘": "'", "’": "'", "『": "'", "』": "'", "！": "!", "？": "?", "，": ",", "。": ".", "；": ";", "：": ":", "（": "(", "）": ")", "、": ",", "—": "-", "－": "-", "～": "~", "《": "<", "》": ">"}
# Speech from an opening mark on, and marks of a sentence.
SPEECH = r'[“"]([^“”"]{2,})'
SENTENCE_MARKS = "。！？…～~，,、；;：:"
#: White space as Python's str methods see it: the ideographic space, too.
SPACE = r"(?U)\s"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def flat(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, rf"{SPACE}+", "")


def normalized(text: Column) -> Column:
    """Compatibility form, one form of each mark, no white space; ASCII texts skip the Python step."""
    from storyloom.functions.similarity import nfkc

    ascii_only = text.rlike(r"^\p{ASCII}*$")
    composed = F.when(ascii_only, text).otherwise(nfkc(F.when(~ascii_only, text)))
    expanded = F.regexp_replace(composed, "…", "...")
    return flat(F.translate(expanded, "".join(PUNCTUATION), "".join(PUNCTUATION.values())))


def speech_segments(paragraph: Column, pattern: str = SPEECH) -> Column:
    return F.regexp_extract_all(paragraph, F.lit(pattern), 1)


def is_speech(segment: Column, marks: str = SENTENCE_MARKS) -> Column:
    """Speech rather than a quoted noun: 7 characters, or 2 with a sentence mark."""
    s = strip(F.coalesce(segment, F.lit("")))
    return (F.length(s) >= 7) | ((F.length(s) >= 2) & s.rlike("[" + "".join("\\" + c for c in marks) + "]"))


def without_note(name: Column) -> Column:
    return strip(F.split(name, "[（(]")[0])


def numbered(paragraphs: Column) -> Column:
    """``[n] paragraph`` lines."""
    return F.array_join(F.transform(paragraphs, lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), p)), "\n")


def label(seq: Column, title: Column, merged: Column | None = None, pattern: str = "第%d章 ") -> Column:
    """Heading of a unit with the titles merged into it."""
    head = F.concat(F.format_string(pattern, seq), F.coalesce(title, F.lit("")))
    return head if merged is None else F.when(F.size(merged) > 0, F.concat(head, F.lit(" + "), F.array_join(merged, " + "))).otherwise(head)


def terms(text: Column) -> Column:
    """Split a list of terms at commas, enumeration commas and semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[,，、;；]"), strip), lambda t: t != "")


def united_terms(*lists: Column) -> Column:
    """Terms of several lists in order, each once."""
    return F.array_distinct(F.concat(*[terms(x) for x in lists]))


def slug(name: Column, most: int = 20) -> Column:
    """A name for files: each mark that they may not have becomes an underscore, and what is too long is cut."""
    return F.substring(F.regexp_replace(strip(name), r'[\\/:*?"<>|\s]', "_"), 1, most)


def filled(values: Column) -> Column:
    """The strings of an array that are not null or blank, trimmed; null gives none."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.filter(F.transform(values, strip), lambda x: x.isNotNull() & (x != "")), empty)


def visible(text: Column) -> Column:
    """Without byte order marks and zero-width characters."""
    return strip(F.regexp_replace(text, "[﻿​‌‍⁠]", ""))


def json_block(reply: Column) -> Column:
    """The JSON object in a reply: fences off, then from the first brace to the last; null if there is none."""
    body = F.regexp_replace(visible(reply), r"(?s)^```[a-zA-Z]*\s*|\s*```$", "")
    found = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def duration(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), seconds.cast("long"))
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def display_width(text: Column) -> Column:
    """Terminal columns: wide characters take two."""
    wide = F.regexp_replace(text, r"[^ᄀ-ᅟ⺀-꓏가-힣豈-﫿︰-﹯＀-｠￠-￦]", "")
    return F.length(text) + F.length(wide)


def clip(text: Column, width: int) -> Column:
    """The longest beginning of a text that takes at most ``width`` terminal columns; characters beyond U+2E80 take two."""
    head = F.substring(text, 1, width)
    used = lambda s: F.length(s) + F.length(F.regexp_replace(s, r"[^\x{2E81}-\x{10FFFF}]", ""))
    fits = F.filter(F.sequence(F.lit(0), F.length(head)), lambda n: used(F.substr(head, F.lit(1), n)) <= width)
    return F.substr(head, F.lit(1), F.array_max(fits))


def has_any(text: Column, words: list[str]) -> Column:
    """Whether any of the words occurs."""
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)) if words else F.lit(False)
