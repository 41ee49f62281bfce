"""Text predicates and sanitising as column expressions (PRD-7 to PRD-10, PRD-16, PRD-18 to PRD-23)."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .canon import SPACE, casefold

# Parts of a key that mark private material, and keys that are safe although they hold one.
FORBIDDEN_KEY_PARTS = (
    "access_token", "api_key", "auth", "authorization", "analysis", "cookie", "completion", "credential", "expected", "ground_truth", "hidden_reasoning", "http_body", "oracle",
    "passwd", "password", "private", "provider", "provider_payload", "raw_payload", "raw", "reasoning", "response", "secret", "session", "source_path", "thought", "token",
)
SAFE_KEYS = (
    "provider_id", "response_hashes", "known_input_tokens", "known_output_tokens", "known_total_tokens", "unknown_usage_count", "physical_request_count", "retry_count", "repair_request_count",
    "mutation_authorization",
)
# Patterns and markers of text that mark private material; without look-behind, so any engine's regex can run them.
PATH_START = r"^(/|~)|^[A-Za-z]:[\\/]"
EMBEDDED_PATH = r"(^|[^:/A-Za-z0-9_.-])/([^/]|$)|(^|[^A-Za-z0-9_.-])[A-Za-z]:[\\/]|(^|\s)~[\\/]"
MARKERS = ("/users/", "/private/", "/tmp/", "file://", "authorization:", "api_key", "credential", "passwd", "password", "secret", "access_token")
OPENINGS = ("sk-", "bearer ")
REDACTED = "[redacted]"
# How a text asks not to do something, and what a public identifier looks like.
NEGATION = r"(?i)\b(do\s+not|don't|never|without)\b"
IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9_.:-]{0,127}$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def any_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def forbidden_key(key: Column, low: Column | None = None) -> Column:
    """PRD-8: a lower-cased key that holds a private part; ``low``: the key in lower case, if that is made already."""
    low = F.lower(key) if low is None else low
    return ~low.isin(*SAFE_KEYS) & low.rlike("|".join(FORBIDDEN_KEY_PARTS))


def forbidden_text(text: Column, low: Column | None = None) -> Column:
    """PRD-9: an absolute path at the start or inside, a marker or the opening of a credential.

    Paths have a slash, a backslash or a tilde, so only texts that have one are
    searched for them.  ``low``: the text in lower case, if that is made
    already.
    """
    low = F.lower(text) if low is None else low
    paths = text.contains("/") | text.contains("\\") | text.contains("~")
    return (paths & text.rlike(PATH_START)) | (paths & text.rlike(EMBEDDED_PATH)) | any_of([low.contains(m) for m in MARKERS] + [low.startswith(o) for o in OPENINGS])


@lru_cache(4096)
def is_forbidden_key(key: str) -> bool:
    """forbidden_key() for one key in Python; the same few keys come again and again."""
    low = key.lower()
    return low not in SAFE_KEYS and any(part in low for part in FORBIDDEN_KEY_PARTS)


def is_forbidden_text(text: str) -> bool:
    """forbidden_text() for one text in Python; short ones, as names, come again and again."""
    return _forbidden_short(text) if len(text) <= 200 else _forbidden(text)


def _forbidden(text: str) -> bool:
    low = text.lower()
    paths = "/" in text or "\\" in text or "~" in text
    return (paths and bool(re.search(PATH_START, text) or re.search(EMBEDDED_PATH, text))) or any(m in low for m in MARKERS) or low.startswith(OPENINGS)


_forbidden_short = lru_cache(4096)(_forbidden)


def sanitized(text: Column) -> Column:
    """PRD-10 for a string: redacted where forbidden; null stays null."""
    return F.when(forbidden_text(text), F.lit(REDACTED)).otherwise(text)


def sanitized_within(text: Column) -> Column:
    """sanitized() inside a function of arrays, where nothing shares work: lower case is made once for all markers."""
    return let(F.lower(text), lambda low: F.when(forbidden_text(text, low), F.lit(REDACTED)).otherwise(text))


def sanitized_map(payload: Column) -> Column:
    """PRD-10 for a flat map: forbidden keys go, forbidden values are redacted."""
    public = F.map_filter(payload, lambda k, v: let(F.lower(k), lambda low: ~forbidden_key(k, low)))
    return F.transform_values(public, lambda k, v: sanitized_within(v))


def single_line(text: Column, low: int, high: int) -> Column:
    """Trimmed, ``low`` to ``high`` characters, without line breaks; only the first and the last character are looked at for space."""
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.length(text).between(low, high) & ~ends.rlike(SPACE) & ~F.contains(text, F.lit("\r")) & ~F.contains(text, F.lit("\n"))


def opening(text: Column) -> Column:
    """The case-folded first characters of ``text``: folding goes letter by letter, so they are those of the folded text."""
    return casefold(F.substring(text, 1, 16))


def note_allowed(text: Column) -> Column:
    """PRD-18."""
    return single_line(text, 3, 160)


def reply_allowed(text: Column) -> Column:
    """PRD-19."""
    low = opening(text)
    return single_line(text, 3, 240) & (low.startswith("thanks") | low.startswith("thank you") | low.startswith("hello") | low.startswith("hi "))


def title_allowed(text: Column) -> Column:
    """PRD-20."""
    low = opening(text)
    return single_line(text, 12, 120) & (low.startswith("prepare ") | low.startswith("review ") | low.startswith("create "))


def comment_allowed(text: Column) -> Column:
    """PRD-21."""
    return single_line(text, 12, 240) & opening(text).startswith("status:")


def negated_action(action: Column) -> Column:
    """PRD-22."""
    low = F.replace(casefold(action), F.lit("-"), F.lit("_"))
    return low.rlike("^(do_not_|dont_|never_|not_|without_)") | low.contains("_not_") | low.endswith("_not")


def negated_text(text: Column) -> Column:
    """PRD-23."""
    return text.rlike(NEGATION)


def safe_identifier(text: Column) -> Column:
    """PRD-16: the identifier pattern, and nothing that looks like a credential."""
    low = F.lower(text)
    return text.rlike(IDENTIFIER) & ~low.startswith("sk-") & ~low.startswith("bearer") & ~low.contains("secret")
