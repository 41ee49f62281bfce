"""Canonical JSON, hashes and Unicode-aware text functions as column expressions (2.8, HP-7, HP-8, HP-10)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's strip() knows it.
SPACE = "[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
# JSON's short escapes.
SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


# Unicode's full case folding, by rule: single letters, and letters that fold to several.
_FOLDS = {c: c.casefold() for c in map(chr, (k for k in range(sys.maxunicode + 1) if not 0xD800 <= k < 0xE000)) if c.casefold() != c}
_SINGLE = [(c, f) for c, f in _FOLDS.items() if len(f) == 1]
_SEVERAL = {c: f for c, f in _FOLDS.items() if len(f) > 1 and c != "ß"}


def casefold(text: Column) -> Column:
    """2.8: full Unicode case folding; plain ASCII, the common case, is only lowered."""
    letters = F.replace(F.translate(text, *["".join(x) for x in zip(*_SINGLE, strict=True)]), F.lit("ß"), F.lit("ss"))
    wide = F.str_to_map(F.lit("\x02".join(f"{c}\x01{f}" for c, f in _SEVERAL.items())), F.lit("\x02"), F.lit("\x01"))
    spelled = lambda t: F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(wide, c), c)), "")
    folded = F.transform(F.array(letters), lambda t: F.when(t.rlike("[" + "".join(_SEVERAL) + "]"), spelled(t)).otherwise(t))[0]
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", "")


def holds(text: Column, value: Column) -> Column:
    """SQ-11: whether ``text`` has ``value`` in it, whatever the case; false where either is null."""
    return F.coalesce(F.contains(casefold(text), casefold(value)), F.lit(False))


def json_string(text: Column) -> Column:
    """A JSON string in ASCII; ``null`` for null."""

    def escaped(c: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", "\\\\u$1")
        out = F.when(c.rlike("^[\\x20-\\x7e]\\z"), c).otherwise(units)
        for raw, short in SHORT.items():
            out = F.when(c == raw, short).otherwise(out)
        return out

    plain = text.rlike("^[\\x20-\\x7e]*\\z") & ~F.contains(text, F.lit("\\")) & ~F.contains(text, F.lit('"'))
    body = F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escaped), ""))
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit("null"))


def canonical(fields: dict[str, Column], nested: tuple[str, ...] = ()) -> Column:
    """1.5: a JSON object of string values with sorted keys, without spaces, in ASCII; values of ``nested`` are JSON already."""
    parts = [F.concat(F.lit(("," if k else "{") + f'"{name}":'), F.coalesce(fields[name], F.lit("null")) if name in nested else json_string(fields[name])) for k, name in enumerate(sorted(fields))]
    return F.concat(*parts, F.lit("}"))


def spaced(fields: dict[str, Column]) -> Column:
    """The same for people, with spaces after ``:`` and ``,``; fields that are null are left out."""
    parts = [F.when(fields[name].isNotNull(), F.concat(F.lit(f'"{name}": '), json_string(fields[name]))) for name in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def canonical_array(*values: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *[json_string(v) for v in values]), F.lit("]"))


def sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def semantic_key(domain: str, record: Column) -> Column:
    return F.concat(F.lit(f"{domain}:semantic:sha256:"), sha(record))


def evidence(kind: Column | str, record: Column) -> Column:
    """HP-10: what a change is evidence of."""
    return F.concat(F.lit(kind) if isinstance(kind, str) else kind, F.lit(":sha256:"), sha(record))


def group_id(kind: str, fingerprint: Column, value: Column) -> Column:
    """HP-8: a diagnostic group that doesn't show its value."""
    return F.concat(F.lit(f"{kind}:sha256:"), sha(F.concat(F.lit(f"{kind}:"), fingerprint, F.lit(":"), value)))


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def numbered_id(kind: str, run_id: Column, sequence: Column) -> Column:
    """1.5: ``episode_{run}_{sequence}``, at least four digits."""
    return F.format_string(f"{kind}_%s_%04d", run_id, sequence)
