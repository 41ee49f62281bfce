"""Parsed JSON payloads: types, fields and their sets (2.8, PRD-13 to PRD-15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with ``columns`` that are made once for a row.

    The optimizer puts a column's expression into the filters and columns that
    use it, each time anew; what a generator makes it leaves alone.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


class Payload:
    """Conditions over a column of JSON text.

    A text that isn't JSON has no value; fields are those of an object, and a
    string field is null where the field is missing or has another type.  The
    parser ignores what follows a value, so a text is JSON if it is a value in
    an array of one as well as in an object.  Of a key that repeats the last
    value counts, given the setting that session.ship() makes.
    """

    def __init__(self, content: Column | None, value: Column | None = None, fields: Column | None = None, texts: Column | None = None) -> None:
        """``value``, ``fields`` and ``texts``: those of a Payload in columns of their own (see read()), which are then made once for all conditions."""
        self.value = self._parsed(content) if value is None else value
        self.broken = self.value.isNull()
        self.fields = F.try_variant_get(self.value, "$", "map<string,variant>") if fields is None else fields
        self.texts = F.transform_values(self.fields, lambda _, v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))) if texts is None else texts
        self.object = self.fields.isNotNull()

    @classmethod
    def read(cls, rows: DataFrame, content: Column, name: str = "__p", value: Column | None = None) -> tuple[DataFrame, Payload, list[str]]:
        """``rows`` with the payload of ``content`` (or the given ``value``) in columns, the conditions over these, and the columns' names.

        They are made once, whatever the number of conditions.
        """
        names = [name, f"{name}_fields", f"{name}_texts"]
        at = once(rows, **{names[0]: cls(content, value).value})
        at = once(at, **{names[1]: cls(None, F.col(names[0])).fields})
        at = once(at, **{names[2]: cls(None, F.col(names[0]), F.col(names[1])).texts})
        return at, cls(None, *[F.col(n) for n in names]), names

    @staticmethod
    def _parsed(content: Column) -> Column:
        one = F.try_parse_json(F.concat(F.lit("["), content, F.lit("]")))
        field = F.try_parse_json(F.concat(F.lit('{"v":'), content, F.lit("}")))
        # Without a bracket of its own, a text can't end the array before its end.
        whole = F.when(F.contains(content, F.lit("]")), field.isNotNull()).otherwise(True)
        single = F.try_variant_get(one, "$[1]", "variant").isNull() & whole
        return F.when(single, F.try_variant_get(one, "$[0]", "variant"))

    def get(self, name: str) -> Column:
        """The field as a variant; null where it is missing."""
        return F.try_element_at(self.fields, F.lit(name))

    def type_of(self, name: str) -> Column:
        """The field's type as of schema_of_variant; null where it is missing."""
        return F.schema_of_variant(self.get(name))

    def has(self, name: str) -> Column:
        return F.coalesce(F.map_contains_key(self.fields, name), F.lit(False))

    def text(self, name: str) -> Column:
        return F.try_element_at(self.texts, F.lit(name))

    def true(self, name: str) -> Column:
        return F.coalesce((self.type_of(name) == "BOOLEAN") & F.try_variant_get(self.get(name), "$", "boolean"), F.lit(False))

    def equals(self, name: str, value: Column) -> Column:
        """Whether the field is the string ``value``; a null ``value`` asks for a field that is missing or null."""
        return F.when(value.isNull(), self.get(name).isNull() | F.is_variant_null(self.get(name))).otherwise(self.text(name).eqNullSafe(value))

    def keys(self) -> Column:
        """The names of an object's fields, sorted; null for anything else."""
        return F.sort_array(F.map_keys(self.fields))

    def only(self, *names: str) -> Column:
        """Whether the object has these fields and no others."""
        held = [F.map_contains_key(self.fields, n) for n in names]
        return F.coalesce(reduce(lambda a, b: a & b, held, F.size(self.fields) == len(names)), F.lit(False))


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    """The reason of the first condition that holds; null if none does."""
    out = F.lit(None).cast("string")
    for condition, reason in reversed(checks):
        out = F.when(F.coalesce(condition, F.lit(False)), reason).otherwise(out)
    return out
