"""Records whose shape nobody has declared: found by an aggregate, then flattened to columns.

The shape of a column of records is the merge of the shapes of its cells. Where a member is an object in some
cells and something else in others, both are kept: the merge is taken again of either part of such members, all of one depth
in one pass, until nothing is left unknown.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.nested import MONEY, json_tokens

_UNKNOWN = "VARIANT"
_VOID = "VOID"


@dataclass
class Shape:
    """What a member was found to be: an object with members, a value of some type, or both."""

    members: dict[str, Shape] = field(default_factory=dict)
    kind: str | None = None

    def unknown(self, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
        """Paths of the members that are still of mixed kinds."""
        if self.kind == _UNKNOWN and not self.members:
            yield path
        for name, member in self.members.items():
            yield from member.unknown((*path, name))

    def at(self, path: Sequence[str]) -> Shape:
        return self.members[path[0]].at(path[1:]) if path else self


_WORD = re.compile(r"`(?:[^`]|``)*`|[^\s<>:,()]+|[<>:,()]")


def parsed_shape(text: str) -> Shape:
    """A shape as Spark spells it: ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``."""
    words = _WORD.findall(text)

    def shape(at: int) -> tuple[Shape, int]:
        if words[at] == "OBJECT":
            found, at = Shape(), at + 2
            while words[at] != ">":
                name = words[at]
                name = name[1:-1].replace("``", "`") if name.startswith("`") else name
                found.members[name], at = shape(at + 2)
                at += words[at] == ","
            return found, at + 1
        end, depth = at + 1, 0
        while end < len(words) and (words[end] in "<(" or depth):
            depth += (words[end] in "<(") - (words[end] in ">)")
            end += 1
        return Shape(kind="".join(w + " " * (w in ":,") for w in words[at:end])), end

    return shape(0)[0]


def strict_json(c: Column | str) -> Column:
    """Python-style record text as strict JSON: quotes, escapes, ``None``, ``True`` and ``False``."""

    def quoted(token: Column) -> Column:
        inside = F.substr(token, F.lit(2), F.length(token) - 2)
        inside = F.regexp_replace(F.replace(inside, F.lit("\\'"), F.lit("'")), r'(?<!\\)"', r'\\"')
        return F.concat(F.lit('"'), F.regexp_replace(inside, r"\\x([0-9a-fA-F]{2})", r"\\u00$1"), F.lit('"'))

    fixed = F.transform(json_tokens(c), lambda t: F.when(t.startswith("'"), quoted(t)).otherwise(t))
    return F.array_join(fixed, "")


def as_variant(df: DataFrame, name: str) -> DataFrame:
    """The text cells of a column as variants: JSON, else a Python-style literal, else null."""
    cell = F.col(f"`{name}`")
    read = df.withColumn("_strict", F.try_parse_json(cell))
    literal = F.when(F.col("_strict").isNull() & cell.isNotNull(), F.try_parse_json(strict_json(cell)))
    return read.withColumn(name, F.coalesce("_strict", literal)).drop("_strict")


def _path(names: Sequence[str]) -> str:
    """A variant path; a name with both kinds of quotes cannot be written."""
    if any("'" in n and '"' in n for n in names):
        raise ValueError(f"no path leads to {'.'.join(names)}")
    return "$" + "".join(f"['{n}']" if "'" not in n else f'["{n}"]' for n in names)


def discovered(df: DataFrame, name: str) -> Shape:
    """The shape of a variant column, by one aggregate per depth of mixed members."""
    root = Shape(kind=_UNKNOWN)
    waiting: list[tuple[str, ...]] = [()]
    while waiting:
        asked = []
        for path in waiting:
            value = F.try_variant_get(F.col(f"`{name}`"), _path(path), "variant")
            is_object = F.schema_of_variant(value).startswith("OBJECT")
            asked += [F.schema_of_variant_agg(F.when(is_object, value)), F.schema_of_variant_agg(F.when(~is_object, value))]
        found = df.agg(*[a.alias(f"_{k}") for k, a in enumerate(asked)]).first()
        following = []
        for k, path in enumerate(waiting):
            here, objects, others = root.at(path), parsed_shape(found[2 * k]), parsed_shape(found[2 * k + 1])
            here.members = objects.members
            here.kind = None if others.kind == _VOID else "STRING" if others.kind == _UNKNOWN else others.kind
            for member, shape in here.members.items():
                following += shape.unknown((*path, member))
        waiting = following
    return root


def _type_of(kind: str) -> str:
    """The type a value is read as: numbers with a point are doubles, as report readers make them."""
    plain = re.sub(r"DECIMAL\([^)]*\)|FLOAT", "DOUBLE", kind).replace("OBJECT<", "STRUCT<").replace(_VOID, "STRING")
    return "STRING" if plain == _UNKNOWN else plain


def _leaves(shape: Shape, at: Column, path: tuple[str, ...], found: dict[str, list[tuple[Column, str]]]) -> None:
    for name, member in shape.members.items():
        here = (*path, name)
        if member.kind is not None:
            value, kind = _value(member.kind, at, here)
            if member.members:
                is_object = F.schema_of_variant(F.try_variant_get(at, _path(here), "variant")).startswith("OBJECT")
                value = F.when(~is_object, value)
            found.setdefault(name, []).append((value, kind))
        if MONEY <= set(member.members):
            amount = member.members["amount"]
            found.setdefault(name, []).append(_value(amount.kind or "STRING", at, (*here, "amount")))
        elif member.members:
            _leaves(member, at, here, found)


def _value(kind: str, at: Column, path: Sequence[str]) -> tuple[Column, str]:
    wanted = _type_of(kind)
    if _UNKNOWN in wanted:
        # Lists with members of many kinds stay as text.
        return F.to_json(F.try_variant_get(at, _path(path), "variant")), "STRING"
    return F.try_variant_get(at, _path(path), wanted), wanted


def _last(candidates: list[tuple[Column, str]]) -> Column:
    """The last value there is, in a type that holds them all."""
    kinds = {k for _, k in candidates}
    common = kinds.pop() if len(kinds) == 1 else "DOUBLE" if kinds <= {"BIGINT", "DOUBLE"} else "STRING"
    return F.coalesce(*(c.cast(common) for c, _ in reversed(candidates)))


def flatten_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the listed record columns, text or variant, by the leaves found in them.

    A money object stands for its amount under its own name; other objects are inlined without a prefix; lists stay.
    Of leaves with one name a record has the last it holds, objects' members in the order of their names. Other
    columns come first; a leaf with the name of one takes its place.
    """
    result = {c: F.col(f"`{c}`") for c in df.columns if c not in columns}
    for name in columns:
        if df.schema[name].dataType.typeName() == "string":
            df = as_variant(df, name)
        found: dict[str, list[tuple[Column, str]]] = {}
        _leaves(discovered(df, name), F.col(f"`{name}`"), (), found)
        result.update({leaf: _last(candidates) for leaf, candidates in found.items()})
    return df.select(*[c.alias(n) for n, c in result.items()])
