"""HTML text expressions: tags without comments and scripts, attributes, character references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.functions.coerce import let

# Elements whose content is no markup, and the named references that occur in links.
RAW_ELEMENTS = ("script", "style", "textarea", "title", "xmp")
REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}

# The rest of a tag: quoted values may hold its closing bracket. Possessive loops run without recursion.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+"""
_ATTRIBUTE = r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?"""


def markup_only(html: Column) -> Column:
    """The page without comments and without the content of raw elements."""
    raw = "|".join(RAW_ELEMENTS)
    return F.regexp_replace(html, rf"(?is)<!--.*?(?:-->|\z)|<({raw})(?=[\s/>]){_REST}>.*?(?:</\1\s*>|\z)", " ")


def tags(markup: Column, name: str) -> Column:
    """The opening tags of one element, in page order."""
    return F.regexp_extract_all(markup, F.lit(rf"(?i)<{name}(?=[\s/]){_REST}>"), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name as written, without its quotes; null without one."""
    pairs = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+|>$", " "), F.lit(_ATTRIBUTE), F.lit(0))
    named = F.filter(pairs, lambda p: p.rlike(rf"(?i)^{name}\s*="))
    value = F.regexp_replace(F.get(named, F.lit(0)), r"^[^=]*=\s*", "")
    return F.regexp_replace(value, r"""^(["'])([\s\S]*)\1$""", "$2")


def decoded_references(text: Column) -> Column:
    """Numeric references and the usual named ones as characters; others stay as written."""

    def reference(part: Column, name: Column) -> Column:
        point = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2)))

        def character(point: Column) -> Column:
            # Beyond the last code point, and for halves of a pair, there is none. A code point is four bytes of UTF-32.
            valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
            found = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
            for known, written in REFERENCES.items():
                found = F.when(name == known, F.lit(written)).otherwise(found)
            return F.coalesce(F.concat(found, F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))

        return let(point.cast("long"), character)

    def decoded(part: Column, place: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-z]+)(?=;)", 1)
        return F.when(place == 0, part).otherwise(let(name, lambda n: reference(part, n)))

    return F.array_join(F.transform(F.split(text, "&", -1), decoded), "")
