"""Text rules for titles and links."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkrank import constants as C

# A run of numeric entities, one named entity, plain text, or a lone ampersand.
# The possessive run keeps the regex engine iterative on long runs.
_TOKEN_PATTERN = r"((?:&#\w+;)++|&\w+;|[^&]+|&)"

# UTF-16 units in hex, separated by blanks: half of a pair whose other half is missing.
_LONE_SURROGATE = r"\bD[89AB]..\b(?! D[C-F]..\b)|(?<!\bD[89AB].. )\bD[C-F]..\b"
_QUESTION_MARK = "003F"


def _named_entities() -> Column:
    """The HTML 4 entities, the four of XML markup first since lookups walk the map.

    Parsed from one literal, which the optimizer folds into a constant.
    """
    names = dict.fromkeys(("amp", "quot", "lt", "gt", *name2codepoint))
    entities = {f"&{name};": chr(name2codepoint[name]) for name in names}
    return F.from_json(F.lit(json.dumps(entities)), "map<string,string>")


def _utf16(entity: Column) -> Column:
    """One numeric entity as hex UTF-16; one that names no 16-bit unit stays as its text."""
    decimal = F.regexp_extract(entity, r"^&#0*([0-9]{1,5});$", 1).try_cast("int")
    digits = F.regexp_extract(entity, r"^&#[xX]0*([0-9A-Fa-f]{1,4});$", 1)
    unit = F.coalesce(decimal, F.conv(F.nullif(digits, F.lit("")), 16, 10).try_cast("int"))
    return F.when(unit <= 0xFFFF, F.lpad(F.hex(unit), 4, "0")).otherwise(
        F.hex(F.encode(entity, "UTF-16BE"))
    )


def _numeric_run(run: Column) -> Column:
    """Adjacent numeric entities decode together, as two of them may form one character."""
    entities = F.regexp_extract_all(run, F.lit(r"(&#\w+;)"), F.lit(1))
    units = F.array_join(F.transform(entities, _utf16), " ")
    whole = F.regexp_replace(units, _LONE_SURROGATE, _QUESTION_MARK)
    return F.decode(F.unhex(F.replace(whole, F.lit(" "), F.lit(""))), "UTF-16BE")


def unescape_entities(text: Column) -> Column:
    """Decode HTML 4 entities in one pass: ``&amp;lt;`` becomes ``&lt;``.

    Unknown names, broken numbers and numbers above U+FFFF stay as they are.
    """
    entities = _named_entities()

    def decoded(token: Column) -> Column:
        return (
            F.when(F.startswith(token, F.lit("&#")), _numeric_run(token))
            .when(F.startswith(token, F.lit("&")), F.coalesce(F.try_element_at(entities, token), token))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN_PATTERN), F.lit(1))
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, decoded), "")
    ).otherwise(text)


def normalize_title(text: Column) -> Column:
    """The form in which titles and link targets are compared."""
    return F.replace(unescape_entities(text), F.lit(" "), F.lit("_"))


def link_spans(text: Column, pattern: str) -> Column:
    """Every raw link in ``text`` that ``pattern`` captures, in order, as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def wiki_link_spans(body: Column) -> Column:
    """Every raw link in a wiki body.

    What follows the last closing mark holds no link. If links open there it is left out,
    or each of them would send the pattern to the end of the text in vain.
    """
    rest = F.substring_index(body, C.LINK_END, -1)
    closed = F.left(body, F.length(body) - F.length(rest))
    return link_spans(
        F.when(F.contains(rest, F.lit(C.LINK_START)), closed).otherwise(body), C.WIKI_LINK_PATTERN
    )


def link_target(link: Column) -> Column:
    """A raw link without its label and section."""
    return F.substring_index(F.substring_index(link, C.LABEL_MARK, 1), C.SECTION_MARK, 1)


def page_links(body: Column) -> Column:
    """Link targets of a wiki body as an array, normalised, repeats kept.

    Links with a colon lead to files, categories and the like; the test comes
    before the label is cut off, and entities are decoded last.
    """
    plain = F.filter(
        wiki_link_spans(body), lambda link: ~F.contains(link, F.lit(C.SPECIAL_LINK_MARK))
    )
    targets = F.filter(F.transform(plain, link_target), lambda target: target != "")
    return F.transform(targets, normalize_title)
