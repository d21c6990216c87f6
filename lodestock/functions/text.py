"""Column functions for text cleaning and parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from ..sources.na_values import DEFAULT_NA_VALUES

# Named entities of HTML, from the standard library's table; no-break space becomes a blank.
HTML_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}
ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
LAST_CODE = 0x10FFFF
# Replaced one after the other, the ampersand last so that nothing is decoded twice.
COMMON = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&copy;": "\u00a9", "&middot;": "\u00b7", "&amp;": "&"}
OTHER_ENTITY = f"(?!{'|'.join(COMMON)}){ENTITY}"
# The rest of a tag: quoted values, which may hold ``>``, only after an equals sign.
TAG = r"""(?s)<[!/a-zA-Z](?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Null where the text is empty or white space only."""
    c = _col(c)
    return F.when(c.rlike(r"(?U)^\s*$"), None).otherwise(c)


def na_to_null(c: Column | str, extra: Sequence[str] = (), keep_default: bool = True) -> Column:
    """Null where the text is one of the reader's missing-value tokens."""
    c = _col(c)
    tokens = (list(DEFAULT_NA_VALUES) if keep_default else []) + list(extra)
    return F.when(c.isin(tokens), None).otherwise(c) if tokens else c


def yes_no(c: Column | str, blank: str = "null") -> Column:
    """Yes/No text to boolean under one of four blank policies.

    ``"false"``  only yes is true, all else false;
    ``"null"``   yes true, no false, all else null;
    ``"text"``   no is false, any other text true, null stays null;
    ``"short"``  yes/y true, no/n false, all else false.
    """
    low = F.lower(_col(c))
    if blank == "false":
        return F.coalesce(low == "yes", F.lit(False))
    if blank == "null":
        return F.when(low == "yes", True).when(low == "no", False)
    if blank == "text":
        return F.when(low == "no", False).when(low.isNotNull(), True)
    if blank == "short":
        return F.coalesce(low.isin("yes", "y"), F.lit(False))
    raise ValueError(f"unknown blank policy {blank!r}")


def map_values(c: Column | str, mapping: Mapping[str, str | None], keep_unmapped: bool = True) -> Column:
    """Replace whole values by a small map; a ``None`` target makes null."""
    c = _col(c)
    out = None
    for old, new in mapping.items():
        target = F.lit(new)
        out = F.when(c == old, target) if out is None else out.when(c == old, target)
    if out is None:
        return c
    return out.otherwise(c if keep_unmapped else F.lit(None))


def null_where(c: Column | str, other: Column | str, values: Sequence[object]) -> Column:
    """Null ``c`` on rows where ``other`` is one of ``values``."""
    inside = F.coalesce(_col(other).isin(list(values)), F.lit(False))
    return F.when(~inside, _col(c))


def sentinel_to_null(c: Column | str, sentinels: Sequence[object]) -> Column:
    """Null where the value is an end-of-time or all-zero placeholder."""
    c = _col(c)
    return F.when(~c.isin(list(sentinels)), c)


def html_to_text(c: Column | str) -> Column:
    """Text content of markup: scripts, comments and tags out, entities decoded."""
    out = F.regexp_replace(_col(c), r"(?is)<(script|style)\b.*?</\1\s*>", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, TAG, "")
    return decode_entities(out)


def decode_entities(c: Column | str) -> Column:
    """Named and numeric entities as their characters, each decoded once; unknown ones stay.

    Most texts have only common entities, which plain replacement decodes; the
    look-up in the whole table is for texts with others.
    """
    c = _col(c)
    simple = c
    for entity, sign in COMMON.items():
        simple = F.replace(simple, F.lit(entity), F.lit(sign))
    parts = F.split(c, ENTITY)
    names = F.regexp_extract_all(c, F.lit(ENTITY), F.lit(1))
    plain = F.transform(names, lambda n: F.coalesce(_entity(n), F.concat(F.lit("&"), n, F.lit(";"))))
    joined = F.array_join(F.flatten(F.zip_with(parts, plain, lambda p, e: F.array(p, F.coalesce(e, F.lit(""))))), "")
    return F.when(~c.contains("&"), c).when(c.rlike(OTHER_ENTITY), joined).otherwise(simple)


def _entity(name: Column) -> Column:
    """Character of an entity's name or number; null for none."""
    known = F.map_from_arrays(F.array(*map(F.lit, HTML_ENTITIES)), F.array(*map(F.lit, HTML_ENTITIES.values())))
    is_hex = F.lower(F.substring(name, 2, 1)) == "x"
    code = F.when(is_hex, F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("long")
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= LAST_CODE))
    bytes_ = F.unhex(F.lpad(F.conv(code.cast("string"), 10, 16), 8, "0"))
    number = F.when(code == 160, F.lit(" ")).when(valid, F.decode(bytes_, "UTF-32"))
    return F.when(name.startswith("#"), number).otherwise(F.try_element_at(known, name))


def code_category(rules: Sequence[tuple[Mapping[str, Sequence], object]]) -> Column:
    """Category by codes, first rule first.

    A rule names the codes that its columns may have, and a category or a list of
    rules for the rows it takes; null where a row's rules say nothing.
    """
    out = F.lit(None).cast("string")
    for codes, found in reversed(rules):
        takes = reduce(lambda a, b: a & b, [F.col(c).isin(list(v)) for c, v in codes.items()], F.lit(True))
        out = F.when(takes, F.lit(found) if isinstance(found, str) else code_category(found)).otherwise(out)
    return out


def tokens_every(c: Column | str, sep: str = ", ", span: int = 2, drop_prefix: str | None = None) -> Column:
    """Array of every ``span`` parts joined again, upper case.

    A leading part starting with ``drop_prefix`` is removed first, so that the
    remaining parts pair up.
    """
    c = _col(c)
    parts = F.split(F.upper(c), sep)
    if drop_prefix is not None:
        parts = F.when(c.startswith(drop_prefix), F.slice(parts, 2, F.size(parts))).otherwise(parts)
    starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(span))
    return F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, F.lit(span)), sep))


def listed_after(c: Column | str, marker: str, sep: str = ", ") -> Column:
    """Array of texts, one per item of the list that follows ``marker``.

    Each element is the text up to and with the marker, then one item; texts
    without the marker give a one-element array holding the text itself.
    """
    c = _col(c)
    at = F.instr(c, marker)
    head = F.substring(c, F.lit(1), at + F.lit(len(marker) - 1))
    items = F.split(F.substring(c, at + F.lit(len(marker)), F.length(c)), sep)
    return F.when(at > 0, F.transform(items, lambda item: F.concat(head, item))).otherwise(F.array(c))


def joined_map_values(m: Column | str, missing: str = "None") -> Column:
    """Sorted map values as one comma-joined text; ``missing`` for a null map."""
    return F.coalesce(F.array_join(F.array_sort(F.map_values(_col(m))), ","), F.lit(missing))


def keyword_label(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """First label whose keyword occurs in the text (case-sensitive)."""
    c = _col(c)
    return reduce(lambda acc, kv: acc.when(c.contains(kv[0]), kv[1]), rules[1:], F.when(c.contains(rules[0][0]), rules[0][1]))


def memory_name_parts(c: Column | str) -> Column:
    """Struct (tech, tech2, width) from a product name such as ``8GB DDR4 UDIMM 1Gx8``.

    ``tech`` is the first word that starts with a letter, or the second word;
    of the words from the third on, the last holding an ``x`` gives the width
    and the last other one starting with a letter gives ``tech2``.
    """
    words = F.filter(F.split(_col(c), r"\s+"), lambda w: w != "")
    is_word = lambda w: w.rlike("^[A-Za-z]")
    tech = F.coalesce(F.get(F.filter(words, is_word), F.lit(0)), F.get(words, F.lit(1)))
    rest = F.slice(words, 3, F.greatest(F.size(words), F.lit(1)))
    widths = F.filter(rest, lambda w: w.contains("x"))
    others = F.filter(rest, lambda w: ~w.contains("x") & is_word(w) & (w != tech))
    last = lambda a: F.get(a, F.size(a) - 1)
    tech2 = F.regexp_replace(F.replace(last(others), F.lit("LR/RDIMM"), F.lit("LRDIMM")), "[/-]", "")
    width = F.concat(F.lit("x"), F.regexp_extract(last(widths), r"x([^x]*)$", 1))
    return F.struct(tech.alias("tech"), tech2.alias("tech2"), width.alias("width"))
