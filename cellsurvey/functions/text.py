"""Column expressions on ids, paths, texts and key/value bags. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellsurvey.functions.fixed_values import SPECIES


def mentions(low: Column, phrases: Sequence[str]) -> Column:
    """True when the lower-cased text holds any phrase, letter case ignored.

    Plain substring search; the phrases hold no pattern characters, so this equals a case-insensitive
    alternation and is much cheaper than a regex on long texts. The caller lowers the text once, in a
    projection of its own.
    """
    hit = F.lit(False)
    for phrase in dict.fromkeys(p.lower() for p in phrases):
        hit = hit | F.contains(low, F.lit(phrase))
    return hit


def strip_lane(run_id: Column) -> Column:
    """Drop the lane part of a run id."""
    return F.regexp_replace(run_id, "_L00[0-9]", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def safe_name(name: Column) -> Column:
    """Cell-type names usable as column and file names."""
    return F.replace(name, F.lit("/"), F.lit("-"))


def strip_chemistry(tech: Column) -> Column:
    """10xv2 -> 10x."""
    return F.regexp_replace(tech, "v[0-9]", "")


def species_of(taxon: Column) -> Column:
    pairs = [F.lit(x) for kv in SPECIES.items() for x in kv]
    return F.element_at(F.create_map(*pairs), taxon.cast("string"))


def id_modulo(text: Column, divisor: int) -> Column:
    """The UTF-8 bytes of an id read as one big integer, modulo ``divisor`` (below 2**55)."""
    code = F.hex(F.encode(text, "UTF-8"))
    byte = lambda i: F.conv(F.substring(code, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")
    positions = F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int"))
    step = lambda acc, i: (acc * 256 + byte(i)) % F.lit(divisor).cast("bigint")
    return F.when(F.length(code) > 0, F.aggregate(positions, F.lit(0).cast("bigint"), step))


def transferred_bytes(line: Column) -> Column:
    """Bytes of a finished transfer, from its ``[done/total]`` log line."""
    return F.regexp_extract(line, r"\[(\d+)/", 1).try_cast("bigint")


def link_texts(html: Column) -> Column:
    """Link texts of a directory listing page."""
    return F.regexp_extract_all(html, F.lit('<a href="[^"]*">([^<]*)</a>'), F.lit(1))


def list_literal(text: Column) -> Column:
    """``"['a', 'b']"`` -> array of strings."""
    return F.split(F.regexp_replace(text, r"^\['|'\]$", ""), "', '")


def text_bag(bag: Column) -> Column:
    """A key/value bag as one canonical string: equal bags give equal strings."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(bag))))


def lookup(value: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Value of the first key contained in ``value``, in table order."""
    expr = None
    for key, result in table.items():
        cond = F.contains(value, F.lit(key))
        expr = F.when(cond, result) if expr is None else expr.when(cond, result)
    return expr.otherwise(F.lit(default))


def url_by_protocol(urls: Column, protocol: str = "http") -> Column:
    """Last url of a comma list that starts with the protocol."""
    return F.try_element_at(F.filter(F.split(urls, ","), lambda u: F.startswith(F.trim(u), F.lit(protocol))), F.lit(-1))


def url_at(urls: Column, position: int = 1) -> Column:
    """Url at a 0-based position of a comma list."""
    return F.get(F.split(urls, ","), F.lit(position))
