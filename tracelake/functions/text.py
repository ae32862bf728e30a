"""Text functions as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The answer that stands for "nothing to do", and the words that mark an unfinished section.
NO_ACTION_ITEMS = "No action items identified"
PLACEHOLDERS = ["TODO", "FILL ME IN", "<!-- replace"]


def words(text: Column) -> Column:
    """Whitespace-separated words; an empty text has none."""
    return F.regexp_extract_all(text, F.lit(r"(\S+)"), 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def render_mustache(template: str | Column, variables: Mapping[str, Column] | Column) -> Column:
    """Fill ``{{name}}`` in one pass, so a filled-in value is never read as a template again.

    A variable without a value becomes empty; a name that is not a variable is left as written.
    """
    if isinstance(template, str) and isinstance(variables, Mapping):
        pieces = []
        for piece in re.split(r"(\{\{\s*\w+\s*\}\})", template):
            name = piece.strip("{} ") if piece.startswith("{{") else None
            if name is not None and name in variables:
                pieces.append(F.coalesce(variables[name].cast("string"), F.lit("")))
            elif piece:
                pieces.append(F.lit(piece))
        return F.concat(*pieces) if pieces else F.lit("")
    if isinstance(variables, Mapping):
        variables = F.create_map(*[x for k, v in variables.items() for x in (F.lit(k), v.cast("string"))])
    return _fill(F.lit(template) if isinstance(template, str) else template, variables, "{{", "}}")


def render_braces(template: str | Column, fields: Mapping[str, Column]) -> Column:
    """Fill ``{field}``. With a fixed template an unknown field is an error, as in string formatting."""
    if isinstance(template, str):
        pieces = []
        for piece in re.split(r"(\{\w+\})", template):
            if re.fullmatch(r"\{\w+\}", piece):
                pieces.append(F.coalesce(fields[piece[1:-1]].cast("string"), F.lit("")))
            elif piece:
                pieces.append(F.lit(piece))
        return F.concat(*pieces) if pieces else F.lit("")
    values = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])
    return _fill(template, values, "{", "}")


def _fill(template: Column, values: Column, opening: str, closing: str) -> Column:
    parts = F.split(template, re.escape(opening))

    def fill(part: Column) -> Column:
        name = F.trim(F.substring_index(part, closing, 1))
        rest = F.substring(part, F.length(F.substring_index(part, closing, 1)) + len(closing) + 1, F.length(part))
        known = part.contains(closing) & F.map_contains_key(values, name)
        filled = F.concat(F.coalesce(F.try_element_at(values, name), F.lit("")), rest)
        return F.when(known, filled).otherwise(F.concat(F.lit(opening), part))

    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), fill)
    return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))


def join_context(messages: Column) -> Column:
    return F.array_join(messages, "\n")


def join_bodies(results: Column) -> Column:
    """Bodies of web results separated by a blank line; a result without a body counts as empty."""
    return F.array_join(F.transform(results, lambda r: F.coalesce(r["body"], F.lit(""))), "\n\n")


def dedupe_keep_order(items: Column) -> Column:
    return F.array_distinct(items)


def parse_action_items(text: Column, legacy: bool = True) -> Column:
    """Action items of a list answer, in order, without repeats.

    ``legacy`` splits at every hyphen, also inside words; otherwise only at a hyphen that starts a line.
    """
    pattern = "-" if legacy else r"(?m)^\s*-\s+"
    items = F.transform(F.split(F.trim(text), pattern), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    parsed = F.array_distinct(F.filter(items, lambda x: x != ""))
    return F.when(text.contains(NO_ACTION_ITEMS), F.array().cast("array<string>")).otherwise(parsed)


def join_items(items: Column) -> Column:
    return F.array_join(items, "\n")


def split_items(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def word_chunks(text: Column, size: int = 500) -> Column:
    """Array of chunks of ``size`` words, each joined by single spaces; the whole text is covered.

    The chunks are cut by one pattern, so no array of single words is built. Possessive quantifiers never backtrack.
    """
    runs = F.regexp_extract_all(text, F.lit(rf"((?:\S++\s*+){{1,{size}}})"), 1)
    return F.transform(runs, lambda run: F.rtrim(F.regexp_replace(run, r"\s+", " ")))


def ellipsis(text: Column, length: int, only_if_longer: bool) -> Column:
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, cut).otherwise(text) if only_if_longer else cut


def escape_pipes(text: Column) -> Column:
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def http_links(links: Column) -> Column:
    """Links whose address starts with ``http``; nothing after that prefix is looked at."""
    return F.map_filter(links, lambda _, url: F.coalesce(url.startswith("http"), F.lit(False)))


def links_cell(links: Column) -> Column:
    entries = F.transform(
        F.map_entries(http_links(links)),
        lambda e: F.concat(F.lit("["), escape_pipes(e["key"]), F.lit("]("), escape_pipes(e["value"]), F.lit(")")),
    )
    return F.coalesce(F.array_join(entries, "<br>"), F.lit(""))


def format_amount(value: Column, digits: int) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, digits))


def format_metric(key: Column, value: Column) -> Column:
    """Cost to two decimals with a dollar sign, every other metric as a whole number."""
    return F.when(key == "TOTAL_COST", format_amount(value, 2)).otherwise(F.format_number(value, 0))


def markdown_sections(text: Column) -> Column:
    """Map of second-level heading to trimmed body; the last of two equal headings wins."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    parts = F.split(unix, r"(?m)^##[ \t]+")
    sections = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda part: F.struct(
            F.trim(F.regexp_extract(part, r"\A([^\n]*)", 1)).alias("heading"),
            F.regexp_replace(F.regexp_extract(part, r"(?s)\A[^\n]*\n?(.*)", 1), r"\A\s+|\s+\z", "").alias("body"),
        ),
    )
    return F.map_from_entries(sections)


def is_placeholder(body: Column) -> Column:
    lowered = F.lower(body)
    found = body == ""
    for token in PLACEHOLDERS:
        found = found | lowered.contains(token.lower())
    return found


def valid_slug(name: Column) -> Column:
    return name.rlike(r"^[a-z0-9]+(?:_[a-z0-9]+)+$")


def registry_url(base: Column, workspace: Column, name: Column, version: Column) -> Column:
    return F.concat_ws("/", base, workspace, F.lit("model-registry"), name, version)


def rule_label(tag: Column, days: Column) -> Column:
    return F.format_string("tag='%s', >%dd old", tag, days)


def score_name(column_id: Column) -> Column:
    return F.regexp_replace(column_id, r"^feedback_scores\.", "")
