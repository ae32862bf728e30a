"""JSON, map and span-attribute functions as Column expressions."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.dates import is_uuid7

# Attribute names of the public OpenTelemetry GenAI convention.
MODEL_ATTRIBUTES = ["gen_ai.request.model", "gen_ai.response.model"]
PROVIDER_ATTRIBUTE = "gen_ai.system"
USAGE_PREFIX = "gen_ai.usage."
COST_ATTRIBUTE = "gen_ai.usage.cost"
METADATA_PREFIXES = ["gen_ai.tool.", "gen_ai.agent."]


def json_path(roots: Mapping[str, Column], path: str) -> Column:
    """Value at a dotted path whose first part names a JSON column, such as ``input.question``."""
    root, _, rest = path.partition(".")
    return F.get_json_object(roots[root], f"$.{rest}") if rest else roots[root]


def json_path_of(roots: Mapping[str, Column], path: Column, maps: Collection[str] = ()) -> Column:
    """``json_path`` for a path that differs per row. Roots named in ``maps`` are text maps, whose keys may hold dots."""
    root = F.substring_index(path, ".", 1)
    found = F.expr("null").cast("string")
    for name, column in roots.items():
        rest = F.substring(path, F.lit(len(name) + 2), F.length(path))
        whole = F.to_json(column) if name in maps else column
        inner = F.try_element_at(column, rest) if name in maps else F.call_function("get_json_object", column, F.concat(F.lit("$."), rest))
        found = F.when(root == name, F.when(path == name, whole).otherwise(inner)).otherwise(found)
    return found


def with_json_values(df: DataFrame, out: str, roots: Mapping[str, Column], paths: Sequence[str], maps: Collection[str] = ()) -> DataFrame:
    """Adds the texts at paths known beforehand as one array ``out``. Each JSON root is parsed once: for its only path, or into a
    struct of just the fields asked for.

    Values that are no text come as their JSON text. A path that leads on from another one, is indexed or differs from another
    one in case only is read on its own; an unknown root gives null. Roots named in ``maps`` are text maps.
    """
    split = {path: (path.partition(".")[0], path.partition(".")[2].split(".")) for path in paths}
    trees: dict[str, dict] = {}
    fields = [
        path for path, (root, parts) in split.items()
        if root in roots and root not in maps and "[" not in path and _grow(trees.setdefault(root, {}), parts)
    ]
    shared = [root for root in trees if sum(split[path][0] == root for path in fields) > 1]

    def value(path: str) -> Column:
        root, parts = split[path]
        if root not in roots:
            return F.lit(None).cast("string")
        if root in maps:
            return F.try_element_at(roots[root], F.lit(".".join(parts))) if path != root else F.to_json(roots[root])
        if path in fields and root in shared:
            return reduce(lambda struct, part: struct[part], parts, F.col(f"`__json_{root}`"))
        return json_path(roots, path)

    # A projection of their own: inside one expression each field would be parsed for by itself.
    parsed = df.withColumns({f"__json_{root}": F.from_json(roots[root], _struct_of(trees[root])) for root in shared})
    return parsed.withColumn(out, F.array(*[value(path) for path in paths]).cast("array<string>")).drop(*[f"__json_{root}" for root in shared])


def _grow(tree: dict, parts: list[str]) -> bool:
    """Add a path to a tree of field names unless it meets one that ends or goes on where it does not."""
    name, rest = parts[0], parts[1:]
    if not name or any(other != name and other.lower() == name.lower() for other in tree):
        return False
    if name not in tree:
        below: dict = {}
        if rest and not _grow(below, rest):
            return False
        tree[name] = below
        return True
    return bool(rest and tree[name]) and _grow(tree[name], rest)


def _struct_of(tree: dict) -> T.DataType:
    return T.StructType([T.StructField(name, _struct_of(below)) for name, below in tree.items()]) if tree else T.StringType()


def pluck(items: Column, field: str) -> Column:
    return F.transform(items, lambda item: item[field])


def merge_metadata(old: Column, new: Column) -> Column:
    """Right side wins. Works under any key policy because repeated keys never meet."""
    empty = F.create_map().cast("map<string,string>")
    kept = F.map_filter(F.coalesce(old, empty), lambda k, _: ~F.map_contains_key(F.coalesce(new, empty), k))
    return F.map_concat(kept, F.coalesce(new, empty))


def encode_attribute(value: Column) -> Column:
    """JSON text of a structured value; attribute values must be primitive."""
    return F.to_json(value)


def json_scalar(text: Column, kind: Column) -> Column:
    """Judge value as a number: booleans become 1 or 0, anything else that is not a number of its kind becomes null."""
    number = text.try_cast("double")
    flag = F.when(text == "true", 1.0).when(text == "false", 0.0)
    return F.when(kind == "BOOLEAN", flag).when(kind == "INTEGER", F.when(number == F.floor(number), number)).otherwise(number)


def image_part(url: Column) -> Column:
    """Kind, media type and bytes of an image reference: an address, or inline base64 data."""
    pattern = r"^data:([^;,]+);base64,(.*)$"
    inline = url.rlike(pattern)
    return F.struct(
        F.when(inline, "data").when(url.startswith("http"), "url").alias("kind"),
        F.when(inline, F.regexp_extract(url, pattern, 1)).alias("mime"),
        F.when(inline, F.unbase64(F.regexp_extract(url, pattern, 2))).alias("bytes"),
    )


def content_parts(text: Column, image: Column) -> Column:
    """Message content as a text part followed by an image part."""
    return F.array(
        F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("image_url")),
        F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), image.alias("image_url")),
    )


def _names(attributes: Column) -> Column:
    """All attribute names in one text, each after a line feed, which tells what a map may hold without a lambda."""
    return F.concat(F.lit("\n"), F.array_join(F.map_keys(attributes), "\n"))


def _side(attributes: Column, name: str) -> Column:
    """The attribute ``name`` itself, else the attributes that start with it as one JSON object.

    Most spans have none, which their names tell at once; only the others are filtered by a lambda.
    """
    several = F.map_filter(attributes, lambda k, _: k.startswith(name))
    some = _names(attributes).contains(f"\n{name}")
    return F.coalesce(attributes[name], F.when(some, F.when(F.size(several) > 0, F.to_json(several))))


def grouped_attributes(attributes: Column, vendor: str) -> Column:
    """The attributes that go into usage or metadata, found in one pass over the map."""
    prefixes = [USAGE_PREFIX, *METADATA_PREFIXES, f"{vendor}.metadata."]
    return F.map_filter(attributes, lambda k, _: reduce(lambda some, prefix: some | k.startswith(prefix), prefixes[1:], k.startswith(prefixes[0])))


def map_span_attributes(attributes: Column, vendor: str, grouped: Column | None = None) -> dict[str, Column]:
    """Columns of a span read from its flat attributes; ``vendor`` is the prefix of the platform's own attributes.

    A model makes the span an ``llm`` span, everything else is ``general``: no attribute makes a tool span. ``grouped`` is
    a column that holds ``grouped_attributes`` already, so that usage and metadata read the few entries there only.
    """
    model = F.coalesce(*[attributes[name] for name in MODEL_ATTRIBUTES])
    cut = len(USAGE_PREFIX) + 1
    entries = attributes if grouped is None else grouped
    counts = F.filter(F.map_entries(entries), lambda e: e["key"].startswith(USAGE_PREFIX) & (e["key"] != COST_ATTRIBUTE) & e["value"].try_cast("long").isNotNull())
    usage = F.map_from_entries(F.transform(counts, lambda e: F.struct(F.substring(e["key"], F.lit(cut), F.length(e["key"])), e["value"].try_cast("long"))))
    own = f"{vendor}.metadata."
    kept = F.map_filter(entries, lambda k, _: k.startswith(METADATA_PREFIXES[0]) | k.startswith(METADATA_PREFIXES[1]) | k.startswith(own) if grouped is None else ~k.startswith(USAGE_PREFIX))
    metadata = F.transform_keys(kept, lambda k, _: F.when(k.startswith(own), F.substring(k, F.lit(len(own) + 1), F.length(k))).otherwise(k))
    return {
        "model": model,
        "type": F.when(model.isNotNull(), "llm").otherwise("general"),
        "provider": attributes[PROVIDER_ATTRIBUTE],
        "usage": usage,
        "cost": attributes[COST_ATTRIBUTE].try_cast("double"),
        "metadata": metadata,
        "tags": F.from_json(attributes[f"{vendor}.tags"], "array<string>"),
        "input": _side(attributes, "input"),
        "output": _side(attributes, "output"),
    }


def choose_parent(attributes: Column, native_trace: Column, native_span: Column, native_parent: Column, vendor: str) -> dict[str, Column]:
    """Trace, span and parent ids: with a valid explicit trace id only explicit ids count, otherwise the native ones."""
    trace, span, parent = (attributes[f"{vendor}.{name}"] for name in ("trace_id", "span_id", "parent_span_id"))
    explicit = is_uuid7(trace)
    return {
        "trace_id": F.when(explicit, trace).otherwise(native_trace),
        "span_id": F.when(explicit & is_uuid7(span), span).otherwise(native_span),
        "parent_span_id": F.when(explicit, F.when(is_uuid7(parent), parent)).otherwise(native_parent),
    }


def parse_traceparent(header: Column) -> Column:
    """Trace id, parent span id and flags of a W3C ``traceparent`` header; null if it is malformed."""
    pattern = r"^00-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"
    return F.when(
        header.rlike(pattern),
        F.struct(
            F.regexp_extract(header, pattern, 1).alias("trace_id"),
            F.regexp_extract(header, pattern, 2).alias("span_id"),
            F.regexp_extract(header, pattern, 3).alias("flags"),
        ),
    )
