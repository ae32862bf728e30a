"""Online evaluation rules: upkeep, checks, routing, sampling, prompts, judges and scoring.

Every function here takes a batch or a streaming DataFrame; the streaming jobs reuse them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.distribution import seeded_key, spread_join
from tracelake.functions.documents import json_path_of, json_scalar, with_json_values
from tracelake.operators import tables
from tracelake.operators.metrics import MetricSpec

# Rule types with the level they work on, message roles, and types a judge may answer with.
RULE_LEVELS = {
    "llm_as_judge": "trace",
    "user_defined_metric_python": "trace",
    "trace_thread_llm_as_judge": "thread",
    "span_llm_as_judge": "span",
    "span_user_defined_metric_python": "span",
}
MESSAGE_ROLES = ["SYSTEM", "USER", "AI", "TOOL_EXECUTION_RESULT", "CUSTOM"]
SCHEMA_TYPES = ["BOOLEAN", "INTEGER", "DOUBLE"]

JUDGE_TYPES = [t for t in RULE_LEVELS if t.endswith("judge")]
METRIC_TYPES = [t for t in RULE_LEVELS if t.endswith("python")]

#: Column with an item's values at all paths that the rules name, see ``bind_paths``.
VALUES = "__values"
#: Paths that are compiled into the plan. Rules may name more: the rest is read per row.
PATHS = 500
#: Variable that stands for the whole conversation in the messages of a thread judge.
CONTEXT = "context"


def rules_upsert(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """Change existing rules, carrying unchanged fields forward, and add the ones that are new."""
    patched = tables.patch(rules, changes, "rule_id")
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in rules.schema if f.name not in changes.columns]
    complete = changes.select("*", *absent).select(*rules.columns)
    return tables.insert_absent(patched, complete, "rule_id")


def rules_delete(rules: DataFrame, ids: DataFrame) -> DataFrame:
    return tables.delete_by_id(rules, ids, "rule_id")


def rules_of_project(rules: DataFrame, project_id: str) -> DataFrame:
    return rules.where(F.array_contains("project_ids", project_id))


def rule_by_id(rules: DataFrame, rule_id: str) -> DataFrame:
    return rules.where(F.col("rule_id") == rule_id)


def rule_errors(rules: DataFrame) -> DataFrame:
    """One row per broken rule requirement."""
    judge, metric = F.col("type").isin(JUDGE_TYPES), F.col("type").isin(METRIC_TYPES)
    none = F.lit(0)
    messages, schema = F.coalesce(F.size("messages"), none), F.coalesce(F.size("schema"), none)
    rate = F.col("sampling_rate")
    roles = F.exists("messages", lambda m: ~m["role"].isin(MESSAGE_ROLES))
    kinds = F.exists("schema", lambda s: ~s["type"].isin(SCHEMA_TYPES))
    checks = [
        (rate.isNull() | ~rate.between(0.0, 1.0), "sampling_rate must be between 0.0 and 1.0"),
        (F.col("type").isNull() | ~F.col("type").isin(list(RULE_LEVELS)), "unknown rule type"),
        (judge & ((messages == 0) | (schema == 0)), "a judge needs messages and schema"),
        ((F.col("type") == "trace_thread_llm_as_judge") & F.col("variables").isNotNull(), "a thread judge takes no variables"),
        (metric & (F.col("metric").isNull() | F.col("arguments").isNull()), "a metric rule needs metric and arguments"),
        (judge & F.coalesce(kinds, F.lit(False)), "schema types are BOOLEAN, INTEGER and DOUBLE"),
        (judge & F.coalesce(roles, F.lit(False)), "unknown message role"),
        (F.coalesce(F.size("project_ids"), none) == 0, "at least one project is needed"),
    ]
    found = F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in checks]))
    return rules.select("rule_id", F.explode(found).alias("error"))


def sampled(item_id: Column, rule_id: Column, rate: Column) -> Column:
    """The same items on every run, and all of a lower rate's items at a higher rate."""
    drawn = F.conv(F.substring(seeded_key(F.concat_ws(":", item_id, rule_id), "sample"), 1, 8), 16, 10).cast("double")
    return drawn / F.lit(float(2**32)) < rate


def sample_by_rule(items: DataFrame, rate: float, rule_id: str, item_id: str = "trace_id") -> DataFrame:
    return items.where(sampled(F.col(item_id), F.lit(rule_id), F.lit(rate)))


def route_rules(items: DataFrame, rules: DataFrame, level: str = "trace", item_id: str = "trace_id") -> DataFrame:
    """One row per item and enabled rule of its project and level that draws it. Rule fields come as struct ``rule``.

    A project with a third of the items is spread over several tasks when the rule table is too large to broadcast.
    """
    types = [t for t, of in RULE_LEVELS.items() if of == level]
    live = rules.where(F.col("enabled") & F.col("type").isin(types))
    by_project = live.select(F.explode(F.array_distinct("project_ids")).alias("project_id"), F.struct(*rules.columns).alias("rule"))
    kind = items.schema["project_id"].dataType
    by_project = by_project.withColumn("project_id", F.col("project_id").cast(kind))
    routed = spread_join(items, by_project, ["project_id"], "inner", item_id)
    return routed.where(sampled(F.col(item_id), F.col("rule.rule_id"), F.col("rule.sampling_rate")))


def bind_variables(variables: Column, roots: Mapping[str, Column], maps: Collection[str] = ()) -> Column:
    """Map of variable to the value at its path."""
    return F.transform_values(variables, lambda _, path: json_path_of(roots, path, maps))


def bind_paths(items: DataFrame, rules: DataFrame, metrics: Mapping[str, MetricSpec] | None = None) -> tuple[DataFrame, DataFrame]:
    """Items with their values at every path that a rule names (array ``VALUES``), and rules that know where in it theirs are
    (``argument_at``, ``variable_at``: name to place) and have their messages cut at them (``pieces``).

    Rules are configuration: their distinct paths are read once and become part of the plan, whatever the number of rules
    that share them. Each JSON column is parsed once per item, before rules multiply the items. Paths of rules that are
    added to a running stream are not known to it; start it again.
    """
    roots, maps = _roots(items)
    empty = F.create_map().cast("map<string,string>")
    own = {c: F.coalesce(F.col(c), empty) if c in rules.columns else empty for c in ("arguments", "variables")}
    defaults = F.lit(None).cast("map<string,string>")
    for name, spec in (metrics or {}).items():
        given = F.create_map(*[F.lit(x) for pair in spec.arguments.items() for x in pair])
        defaults = F.when(F.col("metric") == name, given).otherwise(defaults)
    complete = F.map_zip_with(own["arguments"], F.coalesce(defaults, empty), lambda _, mine, default: F.coalesce(mine, default))
    mapped = rules.withColumns({"__arguments": complete if metrics else own["arguments"], "__variables": own["variables"]})
    named = mapped.select(F.explode(F.concat(F.map_values("__arguments"), F.map_values("__variables"))).alias("path"))
    paths = [r.path for r in named.where("path IS NOT NULL").distinct().orderBy("path").limit(PATHS + 1).collect()]
    known = F.array(*[F.lit(p) for p in paths[:PATHS]]).cast("array<string>")
    place = lambda _, path: F.array_position(known, path).cast("int") - 1
    at = {"argument_at": F.transform_values("__arguments", place), "variable_at": F.transform_values("__variables", place)}
    if len(paths) > PATHS:  # the few that are not compiled keep their paths
        at |= {"argument_path": F.col("__arguments"), "variable_path": F.col("__variables")}
    bound = with_json_values(items, VALUES, roots, paths[:PATHS], maps)
    known_rules = mapped.withColumns(at).drop("__arguments", "__variables")
    if "messages" in rules.columns:
        known_rules = known_rules.withColumn("pieces", prompt_pieces(F.col("messages"), F.col("variable_at")))
    return bound, known_rules


def _bound_value(routed: DataFrame, side: str, name: Column, at: Column) -> Column:
    """Value of a rule's argument or variable: by its place, or by its path if that was not compiled."""
    value = F.get(VALUES, at)
    if f"{side}_path" not in routed.schema["rule"].dataType.names:
        return value
    path = F.try_element_at(F.col(f"rule.{side}_path"), name)
    roots, maps = _roots(routed)
    return F.when(at >= 0, value).otherwise(json_path_of(roots, path, maps))


def rule_prompts(routed: DataFrame, roots: Mapping[str, Column] | None = None, maps: Collection[str] = ()) -> DataFrame:
    """Adds the judge prompt of every routed row: rendered messages, each after its role.

    Variables are read from bound values (``bind_paths``); with ``roots`` given, from these per row, where ``maps`` names
    the roots that are text maps and the others are JSON texts. A column ``context`` is the conversation of a thread: it
    stands for ``{{context}}``, or follows as the last message if none asks for it.
    """
    kinds = {f.name: f.dataType.simpleString() for f in routed.schema["rule"].dataType}
    bound, talk = roots is None, CONTEXT in routed.columns
    if "pieces" in kinds and ("at:int" in kinds["pieces"]) == bound and talk == ("asks_context" in kinds):
        pieces, asked = F.col("rule.pieces"), F.col("rule.asks_context") if talk else None
    else:
        messages = F.col("rule.messages")
        pieces, asked = prompt_pieces(messages, F.col("rule.variable_at" if bound else "rule.variables"), talk), asks_context(messages)

    def text(piece: Column) -> Column:
        value = _bound_value(routed, "variable", piece["name"], piece["at"]) if bound else json_path_of(roots, piece["at"], maps)
        if talk:
            value = F.when((piece["name"] == CONTEXT) & F.col(CONTEXT).isNotNull(), F.col(CONTEXT)).otherwise(value)
        return F.concat(F.when(piece["name"].isNull(), "").otherwise(F.coalesce(value, F.lit(""))), piece["text"])

    prompt = F.array_join(F.transform(pieces, text), "")
    if talk:
        prompt = F.when(asked, prompt).otherwise(F.concat_ws("\n", prompt, F.concat(F.lit("USER: "), F.col(CONTEXT))))
    return routed.withColumn("prompt", prompt)


def prompt_pieces(messages: Column, names: Column, context: bool = False) -> Column:
    """Messages cut at their variables, once per rule instead of once per item. A piece is a variable's ``name`` and place
    ``at`` (null where none is asked for) and the ``text`` behind it. Messages without role or content are left out; with
    ``context`` that variable is known besides ``names``."""

    def piece(part: Column) -> Column:
        before = F.substring_index(part, "}}", 1)
        name = F.trim(before)
        known = F.coalesce(F.map_contains_key(names, name), F.lit(False))
        known = part.contains("}}") & ((known | (name == CONTEXT)) if context else known)
        rest = F.substring(part, F.length(before) + 3, F.length(part))
        return F.struct(
            F.when(known, name).alias("name"), F.when(known, F.try_element_at(names, name)).alias("at"),
            F.when(known, rest).otherwise(F.concat(F.lit("{{"), part)).alias("text"),
        )

    def line(message: Column, number: Column) -> Column:
        parts = F.split(message["content"], r"\{\{")
        opening = F.concat(F.when(number > 0, "\n").otherwise(""), message["role"], F.lit(": "), F.element_at(parts, 1))
        nothing = F.lit(None)
        first = F.struct(nothing.cast("string").alias("name"), F.try_element_at(names, nothing.cast("string")).alias("at"), opening.alias("text"))
        return F.concat(F.array(first), F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece))

    return F.flatten(F.transform(F.filter(messages, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), line))


def asks_context(messages: Column) -> Column:
    return F.exists(messages, lambda m: m["content"].rlike(r"\{\{\s*" + CONTEXT + r"\s*\}\}"))


def judge(prompts: DataFrame, answer: Callable[[pd.Series], pd.Series], column: str = "answer") -> DataFrame:
    """Ask a caller's judge, batch by batch; it gets prompts and gives JSON texts."""

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield answer(batch)

    return prompts.withColumn(column, ask(F.col("prompt")))


def judge_scores(answered: DataFrame, keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Score rows of judge answers, one per field of the rule's schema; what cannot be read is marked as failed."""
    read = answered.select(*keys, "rule.rule_id", F.explode("rule.schema").alias("__field"), F.from_json("answer", "map<string,string>").alias("__given"))
    texts = read.withColumn("__text", F.try_element_at("__given", F.col("__field.name")))
    scored = texts.select(*keys, "rule_id", F.col("__field.name").alias("name"), json_scalar(F.col("__text"), F.col("__field.type")).alias("value"))
    return scored.withColumn("failed", F.col("value").isNull())


def _roots(items: DataFrame) -> tuple[dict[str, Column], set[str]]:
    """Columns that a rule's paths may start from, texts and text maps, and which of them are maps."""
    kinds = {f.name: f.dataType.simpleString() for f in items.schema}
    found = {name: F.col(name) for name, kind in kinds.items() if kind in ("string", "map<string,string>")}
    return found, {name for name in found if kinds[name] != "string"}


def _rule_arguments(routed: DataFrame, spec: MetricSpec) -> dict[str, Column]:
    """Arguments of a metric as each row's rule maps them. The spec's own mapping is the default, and the only one for
    arguments that are not text."""
    default = spec.bound(routed.columns)
    kinds = dict(routed.dtypes)
    texts = [n for n, path in spec.arguments.items() if kinds.get(path, "string") == "string"]  # a path into JSON gives text
    if VALUES in routed.columns:
        places = {n: F.try_element_at(F.col("rule.argument_at"), F.lit(n)) for n in texts}
        return default | {n: _bound_value(routed, "argument", F.lit(n), at) for n, at in places.items()}
    roots, maps = _roots(routed)
    given = {n: F.try_element_at(F.col("rule.arguments"), F.lit(n)) for n in texts}
    return default | {n: F.when(given[n].isNotNull(), json_path_of(roots, given[n], maps)).otherwise(default[n]) for n in texts}


def metric_scores(routed: DataFrame, metrics: Mapping[str, MetricSpec], keys: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Score rows of metric rules. ``rule.metric`` names the metric, ``rule.arguments`` maps its arguments to paths; items and
    rules of ``bind_paths`` have them compiled, others are read per row."""
    entries = [F.when(F.col("rule.metric") == name, spec.entry(routed.columns, _rule_arguments(routed, spec))) for name, spec in metrics.items()]
    scored = routed.where(F.col("rule.metric").isin(list(metrics))).withColumn("__s", F.coalesce(*entries))
    return scored.select(
        *keys, F.col("rule.rule_id"), F.col("__s.name").alias("name"), F.col("__s.value").alias("value"),
        F.col("__s.value").isNull().alias("failed"),
    )


def score_items(
    items: DataFrame,
    rules: DataFrame,
    metrics: Mapping[str, MetricSpec],
    answer: Callable[[pd.Series], pd.Series] | None = None,
    level: str = "trace",
    item_id: str = "trace_id",
) -> DataFrame:
    """Score rows of arriving or stored items (traces or spans) under all rules of one level; threads are scored by
    ``thread_rules``."""
    used = METRIC_TYPES if answer is None else list(RULE_LEVELS)
    bound, known = bind_paths(items, rules.where(F.col("type").isin(used)), metrics)
    routing = ["rule_id", "type", "project_ids", "sampling_rate", "enabled"]

    def short(types: list[str], *used: str) -> DataFrame:  # rules are copied to every item
        return known.where(F.col("type").isin(types)).select(*[c for c in (*routing, *used) if c in known.columns])

    scored = metric_scores(route_rules(bound, short(METRIC_TYPES, "metric", "argument_at", "argument_path"), level, item_id), metrics, [item_id])
    if answer is None:
        return scored
    prompted = rule_prompts(route_rules(bound, short(JUDGE_TYPES, "schema", "pieces", "variable_path"), level, item_id))
    return scored.unionByName(judge_scores(judge(prompted, answer), [item_id]))


def score_batch(traces: DataFrame, rules: DataFrame, metrics: Mapping[str, MetricSpec], answer=None) -> DataFrame:
    """Backfill: score stored traces."""
    return score_items(traces, rules, metrics, answer)


def score_spans(spans: DataFrame, rules: DataFrame, metrics: Mapping[str, MetricSpec], answer=None) -> DataFrame:
    return score_items(spans, rules, metrics, answer, "span", "span_id")
