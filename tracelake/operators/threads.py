"""Conversation threads: sessions, ordered and bounded parts of them, and the rules that judge whole conversations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.distribution import ordered_total
from tracelake.operators.rules import CONTEXT, JUDGE_TYPES, asks_context, judge, judge_scores, prompt_pieces, route_rules, rule_prompts
from tracelake.session import materialise

SESSION_COLUMNS = ["thread_id", "start", "end", "traces", "first", "last"]
#: What tells the sessions that rules judge apart: a rule belongs to projects.
THREAD = ("project_id", "thread_id")


def sessions_by(traces: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    grouped = traces.groupBy(*keys, F.session_window("start_time", gap).alias("session"))
    facts = grouped.agg(F.count("*").alias("traces"), F.min("start_time").alias("first"), F.max("start_time").alias("last"))
    return facts.select(*keys, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "traces", "first", "last")


def thread_sessions(traces: DataFrame, gap: str = "30 minutes", part: str = "day", by: Sequence[str] = ("thread_id",)) -> DataFrame:
    """Sessions of stored threads, which the columns ``by`` name: traces at most ``gap`` apart.

    Sessions are found within calendar parts first, so one huge thread is spread over its parts. Only the first and last
    session of a part can go on in the next one; these few are joined up per thread.
    """
    keys = [*by, "__part"]
    cut = traces.withColumn("__part", F.date_trunc(part, "start_time"))
    inside = Window.partitionBy(*keys)
    found = sessions_by(cut, keys, gap).withColumn(
        "__edge", (F.col("first") == F.min("first").over(inside)) | (F.col("last") == F.max("last").over(inside))
    )
    by_time = Window.partitionBy(*by).orderBy("first")
    edges = found.where("__edge").withColumn("__fresh", F.coalesce(F.col("first") > F.lag("end").over(by_time), F.lit(True)).cast("int"))
    numbered = edges.withColumn("__n", F.sum("__fresh").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(*by, "__n").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("traces").alias("traces"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    columns = [*by, *SESSION_COLUMNS[1:]]
    return found.where("not __edge").select(*columns).unionByName(joined.select(*columns))


def thread_parts(
    turns: DataFrame, size: int, thread: str = "thread_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """Whole conversations in order, as parts of at most ``size`` turns each, with the number of ``parts``. Turns of one
    place follow each other by text.

    Turns are numbered through buckets and only a part is gathered at once, so one endless conversation neither fills a
    task nor is cut short; nearly every conversation is a single part.
    """
    return _parts(turns, size, thread, order, text).withColumn("parts", F.count("*").over(Window.partitionBy(thread)))


def _parts(turns: DataFrame, size: int, thread: str, order: str, text: str) -> DataFrame:
    numbered = ordered_total(turns, F.col(order), [text], "__index", [thread])
    part = F.floor(F.col("__index") / size).cast("int")
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__order"), F.col(text))))
    grouped = numbered.groupBy(thread, part.alias("part")).agg(entries.alias("__turns"))
    return grouped.select(
        thread, "part", F.size("__turns").alias("turns"), _joined("__turns", text).alias("conversation")
    )


def _joined(turns: str, text: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: t[text]), "\n")


def trace_turns() -> Column:
    """What a trace adds to a conversation: what was asked and what was answered."""
    asked, answered = F.concat(F.lit("USER: "), "input"), F.concat(F.lit("ASSISTANT: "), "output")
    return F.concat_ws("\n", asked, answered)


def session_parts(sessions: DataFrame, traces: DataFrame, size: int = 50, text: Column | None = None, by: Sequence[str] = THREAD) -> DataFrame:
    """Conversations of sessions (``by``, ``first``, ``last``), read from the trace table by these bounds, as parts of at most
    ``size`` traces in order: ``by``, ``first``, ``part``, ``turns``, ``conversation``.

    Sessions meet traces by thread and day, so a thread that never ends is spread over its days. Sessions that say (``traces``)
    that one part holds them are gathered at once; only the traces of longer ones are written and numbered.
    """
    if "traces" not in sessions.columns:
        return _long_session_parts(sessions, traces, size, text, by)
    short = _session_turns(sessions.where(F.col("traces") <= size), traces, text, by)
    gathered = short.groupBy("__session").agg(F.array_sort(F.collect_list(F.struct("__time", "__text"))).alias("__turns"))
    starts = F.sequence(F.lit(0), F.floor((F.size("__turns") - 1) / size).cast("int"))  # the table may hold more by now
    cut = gathered.select("__session", "__turns", F.explode(starts).alias("part"))
    cut = cut.withColumn("__turns", F.slice("__turns", F.col("part") * size + 1, size))
    parts = cut.select("__session.*", "part", F.size("__turns").alias("turns"), _joined("__turns", "__text").alias("conversation"))
    long = sessions.where(F.coalesce(F.col("traces") > size, F.lit(True)))
    return parts if long.isEmpty() else parts.unionByName(_long_session_parts(long, traces, size, text, by))


def _long_session_parts(sessions: DataFrame, traces: DataFrame, size: int, text: Column | None, by: Sequence[str]) -> DataFrame:
    turns = materialise(_session_turns(sessions, traces, text, by), "session-turns")  # numbering reads them several times
    return _parts(turns, size, "__session", "__time", "__text").select("__session.*", "part", "turns", "conversation")


def _session_turns(sessions: DataFrame, traces: DataFrame, text: Column | None, by: Sequence[str]) -> DataFrame:
    bounds = [F.col(c).cast("timestamp").alias(f"__{c}") for c in ("first", "last")]
    held = sessions.select(*by, *bounds).withColumn("__day", F.explode(F.sequence(F.to_date("__first"), F.to_date("__last"))))
    turns = traces.select(*by, F.col("start_time").cast("timestamp").alias("__time"), (trace_turns() if text is None else text).alias("__text"))
    met = turns.withColumn("__day", F.to_date("__time")).join(held, [*by, "__day"]).where(F.col("__time").between(F.col("__first"), F.col("__last")))
    key = F.struct(*by, F.col("__first").alias("first")).alias("__session")
    return met.select(key, "__time", "__text")


def judge_sessions(
    sessions: DataFrame, traces: DataFrame, rules: DataFrame, answer: Callable[[pd.Series], pd.Series], size: int = 50, text: Column | None = None
) -> DataFrame:
    """Scores of sessions by the thread judges of their projects: ``project_id``, ``thread_id``, ``first``, ``rule_id``, ``name``,
    ``value``, ``failed``.

    Threads are drawn as a whole, by their id. Only drawn sessions are read from the trace table. A judge sees the whole
    conversation; one of more than ``size`` traces comes in parts, whose values are weighted by their traces. A session with
    a part that could not be read is marked as failed, its value is that of the others.
    """
    judges = rules.where(F.col("type").isin(JUDGE_TYPES))
    judges = judges.withColumns({"pieces": prompt_pieces(F.col("messages"), F.col("variables"), True), "asks_context": asks_context(F.col("messages"))})
    keys = [*THREAD, "first"]
    known = [c for c in (*keys, "last", "traces") if c in sessions.columns]
    routed = route_rules(sessions.select(known).withColumn("first", F.col("first").cast("timestamp")), judges, "thread", "thread_id")
    drawn = materialise(routed.select(known).distinct(), "drawn-sessions")  # read for short and for long ones
    parts = session_parts(drawn, traces, size, text).withColumnRenamed("conversation", CONTEXT)
    fields = ["rule_id", "type", "project_ids", "sampling_rate", "enabled", "schema", "pieces", "asks_context"]
    asked = route_rules(parts, judges.select(fields), "thread", "thread_id")  # a draw depends on ids only: the same again
    scored = judge_scores(judge(rule_prompts(asked, {}), answer), [*keys, "turns"])
    weight = F.sum(F.when(F.col("value").isNotNull(), F.col("turns")))
    return scored.groupBy(*keys, "rule_id", "name").agg(
        F.try_divide(F.sum(F.col("value") * F.col("turns")), weight).alias("value"), F.bool_or("failed").alias("failed")
    )


def thread_scores(
    traces: DataFrame, rules: DataFrame, answer: Callable[[pd.Series], pd.Series], gap: str = "30 minutes", size: int = 50, text: Column | None = None
) -> DataFrame:
    """``judge_sessions`` over all sessions of stored traces."""
    return judge_sessions(thread_sessions(traces, gap, by=THREAD), traces, rules, answer, size, text)


def combine_parts(scores: DataFrame, thread: str = "thread_id") -> DataFrame:
    """Thread score from part scores ``(name, value, turns)``, each weighted by its turns."""
    weighted = F.sum(F.col("value") * F.col("turns")) / F.sum("turns")
    return scores.where(F.col("value").isNotNull()).groupBy(thread, "name").agg(weighted.alias("value"))
