"""Schemas of the tables. Free JSON stays text and metadata stays a map, so no read infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SCORE_ENTRY = _struct(name=T.StringType(), value=T.DoubleType())

TRACE = _struct(
    trace_id=T.StringType(),
    project_id=T.StringType(),
    project=T.StringType(),
    name=T.StringType(),
    start_time=T.TimestampType(),
    end_time=T.TimestampType(),
    tags=_STRINGS,
    input=T.StringType(),
    output=T.StringType(),
    metadata=_TEXT_MAP,
    usage=T.MapType(T.StringType(), T.LongType()),
    cost=T.DoubleType(),
    guardrail_failed=T.BooleanType(),
    thread_id=T.StringType(),
    scores=T.ArrayType(SCORE_ENTRY),
)

SPAN = _struct(
    trace_id=T.StringType(),
    span_id=T.StringType(),
    parent_span_id=T.StringType(),
    name=T.StringType(),
    session_id=T.StringType(),
    start_time=T.TimestampType(),
    end_time=T.TimestampType(),
    attributes=_TEXT_MAP,
)

SCORE = _struct(
    trace_id=T.StringType(),
    name=T.StringType(),
    value=T.DoubleType(),
    reason=T.StringType(),
    source=T.StringType(),
    ts=T.TimestampType(),
)

PROJECT = _struct(id=T.StringType(), name=T.StringType())

DAILY = _struct(
    workspace=T.StringType(),
    project_id=T.StringType(),
    project=T.StringType(),
    metric=T.StringType(),
    series=T.StringType(),
    date=T.DateType(),
    value=T.DoubleType(),
)

SUMMARY = _struct(project=T.StringType(), metric=T.StringType(), value=T.DoubleType())

DATASET_ITEM = _struct(
    question=T.StringType(),
    expected_answer=T.StringType(),
    category=T.StringType(),
)

SUITE_ITEM = _struct(query=T.StringType(), messages=_STRINGS, expected_output=T.StringType(), assertions=_STRINGS)

TEST_RESULT = _struct(
    experiment_id=T.StringType(),
    item_id=T.StringType(),
    score_name=T.StringType(),
    value=T.DoubleType(),
    failed=T.BooleanType(),
)

EXPERIMENT = _struct(experiment_id=T.StringType(), name=T.StringType(), tags=_STRINGS, config=_TEXT_MAP)

RULE = _struct(
    rule_id=T.StringType(),
    name=T.StringType(),
    type=T.StringType(),
    project_ids=_STRINGS,
    sampling_rate=T.DoubleType(),
    enabled=T.BooleanType(),
    model=T.StringType(),
    messages=T.ArrayType(_struct(role=T.StringType(), content=T.StringType())),
    schema=T.ArrayType(_struct(name=T.StringType(), type=T.StringType(), description=T.StringType())),
    variables=_TEXT_MAP,
    metric=T.StringType(),
    arguments=_TEXT_MAP,
)

QUEUE = _struct(name=T.StringType(), instructions=T.StringType(), feedback_definitions=_STRINGS)

ASSIGNMENT = _struct(queue=T.StringType(), trace_id=T.StringType())

CALL = _struct(
    id=T.StringType(),
    transcript=T.StringType(),
    summary=T.StringType(),
    action_items=_STRINGS,
    category=T.StringType(),
    created_at=T.TimestampType(),
    metadata=_TEXT_MAP,
)

CATEGORY = _struct(
    key=T.StringType(),
    name=T.StringType(),
    description=T.StringType(),
    prompt_template=T.StringType(),
    created_at=T.TimestampType(),
    updated_at=T.TimestampType(),
)

VECTOR = _struct(id=T.StringType(), text=T.StringType(), embedding=T.ArrayType(T.FloatType()), payload=_TEXT_MAP)

RADIO_MESSAGE = _struct(
    id=T.StringType(),
    session=T.StringType(),
    driver=T.StringType(),
    team=T.StringType(),
    lap=T.IntegerType(),
    text=T.StringType(),
)

PROMPT = _struct(
    name=T.StringType(),
    messages=_STRINGS,
    change_description=T.StringType(),
    tags=_STRINGS,
    created_at=T.TimestampType(),
)

ENTRY = _struct(
    slug=T.StringType(),
    title=T.StringType(),
    description=T.StringType(),
    author=T.StringType(),
    links=_TEXT_MAP,
    platform=T.StringType(),
    tags=_STRINGS,
    hosted=T.BooleanType(),
    readme=T.StringType(),
    files=T.ArrayType(_struct(path=T.StringType(), text=T.StringType())),
    meta_error=T.StringType(),
)
