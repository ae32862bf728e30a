from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.functions import dates, text
from tracelake.operators import quality as K
from tracelake.operators.filters import sort_casefold
from tracelake.sources import readers, writers

PRODUCT = "acme"
README = "# T\n" + "".join(f"## {s}\nbody {i}\n" for i, s in enumerate(K.required_sections(PRODUCT))) + "![x](acme-proof.png)\n"
VALID = {
    "slug": "jane_agent", "title": "Agent", "description": "d", "author": "jane", "links": {"demo": "https://x"}, "platform": "cloud", "tags": [],
    "hosted": True, "readme": README, "files": [("acme-proof.png", None), ("main.py", "import acme")], "meta_error": None,
}


def entries(spark, *changes):
    return spark.createDataFrame([tuple((VALID | c)[f] for f in schemas.ENTRY.names) for c in changes], schemas.ENTRY)


CASES = [
    ({}, None),
    ({"title": " "}, "'title'"),
    ({"description": None}, "'description'"),
    ({"links": {"demo": "ftp://x"}}, "'links'"),
    ({"links": {"demo": "httpfoo"}}, None),
    ({"links": None}, "'links'"),
    ({"platform": "moon"}, "'platform'"),
    ({"tags": None}, "'tags'"),
    ({"hosted": None}, "'hosted'"),
    ({"readme": README.replace("## What I learned\nbody 2", "## What I learned\n")}, "'What I learned' is empty"),
    ({"readme": README.replace("body 1", "todo: write")}, "'Problem it solves' is empty"),
    ({"readme": README.replace("## What I built", "## Else")}, "missing section 'What I built'"),
    ({"readme": README.replace("acme-proof.png", "")}, "must be referenced"),
    ({"files": [("main.py", "import acme")]}, "missing acme-proof.png"),
    ({"slug": "Jane_agent"}, "folder name"),
    ({"slug": "jane"}, "folder name"),
    ({"files": [("acme-proof.png", None), ("a.py", "ACME_X"), ("cfg.py", "k = 'sk-" + "a" * 24 + "'")]}, "possible secret in cfg.py"),
    ({"files": [("acme-proof.png", None), ("a.py", "ACME_API_KEY = 'abc'")]}, "possible secret in a.py"),
    ({"files": [("acme-proof.png", None), ("a.py", "ACME_API_KEY = ''")]}, None),
    ({"files": [("acme-proof.png", None), ("a.py", "import acme"), ("x.bin", "sk-" + "a" * 24)]}, None),
    ({"files": [("acme-proof.png", None), ("a.py", "import acme"), ("d/.env", "")]}, "committed .env file at d/.env"),
    ({"files": [("acme-proof.png", None), ("a.py", "import acme"), (".env.example", "")]}, None),
    ({"files": [("acme-proof.png", None), ("a.py", "print()")]}, "hosted entry"),
    ({"files": [("acme-proof.png", None)], "hosted": False}, None),
    ({"meta_error": "metadata cannot be read", "title": None}, "metadata cannot be read"),
]


def test_entry_rules(spark):
    changes = [c | ({} if "slug" in c else {"slug": f"jane_a{i}"}) for i, (c, _) in enumerate(CASES)]
    found = {}
    for slug, error in rows(K.entry_errors(entries(spark, *changes), PRODUCT)):
        found.setdefault(slug, []).append(error)
    for change, (_, expected) in zip(changes, CASES):
        errors = found.get(change["slug"], [])
        if expected is None:
            assert errors == [], change
        else:
            assert len(errors) == 1 and expected in errors[0], (change, errors)


def test_verdicts(spark):
    checked = K.check_entries(entries(spark, {}, {"slug": "bad"}), PRODUCT)
    assert rows(checked) == [("bad", 1, False), ("jane_agent", 0, True)]


def test_catalogue(spark):
    df = entries(spark, {"slug": "b_b", "title": "zeta | x", "author": None}, {"slug": "a_a", "title": "Alpha", "tags": ["x|y", "z"]}, {"slug": "c_c", "meta_error": "x"})
    shown = K.entry_catalogue(df).collect()
    assert [r.slug for r in shown] == ["a_a", "b_b"]
    assert shown[0].tags == "x\\|y, z" and shown[1].project == "[zeta \\| x](b_b/)" and shown[1].author == ""
    assert shown[0].author == "[@jane](https://github.com/jane)" and shown[0].links == "[demo](https://x)"
    assert K.catalogue_is_current(K.entry_catalogue(df), df)
    assert not K.catalogue_is_current(K.entry_catalogue(df).limit(1), df)
    assert [r.title for r in sort_casefold(df, "title").collect()] == ["Agent", "Alpha", "zeta | x"]


def test_no_credentials(spark):
    df = spark.createDataFrame([("a", 1)], "t string, n int")
    patterns = K.secret_patterns(PRODUCT)
    assert K.no_credentials(df, patterns)
    assert not K.no_credentials(df.union(spark.createDataFrame([("x sk-ant-" + "b" * 20, 2)], df.schema)), patterns)


def test_sections(spark):
    md = "intro\n## A\none\n\n## B \r\ntwo\n### C\nthree\n## A\nlast\n"
    assert spark.range(1).select(text.markdown_sections(F.lit(md))).first()[0] == {"A": "last", "B": "two\n### C\nthree"}


def test_dates(spark):
    df = spark.createDataFrame([("2025-01-31",), ("2025-01-31T12:00:00",), ("2025-01-31T12:00:00Z",), ("31.1.2025",)], "t string")
    found = [r[0] for r in df.select(dates.format_ms_z(dates.parse_date(F.col("t")))).collect()]
    assert found == ["2025-01-31T00:00:00.000Z", "2025-01-31T12:00:00.000Z", "2025-01-31T12:00:00.000Z", None]
    ts = F.lit(datetime(2025, 1, 31, 1, 2, 3, 999999))
    row = spark.range(1).select(dates.format_ms_z(ts), dates.latency_ms(ts, ts + F.expr("INTERVAL 1500 MICROSECONDS")), dates.span_days(F.lit(date(2025, 1, 1)), F.lit(date(2025, 1, 31)))).first()
    assert row[0].endswith("03.999Z") and row[1] == 1.5 and row[2] == 30
    assert dates.yesterday(datetime(2025, 3, 1, 5)) == (datetime(2025, 2, 28), datetime(2025, 2, 28, 23, 59, 59, 999999))
    assert dates.lookback(datetime(2025, 3, 1), 30)[0] == datetime(2025, 1, 30)


def test_small_text_functions(spark):
    row = spark.range(1).select(
        text.score_name(F.lit("feedback_scores.acc")),
        text.score_name(F.lit("acc")),
        text.registry_url(F.lit("https://h"), F.lit("w"), F.lit("m"), F.lit("1.0.0")),
        text.rule_label(F.lit("x"), F.lit(30)),
        text.join_bodies(F.array(F.struct(F.lit("a").alias("body")), F.struct(F.lit(None).cast("string").alias("body")))),
        text.split_items(text.join_items(F.array(F.lit("a"), F.lit("b")))),
        text.join_context(F.array(F.lit("a"), F.lit("b"))),
    ).first()
    assert tuple(row) == ("acc", "acc", "https://h/w/model-registry/m/1.0.0", "tag='x', >30d old", "a\n\n", ["a", "b"], "a\nb")


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"id": "1", "session": "s", "driver": "d", "team": "t", "lap": 3, "text": "box"},\n {"id": "2"}]')
    records = readers.read_records(spark, str(tmp_path / "m.json"), schemas.RADIO_MESSAGE)
    assert rows(records, "id", "lap") == [("1", 3), ("2", None)]
    assert readers.read_config_table(spark, str(tmp_path / "none.json"), schemas.CATEGORY).isEmpty()
    folder = tmp_path / "calls"
    folder.mkdir()
    (folder / "a.txt").write_text("one\ntwo")
    (folder / "b.md").write_text("md")
    (folder / "c.pdf").write_text("skip")
    assert rows(readers.read_transcripts(spark, str(folder))) == [("a.txt", "one\ntwo"), ("b.md", "md")]
    for name in ("jane_agent/src/a.py", "_ci/x.py", "templates/t.md"):
        path = tmp_path / "community" / name
        path.parent.mkdir(parents=True)
        path.write_text("x")
    assert rows(readers.discover_entries(spark, str(tmp_path / "community"), ["templates"])) == [("jane_agent",)]
    assert ("jane_agent", "src/a.py", "x") in rows(readers.read_tree(spark, str(tmp_path / "community")))


def test_trace_table(spark, tmp_path):
    path = str(tmp_path / "traces")
    data = [(f"t{i}", "1", f"p{i % 2}", "n", datetime(2026, 7, 1 + i), None, [], None, None, None, None, None, None, None, None) for i in range(4)]
    writers.ingest_traces(spark.createDataFrame(data, schemas.TRACE), path)
    one = readers.scan_traces(spark, path, "p1")
    assert rows(one, "trace_id") == [("t1",), ("t3",)]
    assert "PartitionFilters: [isnotnull(project" in one._jdf.queryExecution().executedPlan().toString()
    assert rows(readers.row_count(readers.scan_traces(spark, path))) == [(4,)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("t", "a", 1.0, "r", "sdk", datetime(2026, 7, 1))], schemas.SCORE)
    newer = df.withColumns({"value": F.lit(2.0), "ts": F.lit(datetime(2026, 7, 2))})
    assert rows(writers.append_scores(df, newer), "value") == [(2.0,)]
    writers.save_result(df, str(tmp_path / "r"))
    with pytest.raises(AnalysisException):
        writers.save_result(df, str(tmp_path / "r"))
    writers.save_result(df, str(tmp_path / "r"), replace=True)
    writers.write_payload(df, str(tmp_path / "j"))
    assert spark.read.schema(schemas.SCORE).json(str(tmp_path / "j")).count() == 1
    writers.rebuild_vectors(df, str(tmp_path / "v"))
    writers.write_catalogue(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 1
