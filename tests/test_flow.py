"""Watched gates, rule lists in one scan, chained rules, rejects, shared views, layouts, ledgers."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.keyed import merge_in_place, upsert_by_key
from millrace.operators.quality import InlineSpec, QualityError, WatchedRows, inline_quality, rule_quality
from millrace.operators.rejects import split_rejects, tag_rejects
from millrace.operators.rules import apply_rules, chain_steps, read_rules
from millrace.operators.windows import top_per_group
from millrace.plans.jobs import ETL_BLOCK, run_etl
from millrace.plans.script import references, run_script
from millrace.session import written
from millrace.sinks import write_sink
from millrace.sources.tables import bucket_layout, upsert_table, write_bucketed
from millrace.streaming.ingest import batch_writer, ingest_stream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_counter(spark):
    """A frame of 40 rows, and how often each of them has been evaluated so far."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(40).selectExpr("id", "id % 4 as k", "if(id % 5 = 0, null, cast(id as string)) as v")
    return frame.mapInArrow(watch, frame.schema), seen


SPEC = {"not_null": ("v",), "lengths": {"v": 2}, "patterns": (("v", "[0-9]+"),), "rows_range": "1-50", "column_size": 3}


@pytest.mark.parametrize("keys", [(), ("k",), ("id", "k")])
def test_watched_rows_report_as_the_plain_check(spark, keys):
    frame, seen = read_counter(spark)
    spec = InlineSpec(primary_columns=keys, **SPEC)
    watched = WatchedRows(frame, spec)
    copy = written(watched.frame, "test")
    assert watched.report(copy).collect() == inline_quality(copy, spec).collect()
    assert seen.value == 40


def test_watched_rows_of_an_empty_frame(spark):
    spec = InlineSpec(primary_columns=("id",), **SPEC)
    for nothing in (spark.range(5).where("id > 9").selectExpr("id", "id as k", "string(id) as v"), spark.createDataFrame([], "id int, k int, v string")):
        watched = WatchedRows(nothing, spec)
        copy = written(watched.frame, "test")
        assert watched.report(copy).collect() == inline_quality(nothing, spec).collect()


def test_a_report_without_a_key_does_not_read_the_copy(spark):
    frame, seen = read_counter(spark)
    watched = WatchedRows(frame, InlineSpec(**SPEC))
    written(watched.frame, "test")
    unreadable = spark.range(1).selectExpr("id", "id as k", "raise_error('read') as v")
    report = watched.report(unreadable).first()
    assert (report.total_rows, report.null_rows, report.length_rows, report.regex_rows) == (40, 8, 8, 8)
    assert seen.value == 40


def test_gate_of_a_task(spark, folder):
    spark.range(500).selectExpr("id", "string(id) as v").write.parquet(f"{folder}/in")
    info = {
        "file_type_input": "parquet",
        "data_sources_params_input": json.dumps({"paths": f"{folder}/in"}),
        "enable_quality": "on",
        "column_data_list": [{"column_expr": "id", "column_alias": "id", "column_name": "v", "column_regex": "[0-4]+"}],
    }
    task = {"dsi_Input": {"data_source_type": "hdfs"}, ETL_BLOCK: info}
    with pytest.raises(QualityError, match="regex_check"):
        run_etl(spark, task)
    done = run_etl(spark, {**task, ETL_BLOCK: {**info, "error_rate": "1"}})
    assert done.quality["result"] == "within_tolerance" and done.frame.count() == 500


def quality_rule(kind, code, expr, columns):
    return {"rule_type": kind, "rule_code": code, "rule_name": code, "rule_expr": expr, "quality_columns": columns}


def test_many_key_rules_in_one_scan(spark):
    data = [(None, 1, "x"), (None, 1, "y"), (None, None, "y"), (2, 1, None), (2, 2, None), (3, 3, "z")]
    frame = spark.createDataFrame(data, "a int, b int, c string")
    rules = [
        quality_rule("3", "ab", "primary_key_check", "a,b"),
        quality_rule("3", "a", "primary_key_check", "a"),
        quality_rule("3", "ba", "primary_key_check", "b,a"),
        quality_rule("3", "c", "primary_key_check", "c"),
        quality_rule("1", "pos", "$column > 1", "a,b"),
        quality_rule("2", "yz", "[yz]", "c"),
    ]
    found = rule_quality(frame, rules)
    expected = {("ab", 2), ("a", 5), ("ba", 2), ("c", 4), ("pos", 3), ("pos", 4), ("yz", 3)}
    assert {(r.rule_code, r.violations) for r in found.collect()} == expected
    assert [r.seq for r in found.orderBy("seq").collect()] == list(range(7))
    assert [r.violations for r in rule_quality(frame.limit(0), rules).collect()] == [0] * 7


def test_rule_list_plan(spark, folder):
    spark.range(10).selectExpr("id as a", "id % 3 as b", "string(id) as c").write.parquet(f"{folder}/t")
    rules = [
        quality_rule("3", "1", "primary_key_check", "a"),
        quality_rule("3", "2", "primary_key_check", "b"),
        quality_rule("1", "3", "$column > 1", "a"),
        quality_rule("2", "4", "x", "c"),
    ]
    text = plan(rule_quality(spark.read.parquet(f"{folder}/t"), rules))
    assert text.count("FileScan") == 1 and text.count("Expand") == 1


# Chained rules


def by_agenda(row, rules):
    """One row through the rules one at a time: the highest due rule fires, what it changes is due again."""
    steps, reads, sets = chain_steps(rules)
    order = sorted(range(len(rules)), key=lambda i: (-rules[i].get("priority", 0), i))
    due = set(order)
    while due:
        i = next(j for j in order if j in due)
        due.discard(i)
        fires, values = row.evaluate(rules[i])
        if fires:
            changed = {name for name, value in values.items() if row.values.get(name) != value}
            row.values.update(values)
            due |= {j for j in order if j != i and changed & reads[j]}
    return row.values


class TextRow:
    """Columns a, b, c, d; a rule's SQL is of the shape the random rules below have."""

    def __init__(self, values):
        self.values = dict(values)

    def evaluate(self, rule):
        name, value = rule["test"]
        fires = self.values.get(name) == value
        return fires, {k: v.strip("'") for k, v in rule["set"].items()}


def test_chained_rules_fire_as_an_agenda(spark):
    rng = random.Random(4)
    tried = 0
    while tried < 12:
        rules = []
        for _ in range(rng.randrange(2, 7)):
            read, target = rng.sample("abcd", 2)
            value = rng.choice("xy")
            rules.append({"when": f"{read} = '{value}'", "set": {target: f"'{rng.choice('xyz')}'"}, "priority": rng.randrange(3), "test": (read, value)})
        try:
            chain_steps(read_rules(rules))
        except ValueError:
            continue
        tried += 1
        data = [tuple(rng.choice("xyz") for _ in range(4)) for _ in range(15)]
        frame = spark.createDataFrame([(str(i), *row) for i, row in enumerate(data)], "id string, a string, b string, c string, d string")
        out = apply_rules(frame, rules).drop("test")
        for row in out.collect():
            expected = by_agenda(TextRow(zip("abcd", data[int(row.id)])), rules)
            assert {k: row[k] for k in "abcd"} == expected, rules


def test_chained_rules_in_a_circle_are_refused(spark):
    rules = [
        {"priority": 1, "when": "a = 1", "set": {"b": "1"}},
        {"when": "b = 1", "set": {"c": "1"}},
        {"when": "c = 1 and 'x' = 'a'", "set": {"a": "2"}},
    ]
    frame = spark.createDataFrame([("1", "0", "0")], "a string, b string, c string")
    with pytest.raises(ValueError, match="circle"):
        apply_rules(frame, rules)
    rules[2]["when"] = "d = 'a'"
    assert chain_steps(read_rules(rules))[0] == [0, 1, 2, 0, 1]


def test_a_rule_does_not_feed_itself(spark):
    frame = spark.createDataFrame([("1",), (None,)], "n string")
    rules = [{"priority": 1, "when": "n < 10", "set": {"N": "cast(cast(n as int) + 1 as string)"}}]
    assert rows(apply_rules(frame, rules)) == [(None,), ("2",)]
    with pytest.raises(ValueError, match="reserved"):
        apply_rules(
            frame.withColumn("__due_0", F.lit(1)),
            [{"priority": 2, "when": "n = 'x'", "set": {"m": "1"}}, {"when": "true", "set": {"n": "'x'"}}],
        )


# Rejects


MAPPING = [
    {"column_expr": "a", "column_alias": "n", "column_type": "int"},
    {"column_expr": "concat(a, b)", "column_alias": "day", "column_type": "date"},
    {"column_expr": "b", "column_alias": "b"},
]


def test_rejects_add_up(spark):
    data = [("1", None), ("x", None), (None, None), ("2024-01-0", "1"), ("2", "0"), ("", "")]
    frame = spark.createDataFrame(data, "a string, b string")
    accepted, rejected = split_rejects(tag_rejects(frame, MAPPING))
    assert accepted.columns == ["n", "day", "b"]
    assert accepted.count() + rejected.count() == len(data)
    told = {json.loads(r.rejected_row).get("a"): r.reject_reasons for r in rejected.collect()}
    assert told == {
        "x": ["n: x is no int"],
        "2024-01-0": ["n: 2024-01-0 is no int"],
        "2": ["day: 20 is no date"],
        "": ["n:  is no int", "day:  is no date"],
    }
    assert sorted(r.n or 0 for r in accepted.collect()) == [0, 1]
    nothing = split_rejects(tag_rejects(frame.limit(0), MAPPING))
    assert [part.count() for part in nothing] == [0, 0]
    with pytest.raises(ValueError, match="reserved"):
        tag_rejects(frame, [{"column_expr": "a", "column_alias": "rejected_row"}])


def test_rejects_evaluate_their_input_once(spark):
    frame, seen = read_counter(spark)
    accepted, rejected = split_rejects(tag_rejects(frame, [{"column_expr": "v", "column_alias": "v", "column_type": "tinyint"}]))
    assert accepted.count() == 40 and rejected.count() == 0 and seen.value == 40


def test_stream_rejects_need_json(spark, folder):
    sink = {"type": "hdfs", "options": {"paths": f"{folder}/out"}}
    stream = {"type": "flume", "options": {"paths": folder, "checkpoint": f"{folder}/c"}, "fields": "a", "rejects": sink}
    with pytest.raises(ValueError, match="JSON"):
        ingest_stream(spark, stream, sink)


# Shared views


def test_references_are_names_alone():
    text = "select a.v, 'v' as x -- v\n from v join `v` w on v(1) = 2 /* v */ where vv = 1 and t.v = 2"
    assert references(text, "v") == 2
    assert references("select 1", "v") == 0


def test_a_view_used_twice_is_evaluated_once(spark):
    own = spark.newSession()
    frame, seen = read_counter(own)
    script = "select s.id, n from s join (select k, count(*) as n from s group by k) t on s.k = t.k"
    assert run_script(own, script, {"s": frame}).count() == 40
    assert seen.value == 40
    frame, seen = read_counter(own)
    chain = "create temporary view `m` as select * from s where k < 2;\n" + script.replace(" s ", " m ").replace("s.", "m.")
    assert run_script(own, chain, {"s": frame}).count() == 20
    assert seen.value == 40
    frame, seen = read_counter(own)
    run_script(own, "select count(*) from s", {"s": frame})
    assert seen.value == 0  # a view used once stays lazy


# Layouts and ledgers


def upsert_rows(rng, n):
    return [(i, rng.choice([None, *"pq"]), rng.choice([None, 1, 2, 3])) for i in rng.sample(range(n), n // 2)]


def test_upsert_in_place(spark):
    rng = random.Random(8)
    name = f"bucketed_{rng.randrange(10**9)}"
    current = spark.createDataFrame(upsert_rows(rng, 200), "id int, v string, ts int")
    incoming = spark.createDataFrame(upsert_rows(rng, 200) + upsert_rows(rng, 200), "id int, v string, ts int")
    write_bucketed(current, name, "id", 5)
    assert bucket_layout(spark, name) == (["id"], 5)
    expected = rows(upsert_by_key(current, incoming, "id", "ts,v", current_is_keyed=True), "id")
    merged = merge_in_place(spark.table(name), incoming, "id", "ts,v", 5)
    before, _, _ = plan(merged).partition("FileScan")
    # The one exchange is that of the incoming rows; between the join and the table there is none.
    assert plan(merged).count("Exchange") == 1
    upsert_table(incoming, name, "ts,v")
    assert rows(spark.table(name), "id") == expected
    assert bucket_layout(spark, name) == (["id"], 5)
    with pytest.raises(Exception, match="key column id is NULL"):
        upsert_table(spark.createDataFrame([(None, "x", 1)], "id int, v string, ts int"), name, "ts")
    assert rows(spark.table(name), "id") == expected
    # A run that ended before the new version took the name.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")
    upsert_table(incoming, name, "ts,v")
    assert rows(spark.table(name), "id") == expected


def test_upsert_refuses_helper_names(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "id int, ts int, __row int")
    with pytest.raises(ValueError, match="reserved"):
        upsert_by_key(frame, frame, "id", "ts", current_is_keyed=True)
    with pytest.raises(ValueError, match="reserved"):
        merge_in_place(frame, frame, "id", "ts", 2)


def test_batches_replace_their_own_partition(spark, folder):
    name = f"ledger_{random.randrange(10**9)}"
    sink = {"type": "hive", "options": {"paths": name, "path": f"{folder}/t", "batch_partition": "n"}}
    write = batch_writer(sink)
    batches = [spark.createDataFrame([(i,), (i + 10,)], "v int") for i in range(3)]
    for number in (0, 1, 1, 0, 2, 2):
        write(batches[number], number)
    assert rows(spark.table(name)) == [(0, 0), (1, 1), (2, 2), (10, 0), (11, 1), (12, 2)]
    with pytest.raises(ValueError, match="table sinks"):
        batch_writer({"type": "hdfs", "options": {"batch_partition": "n"}})


def test_deep_top_per_group(spark):
    frame = spark.range(6000).selectExpr("id", "if(id % 3 = 0, 'hot', string(id % 7)) as g", "id % 1500 as t", "map('a', id) as m")
    expected = frame.withColumn("place", F.expr("rank() over (partition by g order by t desc)")).where("place <= 1200")
    found = top_per_group(frame, "g", "t desc", 1200, "place")
    key = ["id", "g", "t", "place"]
    assert rows(found.select(key)) == rows(expected.select(key))
    with pytest.raises(ValueError, match="another name"):
        top_per_group(frame, "g", "t", 3, "T")


# Sinks


@pytest.mark.parametrize("kind", ["hdfs", "hive", "hbase", "sftp", "ftp", "kafka", "redis", "cassandra", "iceberg", "es"])
def test_clear_statements_are_run_or_refused(spark, folder, kind):
    with pytest.raises(ValueError, match="cannot be cleared"):
        write_sink(spark.range(1), {"type": kind, "options": {"paths": folder}, "clear": "delete from t"})


def test_options_of_a_sink_end_with_the_write(spark, folder):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    options = {"paths": f"{folder}/out", "fileType": "parquet", "spark.sql.parquet.compression.codec": "gzip"}
    write_sink(spark.range(3), {"type": "hdfs", "options": options})
    assert spark.conf.get("spark.sql.parquet.compression.codec") == before
    assert spark.read.parquet(f"{folder}/out").count() == 3
