"""Sources, logs, metrics, streams and the run catalog."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tuneweave import session
from tuneweave.functions import naming
from tuneweave.operators import checkpoints, logs, metrics, runs, stages
from tuneweave.plans import corpus_queries, log_queries
from tuneweave.plans.prepare import prepare_rows
from tuneweave.session import scratch_path, stored
from tuneweave.sources import calibration, jsonl, listing, sinks
from tuneweave.sources.tables import read_instructions
from tuneweave.streaming import jobs

PARTS = [1, 4, 64]
HEAD = "2024-01-01 00:00:07 | INFO     | train | "


def lines(spark, rows, parts=4):
    return spark.createDataFrame(rows, "source string, line_no long, value string").repartition(parts)


# Sources


def test_line_numbers_over_many_blocks(spark, tmp_path):
    texts = {f"f{i}.jsonl": [f"line {i}.{j} " + "x" * (j % 50) for j in range(400 * i + 1)] for i in range(3)}
    for name, content in texts.items():
        (tmp_path / name).write_text("\n".join(content) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        numbered = jsonl.numbered_lines(spark, str(tmp_path))
        assert numbered.rdd.getNumPartitions() > 8
        rows = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for row in rows:
        got.setdefault(row.file.rsplit("/", 1)[1], {})[row.line_no] = row.value
    assert got == {name: {i + 1: line for i, line in enumerate(content)} for name, content in texts.items()}


def test_strict_records(spark):
    bad = ["{bad", '{"text":1}', '{"text":null}', '{"x":1}', '["l"]', '{"text":["a"]}', '"text"', "7"]
    good = ['{"text":""}', ' {"text":"hi", "more":[1]} ', '{"text":"a\\nb é"}']
    rows = [("f", i, v) for i, v in enumerate(["", " \t"] + bad + good)]
    checked = jsonl.check_records(lines(spark, rows))
    assert [r.text for r in jsonl.good_records(checked).orderBy("line_no").collect()] == ["", "hi", "a\nb é"]
    rejected = {r.value: r.reason for r in jsonl.rejected_records(checked).collect()}
    assert rejected == {v: "invalid_json" if v == "{bad" else "missing_text" for v in bad}


def test_strict_load_names_file_and_line(spark, tmp_path):
    (tmp_path / "train.jsonl").write_text('{"text":"a"}\n\n{"text":"b"}\n')
    assert {r.text for r in jsonl.load_strict(spark, str(tmp_path)).collect()} == {"a", "b"}
    assert [r.line_no for r in jsonl.numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == [1, 2, 3]
    (tmp_path / "val.jsonl").write_text('{"text":"a"}\n{"x":1}\n')
    with pytest.raises(ValueError, match="missing_text in .*val.jsonl at line 2"):
        jsonl.load_strict(spark, str(tmp_path))
    assert [(r.line_no, r.value) for r in jsonl.load_rejects(spark, str(tmp_path)).collect()] == [(2, '{"x":1}')]


def test_strict_load_wants_its_splits(spark, tmp_path):
    (tmp_path / "split=train").mkdir()
    (tmp_path / "split=train" / "part-0.json").write_text('{"text":"a"}\n')
    with pytest.raises(ValueError, match="no records of split validation"):
        jsonl.load_strict(spark, str(tmp_path), jsonl.REQUIRED_SPLITS)
    (tmp_path / "split=validation").mkdir()
    (tmp_path / "split=validation" / "part-0.json").write_text('{"text":"b"}\n')
    assert {r.text for r in jsonl.load_strict(spark, str(tmp_path), jsonl.REQUIRED_SPLITS).collect()} == {"a", "b"}


def test_strict_load_of_files_named_by_split(spark, tmp_path):
    for name in jsonl.REQUIRED_SPLITS:
        (tmp_path / f"{name}.jsonl").write_text('{"text":"%s"}\n' % name)
    rows = jsonl.load_strict(spark, str(tmp_path), jsonl.REQUIRED_SPLITS).collect()
    assert {r.text for r in rows} == set(jsonl.REQUIRED_SPLITS)


def test_malformed_lines_fail_lenient_loads(spark, tmp_path):
    (tmp_path / "val.jsonl").write_text('{"text":"a"}\n{cut\n')
    for load in (jsonl.load_validation, lambda s, p: calibration.load_calibration(s, p, ".jsonl")):
        with pytest.raises(Exception):
            load(spark, str(tmp_path)).collect()
    (tmp_path / "val.jsonl").write_text('{"text":"a"}\n{"text":1}\n')
    assert [r.text for r in jsonl.load_validation(spark, str(tmp_path)).collect()] == ["a"]


def test_lenient_load_and_missing_splits(spark, tmp_path):
    (tmp_path / "val.jsonl").write_text('{"text":"a"}\n{"text":""}\n{"x":1}\n{"text":" "}\n')
    assert {r.text for r in jsonl.load_validation(spark, str(tmp_path)).collect()} == {"a", " "}
    manifest = spark.createDataFrame([("train",), ("train",)], "split string")
    assert [r.split for r in jsonl.missing_splits(manifest).collect()] == ["validation"]


def test_calibration_formats(spark, tmp_path):
    (tmp_path / "c.txt").write_text(" a \n\n\t\nb\n")
    (tmp_path / "c.csv").write_text('text,n\n"x ""q""\ny",1\nz,2\n')
    (tmp_path / "c.jsonl").write_text('{"text":"j"}\n')
    (tmp_path / "blank.txt").write_text(" \n\n")
    load = lambda name: {r.text for r in calibration.load_calibration(spark, str(tmp_path / name), "." + name.split(".")[1]).collect()}
    assert load("c.txt") == {"a", "b"}
    assert load("c.csv") == {'x "q"\ny', "z"}
    assert load("c.jsonl") == {"j"}
    with pytest.raises(ValueError):
        load("blank.txt")


def test_listing_and_metadata(spark, tmp_path):
    rows = spark.createDataFrame([("r1", 0.5, 3), ("r2", 0.25, 4)], "run string, train_loss double, epochs int")
    sinks.write_summary(rows, str(tmp_path / "m"), "train", ["run"])
    files = listing.list_files(spark, str(tmp_path / "m"), "*.json")
    assert {r.dir.rsplit("=", 1)[1] for r in files.collect()} == {"r1", "r2"}
    found = listing.read_run_metadata(spark, str(tmp_path / "m"), "train struct<epochs int, train_loss double>")
    assert {(r.train.epochs, r.train.train_loss) for r in found.collect()} == {(3, 0.5), (4, 0.25)}
    path = next(p for p in (tmp_path / "m").rglob("*.json"))
    assert list(json.loads(path.read_text())["train"]) == ["epochs", "train_loss"]


def test_splits_are_written_as_text_records(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "train"), (2, "b", "validation")], "id long, text string, split string")
    sinks.write_splits(rows, str(tmp_path / "s"))
    kinds = {p.parent.name: json.loads(p.read_text()) for p in (tmp_path / "s").rglob("*.json")}
    assert kinds == {"split=train": {"text": "a"}, "split=validation": {"text": "b"}}


def test_scratch_folder(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_path(spark, "x").startswith(f"{root.rstrip('/')}/x-")
    assert stored(spark.range(3), "ids").count() == 3
    monkeypatch.setattr(session, "configured_root", lambda _: None)
    assert session.scratch_root(spark) == session.scratch_root(spark)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


# Logs


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("per_block, per_row", [(3, 2), (7, 100), (65_536, 1024)])
def test_stitching(spark, parts, per_block, per_row):
    rng = random.Random(1)
    rows, want = [("b", 5, "no header")], {}
    for source, n in (("a", 200), ("b", 20)):
        record, no = None, 10
        for i in range(n):
            no += rng.choice([1, 2, 5])
            if rng.random() < 0.2 or record is None:
                record, value = no, HEAD + f"m{i}"
            else:
                value = f"  trace {i}"
            rows.append((source, no, value))
            want.setdefault((source, record), []).append(value)
    got = logs.read_records(lines(spark, rows, parts), per_block, per_row).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r.segment):
        key = (r.source, r.record)
        texts[key] = texts[key] + "\n" + r.message if key in texts else HEAD + r.message
        assert r.level is not None
    assert texts == {k: "\n".join(v) for k, v in want.items()}


@pytest.mark.parametrize("per_block, per_row", [(3, 2), (65_536, 1024)])
def test_lines_before_the_first_header_are_rows(spark, per_block, per_row):
    texts = ["Traceback", " at x", "", " at y", HEAD + "one", " more", "2024-01-01 00:00:08 | ERROR    | train | two"]
    rows = [("cut", 40 + i, v) for i, v in enumerate(texts)] + [("none", 7, "no header"), ("whole", 0, HEAD + "three")]
    records = logs.read_records(lines(spark, rows), per_block, per_row, headless=True)
    got = {}
    for r in sorted(records.collect(), key=lambda r: r.segment):
        key = (r.source, r.record, r.ts is None, r.level, r.logger)
        got[key] = got[key] + "\n" + r.message if key in got else r.message
    assert got == {
        ("cut", None, True, None, None): "\n".join(texts[:4]),
        ("cut", 44, False, "INFO", "train"): "one\n more",
        ("cut", 46, False, "ERROR", "train"): "two",
        ("none", None, True, None, None): "no header",
        ("whole", 0, False, "INFO", "train"): "three",
    }
    kept = logs.at_least(records, "warning").collect()
    assert {(r.source, r.record) for r in kept} == {("cut", None), ("cut", 46), ("none", None)}


def test_queries_give_out_lines_before_the_first_header(spark, monkeypatch):
    cut = lines(spark, [("run", 3, "  ValueError: cut"), ("run", 4, HEAD + "one")])
    monkeypatch.setattr(log_queries, "log_lines", lambda *_: cut)
    assert {(r.record, r.message) for r in log_queries.records(spark, "").collect()} == {(None, "  ValueError: cut"), (4, "one")}
    assert [(r.record, r.level) for r in log_queries.warnings(spark, "").collect()] == [(None, None)]


def test_rotated_files_keep_the_record_of_the_file_before(spark):
    rows = [("log.1", 1, HEAD + "one"), ("log.1", 2, "Traceback"), ("log", 1, " at x"), ("log", 2, HEAD + "two"), ("other", 1, "cut")]
    files = spark.createDataFrame([("log.1", "a", 0), ("log", "a", 1), ("other", "b", 0)], "source string, run string, position int")
    got = logs.read_records(logs.rotated_lines(lines(spark, rows), files), headless=True).collect()
    assert {(r.source, r.message) for r in got} == {("a", "one\nTraceback\n at x"), ("a", "two"), ("b", "cut")}


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("budget", [1, 30, 100, 10_000])
@pytest.mark.parametrize("per_block", [4, 65_536])
def test_tails(spark, parts, budget, per_block):
    rows = [(s, i, "x" * (i * 7 % 13)) for s, n in (("a", 300), ("b", 9), ("c", 1)) for i in range(n)]
    df = lines(spark, rows, parts)
    got = {r.source: r.tail for r in logs.tail_chars(df, ["source"], budget).collect()}
    kept = logs.tail(df, ["source"], F.lit(1), budget, per_block=per_block).collect()
    for source in "abc":
        chunks = [r for r in rows if r[0] == source]
        assert {r.line_no for r in kept if r.source == source} == {r[1] for r in chunks[-budget:]}
        whole = [r[2] for r in chunks]
        while sum(map(len, whole)) > budget:
            whole.pop(0)
        assert got[source] == "".join(whole)


def test_levels_and_routing(spark, one):
    records = spark.createDataFrame([(n,) for n in logs.LEVELS] + [("odd",)], "level string")
    assert logs.at_least(records, "warning").count() == 5
    with pytest.raises(ValueError):
        logs.at_least(records, "loud")
    cases = {"plain": True, "{}": True, "{'a'": False, " {x} ": False, "z FINAL_EVAL_METRICS z": False, "\x1b[0m{ab": False}
    routed = logs.route(lines(spark, [("s", i, v) for i, v in enumerate(list(cases) + [""])])).collect()
    assert {r.value: r.to_console for r in routed if r.value} == cases
    assert [r.to_file for r in routed if r.value == ""] == [False]
    assert one(logs.cut_tail(F.col("t"), 3), t="abcde") == "cde" and one(logs.cut_tail(F.col("t"), 9), t=None) == ""


def test_environment_lines(spark):
    values = ["== banner ==", " PROJECT_ROOT=/app ", "DEBUG_PIPELINE=1", "lower=1", "SERVE_PORT=8080", "SERVE_PORT=a=b", "1X=2", "E="]
    env = logs.parse_env(lines(spark, [("p", i, v) for i, v in enumerate(values)]))
    assert {r.key: r.value for r in env.collect()} == {
        "PROJECT_ROOT": "/app",
        "DEBUG_PIPELINE": "1",
        "SERVE_PORT": "a=b",
        "E": "",
    }


# Metrics


METRIC_LINES = [
    ("r1", 1, HEAD + 'TRAIN_METRICS: {"step": 1, "loss": 0.5, "epoch": 0.1, "note": "n/a", "none": null}'),
    ("r1", 2, HEAD + "TRAIN_METRICS: {'step': 2, 'loss': 0.25, 'ok': True, 'x': None, 'text': 'None of it'}"),
    ("r1", 3, HEAD + 'FINAL_TRAIN_METRICS: {"step": 3, "train_loss": NaN, "train_tokens": 900}'),
    ("r1", 4, HEAD + 'FINAL_EVAL_METRICS: {"step": 3, "eval_loss": 1e-3}'),
    ("r1", 5, HEAD + "TRAIN_METRICS: not a dict"),
    ("r2", 1, HEAD + 'TRAIN_METRICS: {"step": 7, "loss": -Infinity, "lr": "2.5e-5", "d": "1d"}'),
    ("r2", 2, "plain"),
]


def test_metrics(spark):
    scalars = jobs.scalars(lines(spark, METRIC_LINES))
    got = {(r.source, r.step, r.tag): r.value for r in scalars.collect()}
    assert math.isnan(got.pop(("r1", 3, "train_loss")))
    assert got == {
        ("r1", 1, "loss"): 0.5,
        ("r1", 1, "epoch"): 0.1,
        ("r1", 2, "loss"): 0.25,
        ("r1", 2, "ok"): 1.0,
        ("r1", 3, "train_tokens"): 900.0,
        ("r1", 3, "eval_loss"): 0.001,
        ("r2", 7, "loss"): -math.inf,
        ("r2", 7, "lr"): 2.5e-5,
    }
    raw = {r.tag: r.raw for r in metrics.metric_events(lines(spark, METRIC_LINES)).where("step = 2").collect()}
    assert raw["text"] == "None of it"
    summary = {r.source: r for r in metrics.training_summary(scalars, 3).collect()}
    assert math.isnan(summary["r1"].train_loss) and math.isnan(summary["r2"].train_loss)
    assert (summary["r1"].eval_loss, summary["r1"].epochs, summary["r1"].total_tokens) == (0.001, 3.0, 900)
    assert (summary["r2"].eval_loss, summary["r2"].total_tokens) == (None, None)
    latest = {(r.source, r.kind, r.tag): (r.step, r.value) for r in metrics.metric_latest(scalars).collect()}
    assert latest["r1", "TRAIN_METRICS", "loss"] == (2, 0.25)


def test_streams_equal_batches(spark, tmp_path):
    """Two batches of files; a second run of the job sees the new files only."""
    rows = [("r%d" % (i % 3), i, HEAD + f'TRAIN_METRICS: {{"step": {i}, "loss": {i / 4}}}') for i in range(60)]
    rows += [("r9", i, "plain") for i in range(5)]
    landing, df = str(tmp_path / "in"), lines(spark, rows)
    follow = lambda: jobs.follow_parquet(spark, landing, "*.parquet", df.schema)
    out = {name: str(tmp_path / name) for name in ("series", "latest", "routed")}
    for part in (df.where("line_no < 30"), df.where("line_no >= 30")):
        part.write.mode("append").parquet(landing)
        jobs.append(follow(), out["series"], out["series"] + "-state", jobs.scalars).awaitTermination()
        jobs.write_latest(jobs.scalars(follow()), out["latest"], out["latest"] + "-state").awaitTermination()
        jobs.write_routed(follow(), out["routed"], out["routed"] + "-state").awaitTermination()
    same = lambda a, b: sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    batch = jobs.scalars(df)
    assert same(spark.read.parquet(out["series"]), batch)
    assert same(jobs.read_latest(spark, out["latest"]), metrics.metric_latest(batch))
    routed = logs.route(df)
    for target in ("console", "file"):
        want = routed.where(f"to_{target}").select("source", "line_no", "value")
        assert same(spark.read.parquet(f"{out['routed']}/{target}").drop("batch_id"), want)


def test_text_streams_carry_their_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "run.log").write_text(METRIC_LINES[0][2] + "\n")
    stream = jobs.follow_text(spark, str(tmp_path / "in"))
    jobs.append(stream, str(tmp_path / "out"), str(tmp_path / "state"), jobs.scalars).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.tag for r in got} == {"loss", "epoch"} and got[0].source.endswith("/in/run.log")


def test_scalar_sink(spark, tmp_path):
    rows = spark.createDataFrame([("r", 2_000_001, "loss", 1.0), ("r", 1, "loss", 2.0)], "source string, step long, tag string, value double")
    sinks.write_scalars(rows, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


# Run names


REQUEST = "request_id long, base_model string, dataset_name string, sample_size long, explicit_name string, forced_index long, use_legacy boolean"


def name(spark, taken, cfg=naming.Naming(), *more):
    first = (1, "hub/Qwen2.5-05B", "hub/alpaca", 2048, None, None, None)
    requests = spark.createDataFrame([first, *more], REQUEST)
    rows = runs.name_runs(requests, spark.createDataFrame([(t,) for t in taken], "name string"), cfg).collect()
    return {r.request_id: r for r in rows}


PREFIX = "run-qwen2-5-05b-alpaca-n2048"


@pytest.mark.parametrize("limit", [10_000, 3])
def test_smallest_free_index(spark, monkeypatch, limit):
    monkeypatch.setattr(runs, "FIRST_INDICES", limit)
    used = [[], [1], [1, 2, 4], [2], list(range(1, 7)), [1, 2, 3, 4, 5, 9]]
    taken = [f"run-qwen2-5-05b-data{d}-full-run{i}" for d, numbers in enumerate(used) for i in numbers]
    more = [(10 + d, "hub/Qwen2.5-05B", f"data{d}", None, None, None, None) for d in range(len(used))]
    rows = name(spark, taken + ["other", "Bad-run1", "tmp"], naming.Naming(), *more)
    for d, index in enumerate([1, 2, 3, 1, 7, 6]):
        row, prefix = rows[10 + d], f"run-qwen2-5-05b-data{d}-full"
        assert (row["index"], row["name"], row.prefix, row.error) == (index, f"{prefix}-run{index}", prefix, None)
    assert rows[1]["name"] == f"{PREFIX}-run1"


def test_prefixes_match_both_ways(spark):
    taken = ["run-run1", "run-qwen2-5-05b-run2", f"{PREFIX}-more-run3", "run-other-run4", "ru-run4"]
    assert name(spark, taken)[1]["index"] == 5
    assert name(spark, taken[:3] + ["run-other-run4"])[1]["index"] == 4
    assert name(spark, ["x-run1", "y-run2"], naming.Naming(scope="global"))[1]["index"] == 3
    assert name(spark, ["run-qwen2-5-05b-zzz-run1"], naming.Naming(scope="model"))[1]["index"] == 2


def test_other_ways_to_name(spark):
    base = ("hub/q", "hub/d-x", None)
    rows = name(
        spark,
        ["run-q-d-x-full-run7"],
        naming.Naming(),
        (2, *base, "qwen2-5-05b-alpaca-n2048-run3", None, None),
        (3, *base, "no index", None, None),
        (4, *base, None, 7, None),
        (5, *base, None, 8, None),
        (6, *base, None, 0, None),
        (7, *base, "ignored-run1", 3, True),
    )
    assert (rows[2]["index"], rows[2].prefix, rows[2].error) == (3, "qwen2-5-05b-alpaca-n2048", None)
    assert rows[3].error == "malformed_name" and rows[3]["name"] is None
    assert (rows[4].error, rows[5].error, rows[6].error) == ("index_taken", None, "index_not_positive")
    assert rows[5]["name"] == "run-q-d-x-full-run8"
    assert (rows[7]["name"], rows[7]["index"], rows[7].mode) == ("d_x_full_q", -1, "legacy")


def test_shortened_names_step_past_existing_ones(spark):
    cfg = naming.Naming(max_segment_length=12, max_name_length=20)
    first = name(spark, [], cfg)[1]
    assert len(first["name"]) <= 20 and first["index"] == 1
    taken = [first["name"]] + [first["name"][:-1] + str(i) for i in (2, 3, 5)]
    row = name(spark, taken, cfg)[1]
    assert row["index"] == 4 and row["name"] == first["name"][:-1] + "4"
    row = name(spark, [first["name"][:-1] + str(i) for i in range(1, 10)], cfg)[1]
    assert row["index"] == 10 and len(row["name"]) <= 20 and row["name"].endswith("-run10")


def test_latest_run(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "run string, touched_at long")
    assert runs.latest_run(rows).first().run == "c"


# Checkpoints and stages


FILES = [
    ("/o/r1/ts/checkpoint-5", "pytorch_model.bin"),
    ("/o/r1/ts/checkpoint-50", "adapter_model.safetensors"),
    ("/o/r1/ts/checkpoint-x", "model.safetensors"),
    ("/o/r1/ts/checkpoint-99", "optimizer.pt"),
    ("/o/r1/ts", "trainer_state.json"),
    ("/o/r2/ts", "trainer_state.json"),
    ("/o/r3/ts", "pytorch_model.safetensors"),
    ("/o/r3/ts/checkpoint-1", "adapter_model.bin"),
    ("/o/r4/ts/checkpoint-x", "model.safetensors"),
]


def test_checkpoints(spark):
    files = spark.createDataFrame(FILES, "dir string, file string")
    assert checkpoints.valid_checkpoints(files).count() == 6
    found = {r.target: r.checkpoint for r in checkpoints.locate_checkpoints(files).collect()}
    assert found["/o/r1/ts"] == "/o/r1/ts/checkpoint-50"
    assert found["/o/r2/ts"] == "/o/r2/ts" and found["/o/r3/ts"] == "/o/r3/ts"
    assert found["/o/r4/ts"] == "/o/r4/ts/checkpoint-x"
    assert "/o/r1/ts/checkpoint-99" not in found


@pytest.mark.parametrize(
    "asked, run, want",
    [
        (None, "r1", None),
        ("null", "r1", None),
        ("latest", "r1", "/o/r1/ts/checkpoint-50"),
        ("latest", "r9", None),
        ("checkpoint-5", "r1", "/o/r1/ts/checkpoint-5"),
        ("ts\\checkpoint-5", "r1", "/o/r1/ts/checkpoint-5"),
        ("r1/ts/checkpoint-5", "r1", "/o/r1/ts/checkpoint-5"),
        ("r1", "r1", None),
        ("/o/r3/ts/../ts", "r1", "/o/r3/ts"),
        ("/o/r1/ts/checkpoint-99/optimizer.pt", "r1", "/o/r1/ts/checkpoint-99/optimizer.pt"),
        ("missing", "r1", None),
    ],
)
def test_resume(spark, asked, run, want):
    request = spark.createDataFrame([(1, asked, f"/o/{run}/ts")], "request_id long, requested string, default_path string")
    row = checkpoints.resolve_resume(request, spark.createDataFrame(FILES, "dir string, file string")).first()
    status = "not_requested" if asked in (None, "null") else "resolved" if want else "not_found"
    assert (row.checkpoint, row.status) == (want, status)


def test_served_artifact(spark):
    rows = [("a", "\\custom\\path\\", True), ("b", None, True), ("c", None, True), ("d", "NONE", False), ("e", "", True)]
    there = spark.createDataFrame([("b/merged_awq",), ("d/merged_awq",)], "path string")
    got = checkpoints.served_artifact(spark.createDataFrame(rows, "run string, override string, prefer_quantised boolean"), there)
    assert {r.run: (r.served_path, r.source) for r in got.collect()} == {
        "a": ("custom/path", "override"),
        "b": ("b/merged_awq", "awq"),
        "c": ("c/merged", "merged"),
        "d": ("d/merged", "merged"),
        "e": ("e/merged", "merged"),
    }


def test_adapters(spark):
    rows = spark.createDataFrame([("/o/a/adapter", 1), ("/o/b/adapter", 5), ("/o/c/adapter", 5)], "path string, mtime long")
    assert checkpoints.latest_adapter(rows).first().path == "/o/c/adapter"


def test_stages(spark):
    requests = spark.createDataFrame([(1, "a", "eval-sft"), (2, "b", " Eval-SFT "), (3, "b", "preprocess-sft")], "request_id long, run string, stage string")
    guarded = stages.stage_guard(requests, spark.createDataFrame([("a",)], "run string"))
    assert {r.request_id: r.status for r in guarded.collect()} == {1: "allowed", 2: "blocked", 3: "allowed"}
    rows = [("a", 1, "export-merged", 0), ("a", 2, "plot", 1), ("a", 3, "eval-sft", 2), ("a", 4, "plot", 0), ("b", 1, "serve-vllm", 0)]
    chain = stages.stage_chain(spark.createDataFrame(rows, "run string, position long, stage string, returncode int"))
    assert [r.status for r in chain.orderBy("run", "position").collect()] == ["ok", "unknown_stage", "failed", "not_run", "ok"]


def test_attempts(spark):
    rows = [("a", 1, 2), ("a", 2, 0), ("b", 1, 3), ("b", 2, 2), ("b", 3, 4), ("c", 1, 0)]
    rolled = stages.attempt_rollup(spark.createDataFrame(rows, "run string, attempt int, returncode int"), 3)
    assert {r.run: (r.n_attempts, r.returncode, r.wait_seconds) for r in rolled.collect()} == {
        "a": (2, 0, 5),
        "b": (3, 4, 15),
        "c": (1, 0, 0),
    }


def test_reuse(spark):
    rows = spark.createDataFrame([("d", 1), ("d", 2)], "dataset string, size int")
    prints = rows.withColumn("fingerprint", stages.fingerprint(F.col("dataset"), F.col("size")))
    assert [r["size"] for r in stages.not_prepared(prints, prints.where("size = 1")).collect()] == [2]


def test_prepared_stream_reads_a_table_of_one_or_many_files(spark, tmp_path):
    texts = ["one two", " ", "three", "four five"] * 3
    rows = [(i, "web", ["en", "fr", "de"][i % 3], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    df.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "parts"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "parts").glob("*.parquet")).rename(tmp_path / "one" / "documents.parquet")
    want = prepare_rows(read_instructions(df, corpus_queries.MAPPING), corpus_queries.PARAMS)
    for name in ("many", "one"):
        got = corpus_queries.stream_prepare(spark, str(tmp_path / name))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_checkpoints_are_found_in_one_shuffle_of_plain_rows(spark):
    rows = [
        ("r/a", "trainer_state.json"), ("r/a/checkpoint-9", "model.safetensors"), ("r/a/checkpoint-10", "adapter_model.bin"),
        ("r/a/checkpoint-10", "adapter_model.bin"), ("r/a/checkpoint-10", "model.safetensors"), ("r/a/checkpoint-x", "model.safetensors"),
        ("r/b", "trainer_state.json"), ("r/b", "model.safetensors"), ("r/b/checkpoint-3", "model.safetensors"), ("r/c", "trainer_state.json"),
        ("r/d", "other"), ("r/e", None), ("checkpoint-7", "model.safetensors"), ("r/f/checkpoint-2", "model.safetensors"),
        ("r/f/checkpoint-02", "model.safetensors"),
    ]
    files = spark.createDataFrame(rows, "dir string, file string")
    found, valid = checkpoints.locate_checkpoints(files), checkpoints.valid_checkpoints(files)
    for df in (found, valid):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The rows are shuffled as they are: no aggregate below the exchange.
        assert plan.count("Exchange ") == 1 and "Aggregate" not in plan[plan.index("Exchange ") :]
    ones = {"r/a/checkpoint-9", "r/a/checkpoint-10", "r/a/checkpoint-x", "r/b/checkpoint-3", "r/f/checkpoint-2", "r/f/checkpoint-02"}
    want = {d: d for d in ones | {"r/b", "r/c", "checkpoint-7"}}
    want |= {"r/a": "r/a/checkpoint-10", "r/f": "r/f/checkpoint-2"}
    assert {r.target: r.checkpoint for r in found.collect()} == want and found.count() == len(want)
    assert sorted(r.dir for r in valid.collect()) == sorted({d for d, f in rows if f in checkpoints.WEIGHT_FILES})
