"""Chat templates compiled from text, stitched streams, the tail source and the growing sample."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tuneweave.functions import chat
from tuneweave.functions.templates import TemplateError, check_template, compile_template, render_by_template
from tuneweave.operators import evaluation, logs, sampling
from tuneweave.operators.growing import GrowingSample
from tuneweave.params import PrepareParams
from tuneweave.plans import prepare
from tuneweave.plans.corpus_queries import OWN_TEMPLATES
from tuneweave.sources import onefile
from tuneweave.streaming import jobs, tail

# The two templates whose built-in forms are `render_qwen` and `render_fallback`.
QWEN = (
    "{% set eos = eos_token if eos_token else '' %}{% set bos = bos_token if bos_token else '' %}{% if messages %}"
    "{% set system_prompt = '' %}{% if messages[0]['role'] == 'system' %}{% set system_prompt = messages[0]['content'] %}"
    "{% set messages = messages[1:] %}{% endif %}{{ bos }}"
    "{% if system_prompt %}<|im_start|>system\n{{ system_prompt | trim }}<|im_end|>\n{% endif %}{% for message in messages %}"
    "{% if message['role'] == 'user' %}<|im_start|>user\n{{ message['content'] | trim }}<|im_end|>\n"
    "{% elif message['role'] == 'assistant' %}<|im_start|>assistant\n{{ message['content'] | trim }}<|im_end|>{{ eos }}"
    "{% elif message['role'] == 'system' %}<|im_start|>system\n{{ message['content'] | trim }}<|im_end|>\n{% endif %}"
    "{% endfor %}{% else %}{{ bos }}{% endif %}"
)
FALLBACK = (
    "{% set role_map = {'user': 'User', 'assistant': 'Assistant', 'system': 'System'} %}{% if bos_token %}{{ bos_token }}{% endif %}"
    "{% for message in messages %}{% set role = role_map.get(message['role'], message['role'].capitalize()) %}"
    "{{ role }}: {{ message['content'] | trim }}"
    "{% if not loop.last %}{% if eos_token %}{{ eos_token }}{% else %}\n{% endif %}{% endif %}{% endfor %}"
)
TALKS = [
    [],
    [("system", "")],
    [("system", " be brief "), ("user", "hi\n"), ("assistant", "yes"), ("tool", "x"), ("user", "\u00a0bye")],
    [("user", "a"), ("system", ""), ("system", "later"), ("assistant", "")],
    [("tOOL call", "x"), ("user", None)],
]
MESSAGES = "id int, messages array<struct<role:string,content:string>>"


def talks(spark):
    return spark.createDataFrame(list(enumerate(TALKS)), MESSAGES)


def texts(df, column="text"):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


@pytest.mark.parametrize("name", ["qwen", "fallback"])
@pytest.mark.parametrize(("eos", "bos"), [("<e>", ""), ("", "<s>"), ("", "")])
def test_compiled_templates_equal_the_built_in_ones(spark, name, eos, bos):
    render = compile_template({"qwen": QWEN, "fallback": FALLBACK}[name], trim_blocks=False, lstrip_blocks=False)
    df = talks(spark).select("id", render(F.col("messages"), eos_token=eos or None, bos_token=bos or None).alias("a"),
                             chat.render_messages(name, F.col("messages"), eos, bos).alias("b"))
    assert texts(df, "a") == texts(df, "b")


@pytest.mark.parametrize(
    ("template", "want"),
    [
        ("{{ messages | length }}{# note #}{{ messages[-1].role }}{{ missing }}{{ missing.deeper }}", ["0", "1system", "5user", "4assistant", "2user"]),
        ("{% if tools is defined %}T{% elif messages is not none %}M{% endif %}", ["M"] * 5),
        ("  {% if true %}\nx\n  {%- endif %}\n y", ["x y"] * 5),
        ("{% for m in messages %}{{ loop.index0 }}{{ '.' if not loop.last }}{% endfor %}", ["", "0", "0.1.2.3.4", "0.1.2.3", "0.1"]),
        ("{% for m in messages if m.role in ['user', 'tool'] %}{{ loop.length }}{{ m.role[0:] if false else m.role }}{% endfor %}", None),
        ("{% set x = 'a' %}{% if messages %}{% set x = x ~ 'b' %}{% endif %}{% for m in messages %}{% set x = 'c' %}{% endfor %}{{ x }}", ["a", "ab", "ab", "ab", "ab"]),
        ("{{ 'it\\'s' + \"\\n\" ~ (1 + 2) % 2 }}{{ none | default('d') }}{{ 'A-b'.lower() }}", ["it's\n1da-b"] * 5),
        ("{{ messages[0]['content'] == '' and not messages[9] or false }}", ["False", "True", "False", "False", "False"]),
    ],
)
def test_template_language(spark, template, want):
    if want is None:
        with pytest.raises(TemplateError):
            check_template(template)
        return
    assert texts(talks(spark).select("id", compile_template(template)(F.col("messages")).alias("text"))) == want


@pytest.mark.parametrize(
    "bad",
    ["{% macro x() %}{% endmacro %}", "{{ x", "{% if a %}", "{{ messages }}", "{{ a | tojson }}", "{% set ns = namespace(x=1) %}", "{% for m in 'x' %}{% endfor %}", "{{ messages[1:2] }}", "{{ 1 2 }}", "{{ a @ b }}"],
)
def test_unsupported_templates_are_errors(spark, bad):
    with pytest.raises(TemplateError):
        check_template(bad)


def test_template_exceptions_and_templates_by_row(spark):
    strict = "{% for m in messages %}{% if m.role == 'tool' %}{{ raise_exception('no tools') }}{% endif %}{{ m.role }} {% endfor %}"
    rows = talks(spark).withColumn("template", F.when(F.col("id") == 2, F.lit(None).cast("string")).otherwise(strict))
    assert texts(render_by_template(rows, "template", "messages")) == ["", "system ", None, "user system system assistant ", "tOOL call user "]
    with pytest.raises(Exception, match="no tools"):
        render_by_template(rows.withColumn("template", F.lit(strict)), "template", "messages").collect()
    mixed = talks(spark).withColumn("template", F.get(F.array(*map(F.lit, [*OWN_TEMPLATES, QWEN, FALLBACK])), F.col("id")))
    assert all(t is not None for t in texts(render_by_template(mixed, "template", "messages", bos_token="<s>")))
    many = spark.range(201).select(F.col("id").cast("string").alias("template"), F.expr("cast(array() as array<struct<role:string,content:string>>)").alias("messages"))
    with pytest.raises(TemplateError, match="more than"):
        render_by_template(many, "template", "messages")


HEAD = "2024-05-01 10:00:00 | {:<8} | train | "


def log_rows(seed):
    """Lines of sources with headers, long records and lines before the first header."""
    rnd, rows = random.Random(seed), []
    for source in range(5):
        for i in range(rnd.randrange(1, 60)):
            header = rnd.random() < 0.3 and not (source == 4)
            value = HEAD.format(rnd.choice(["INFO", "ERROR"])) + f"m{i}" if header else rnd.choice(["", "  at x", "Traceback", "2024-05-01 bad | x"])
            rows.append((f"r{source}", 3 * i + source, value))
    return rows


@pytest.mark.parametrize(("seed", "cuts"), [(1, [20, 90]), (3, [])])
def test_stitched_stream_equals_the_batch(spark, tmp_path, seed, cuts):
    rows = log_rows(seed)
    df = spark.createDataFrame(rows, "source string, line_no long, value string")
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    edges = [-1, *cuts, 10**9]
    for low, high in zip(edges, edges[1:]):
        df.where((F.col("line_no") > low) & (F.col("line_no") <= high)).repartition(3).write.mode("append").parquet(landing)
        if high == edges[-1]:
            df.groupBy("source").agg(F.lit(10**9).cast("long").alias("line_no")).withColumn("value", F.lit(None).cast("string")).write.mode("append").parquet(landing)
        # A run of its own each time: the open records come from the state of the run before.
        jobs.write_stitched(jobs.follow_parquet(spark, landing, "*.parquet", df.schema), out, state, per_row=4).awaitTermination()
    got = spark.read.parquet(out)
    want = logs.read_records(df, per_block=16, per_row=4, headless=True)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_open_records_leave_after_a_time_out(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, HEAD.format("INFO") + "x"), ("a", 1, "more")], "source string, line_no long, value string")
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.follow_parquet(spark, str(tmp_path / "in"), "*.parquet", df.schema)
    query = jobs.stitch_stream(stream, timeout=500).writeStream.format("memory").queryName("stitched").trigger(processingTime="300 milliseconds")
    running = query.option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        for _ in range(120):
            running.exception() and pytest.fail(str(running.exception()))
            if spark.table("stitched").count():
                break
            running.awaitTermination(1)
        assert [(r.record, r.level, r.message) for r in spark.table("stitched").collect()] == [(0, "INFO", "x\nmore")]
    finally:
        running.stop()


def test_tail_reads_appended_lines_once(spark, tmp_path):
    folder, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    log = folder / "run.log"

    def run():
        stream = tail.follow(spark, str(folder), str(tmp_path / "reg" / "known.json"), pattern="*.log*", split="16")
        jobs.append(stream, out, state, lambda s: s).awaitTermination()
        rows = spark.read.parquet(out).collect() if os.path.exists(out) else []
        return sorted((os.path.basename(r.source), r.line_no, r.value) for r in rows)

    log.write_bytes(b"one\n\ntwo\r\nthree is a longer line than a split\nhalf")
    want = [("run.log", 0, "one"), ("run.log", 4, ""), ("run.log", 5, "two"), ("run.log", 10, "three is a longer line than a split")]
    assert run() == want
    with log.open("ab") as file:
        file.write(b" and the rest\nfour\n")
    want += [("run.log", 46, "half and the rest"), ("run.log", 64, "four")]
    assert run() == want == run()
    # Rotated: the renamed file is known, the new one goes on behind it in the same source.
    with log.open("ab") as file:
        file.write(b"last\n")
    log.rename(folder / "run.log.1")
    assert run() == (want := [*want, ("run.log", 69, "last")])
    log.write_bytes(b"new\n\xff\n")
    assert run() == (want := [*want, ("run.log", 74, "new"), ("run.log", 78, "\ufffd")])
    # Truncated in place, and another file.
    log.write_bytes(b"x\n")
    (folder / "b.log").write_bytes(b"other\n")
    assert run() == sorted([*want, ("run.log", 80, "x"), ("b.log", 0, "other")])
    lines = spark.read.parquet(out)
    counted = tail.numbered(lines, block=8).where("source like '%run.log'").orderBy("line_no").collect()
    assert [r.line_no for r in counted] == list(range(10)) and counted[-1].value == "x"


def test_tail_splits_and_renamed_files(tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"".join(b"%d\n" % i for i in range(5000)) + b"rest")
    reader = tail.TailReader({"path": f"file://{tmp_path}", "registry": str(tmp_path / "reg.json"), "split": "1000"})
    end = json.loads(json.dumps(reader.latestOffset() if not (tmp_path / "reg.json").exists() else {}))
    splits = [s for s in reader.partitions({}, end) if s.path.endswith("a.log")]
    path.rename(tmp_path / "b.log")
    rows = [r for s in splits for r in reader.read(s)]
    assert len(splits) > 20 and [r[2] for r in rows] == [str(i) for i in range(5000)]
    assert [r[1] for r in rows] == sorted({r[1] for r in rows})
    (tmp_path / "b.log").unlink()
    with pytest.raises(FileNotFoundError):
        list(reader.read(splits[0]))


def test_tail_reads_many_small_files_in_few_tasks(tmp_path):
    for i in range(600):
        (tmp_path / f"run-{i}.log").write_text(f"a{i}\nb{i}\n")
    reader = tail.TailReader({"path": str(tmp_path), "registry": str(tmp_path / "reg.json"), "pattern": "*.log"})
    first = json.loads(json.dumps(reader.latestOffset()))
    tasks = reader.partitions({}, first)
    assert len(tasks) <= 4
    got = {(os.path.basename(r[0]), r[1], r[2]) for t in tasks for r in reader.read(t)}
    assert got == {(f"run-{i}.log", at, text) for i in range(600) for at, text in ((0, f"a{i}"), (len(f"a{i}") + 1, f"b{i}"))}
    with (tmp_path / "run-7.log").open("a") as file:
        file.write("c\n")
    later = reader.partitions(first, json.loads(json.dumps(reader.latestOffset())))
    assert [r[2] for t in later for r in reader.read(t)] == ["c"]


@pytest.mark.parametrize("n", [7, 500])
def test_growing_sample_equals_the_sample_of_all_rows(spark, tmp_path, n):
    rnd = random.Random(n)
    parts = [[(i, f"t{i}") for i in range(a, b)] for a, b in [(0, 30), (30, 31), (31, 31), (31, 120)]]
    parts[3] += [(None, "no key"), *rnd.sample(parts[0], 5), (119, "again")]
    kept, seen = GrowingSample(spark, str(tmp_path / "s"), n, "id", 4), {}
    assert kept.versions() == []
    for version, part in enumerate(parts):
        df = spark.createDataFrame(part, "id long, text string").repartition(2)
        before = {r.id for r in kept.keys().collect()} if version else set()
        kept.add(df, version)
        if version == 1:
            kept.add(df, version)  # replayed
        for key, text in part:
            if key is not None:
                seen.setdefault(key, text)
        everything = spark.createDataFrame(list(seen.items()), "id long, text string")
        want = {(r.id, r.text) for r in sampling.sample_n(everything, n, "id", 4).collect()}
        got = kept.rows().collect()
        # One of the rows of a key that came twice at once is kept.
        assert {r.id for r in got} == {k for k, _ in want} and len(got) == len(want)
        assert {(r.id, r.text) for r in got if r.id != 119} == {w for w in want if w[0] != 119}
        now = {k for k, _ in want}
        changes = {(r.id, r.change) for r in kept.changes(version).collect()}
        assert changes == {(k, "entered") for k in now - before} | {(k, "left") for k in before - now}
    assert kept.versions() == [0, 1, 2, 3]
    split = [r.split for r in kept.splits(0.2).collect()]
    assert split.count("validation") == -(-len(now) // 5) and len(split) == len(now)
    with pytest.raises(ValueError):
        GrowingSample(spark, "x", 0, "id", 1)


def test_the_increment_of_a_full_sample_is_filtered_by_its_last_row(spark, tmp_path):
    kept = GrowingSample(spark, str(tmp_path / "s"), 3, "id", 4)
    kept.add(spark.range(100).withColumn("text", F.lit("x")), 0)
    kept.add(spark.range(100, 2000).withColumn("text", F.lit("y")), 1)
    entered = spark.read.parquet(str(tmp_path / "s" / "rows" / "version=1"))
    assert entered.count() <= 3 and re.fullmatch(r"[0-9a-f]{32}", kept.keys().first()["_hash"])


def test_one_file_is_replaced_whole_or_not_at_all(spark, tmp_path):
    path = tmp_path / "run" / "metadata.json"
    row = spark.sql("select 2 as b, struct('é' as z, array(1) as a, cast(null as int) as n) as a")
    onefile.write_one(row, str(path))
    assert list(json.loads(path.read_text())["a"]) == ["a", "n", "z"] and os.listdir(path.parent) == ["metadata.json"]
    before = path.read_text()
    for bad in (row.union(row), row.limit(0), row.withColumn("c", F.raise_error(F.lit("stop")))):
        with pytest.raises(Exception, match="takes one row|stop"):
            onefile.write_one(bad, f"file:{path}")
        assert path.read_text() == before and os.listdir(path.parent) == ["metadata.json"]
    onefile.write_one(spark.sql("select 1 as only"), f"file://{path}")
    assert json.loads(path.read_text()) == {"only": 1}


@pytest.mark.parametrize(("size", "languages"), [(None, None), (2, ["en"]), (50, ["en", "fr"])])
def test_figures_of_the_pass_that_writes(spark, tmp_path, size, languages):
    rows = [(i, "q", None, ["text", "", None, " "][i % 4], ["en", "fr", None][i % 3]) for i in range(40)]
    corpus = spark.createDataFrame(rows, "id long, instruction string, input string, output string, lang string")
    params = PrepareParams(sample_size=size, languages=languages, seed=3)
    prepared, figures = prepare.prepare_and_count(corpus, params)
    prepared.write.parquet(str(tmp_path / "out"))
    want = prepare.preprocess_summary(corpus, params)
    assert prepare.observed_summary(spark, figures, params).select(want.columns).collect() == want.collect()
    assert spark.read.parquet(str(tmp_path / "out")).count() == want.first().sample_size


def test_worst_cases(spark):
    rows = [(i, i % 2, "x" if i % 10 else "y", i % 3 > 0, i % 5 > 0, i % 7) for i in range(200)]
    checked = spark.createDataFrame(rows, "conv int, turn int, lang string, language_pass boolean, length_pass boolean, new_tokens int")
    got = evaluation.worst_cases(checked, 3, "lang", ["conv", "turn"], parts=4).collect()
    for lang in "xy":
        own = sorted((a + b, -n, c, t) for c, t, l, a, b, n in rows if l == lang)[:3]
        assert sorted((r.rank, r.conv) for r in got if r.lang == lang) == [(i, o[2]) for i, o in enumerate(own, 1)]
