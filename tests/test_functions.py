import hashlib

import pytest
from pyspark.sql import functions as F

from tuneweave.functions import chat, naming, text
from tuneweave.functions.hashing import in_fraction, order_hash, split_label


@pytest.mark.parametrize(
    "raw", ["", " a b ", " x　", "\x1c\x1fq\x85", "  in  side\t\n", " \t ", "no", " " * 50 + "x" + " " * 50]
)
def test_strip_and_blank(one, raw):
    assert one(text.strip(F.col("t")), t=raw) == raw.strip()
    assert one(text.is_blank(F.col("t")), t=raw) == (raw.strip() == "")


@pytest.mark.parametrize("raw", ["developer", "TOOL use", "", "éa"])
def test_capitalize(one, raw):
    assert one(text.capitalize(F.col("t")), t=raw) == raw.capitalize()


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 5])
def test_cutoff_keeps_inner_space(one, limit):
    raw = "  a\n\nb  c d "
    cut = {1: "  a", 2: "  a\n\nb", 3: "  a\n\nb  c"}.get(limit, raw)
    assert one(text.cutoff(F.col("t"), limit), t=raw) == cut


def test_cutoff_of_a_long_text(one):
    raw = "word " * 200_000
    assert one(F.length(text.cutoff(F.col("t"), 150_000)), t=raw) == 150_000 * 5 - 1


def test_clean_log_text(one):
    assert one(text.clean_log_text(F.col("t")), t="\x1b[1;31mred\x1b[0m\r\nb\rc\x1b[?25h") == "red\nb\nc"


def messages(spark, *pairs):
    rows = spark.createDataFrame([([{"role": r, "content": c} for r, c in pairs],)], "m array<struct<role:string,content:string>>")
    return lambda template, **kw: rows.select(chat.render_messages(template, F.col("m"), **kw)).first()[0]


def test_qwen_template(spark):
    render = messages(spark, ("system", " Be kind "), ("user", "　hi\t"), ("tool", "x"), ("assistant", "yo"), ("system", ""))
    assert render("qwen", eos="</s>", bos="<s>") == (
        "<s><|im_start|>system\nBe kind<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
        "<|im_start|>assistant\nyo<|im_end|></s><|im_start|>system\n<|im_end|>\n"
    )
    assert messages(spark, ("system", ""))("qwen") == ""
    assert messages(spark, ("system", " "))("qwen") == "<|im_start|>system\n<|im_end|>\n"
    assert messages(spark)("qwen", bos="<s>") == "<s>"


def test_fallback_template(spark):
    render = messages(spark, ("system", "s "), ("user", "u"), ("myTool", "x"))
    assert render("fallback", bos="<s>") == "<s>System: s\nUser: u\nMytool: x"
    assert render("fallback", eos="</s>") == "System: s</s>User: u</s>Mytool: x"


def test_select_template(one):
    pick = chat.select_template(F.col("a"), F.col("b"), F.col("n"))
    assert one(pick, a="own", b="x", n="Qwen") == "own"
    assert one(pick, a="", b="cls", n="Qwen") == "cls"
    assert one(pick, a=None, b=None, n="hub/QWEN2") == "qwen"
    assert one(pick, a=None, b="", n="gemma") == "fallback"


def test_messages_of_rows(one):
    built = chat.instruction_messages(F.col("i"), F.col("x"), F.col("o"))
    assert one(built[0]["content"], i="do", x="this", o="ok") == "do\n\nthis"
    assert one(built[0]["content"], i="do", x="", o="ok") == "do"
    assert one(chat.prompt_messages(F.col("i"))[0]["role"], i="do") == "system"


def test_hash_order_and_split(spark):
    assert spark.range(1).select(order_hash(F.lit(7), 42, "split")).first()[0] == hashlib.md5(b"42:split:7").hexdigest()
    h = F.lit("80000000" + "0" * 24)
    row = spark.range(1).select(in_fraction(h, 0.5), in_fraction(h, 0.50001), in_fraction(h, 1.0), in_fraction(h, 0.0)).first()
    assert tuple(row) == (False, True, True, False)
    n = spark.range(20_000).where(split_label(F.col("id"), 0.2, 1) == "validation").count()
    assert 3800 < n < 4200


def sanitized(value, fallback, limit=64):
    import re

    kept = value.encode("ascii", "ignore").decode().strip() or fallback
    slug = re.sub("[^a-z0-9]+", "-", kept.lower()).strip("-") or fallback
    if len(slug) <= limit:
        return slug
    return slug[: max(1, limit - 5)].rstrip("-") + "-" + hashlib.sha1(slug.encode()).hexdigest()[:4]


@pytest.mark.parametrize("raw", ["Qwen2.5-0.5B", "  é café Bar ", "---", "", "a" * 40, "ab-" * 9, "x.y__z"])
@pytest.mark.parametrize("limit", [6, 20, 64])
def test_slug(one, raw, limit):
    cfg = naming.Naming(max_segment_length=limit)
    assert one(naming.slug(F.col("t"), "model", cfg), t=raw) == sanitized(raw, "model", limit)


def test_slug_with_another_separator(one):
    assert one(naming.slug(F.col("t"), "m", naming.Naming(separator="_")), t=" A-b  c_") == "a_b_c"
    with pytest.raises(ValueError):
        naming.Naming(separator="--")


@pytest.mark.parametrize(
    "raw, path",
    [("\\custom\\path\\", "custom/path"), ("Outputs/a/../b/./c", "a/b/c"), ("outputs", ""), ("/x//y/", "x/y")],
)
def test_artifact_path(one, raw, path):
    assert one(naming.artifact_path(F.col("t")), t=raw) == path


def test_owning_run(one):
    assert one(naming.owning_run(F.col("t"), "/o/"), t="/o/run-1/merged") == "run-1"
    assert one(naming.owning_run(F.col("t"), "/o"), t="/o/a/../run-2") == "run-2"
    assert one(naming.owning_run(F.col("t"), "/o"), t="/o") is None
    assert one(naming.owning_run(F.col("t"), "/o"), t="/other/run-1") is None


def test_sizes_and_legacy_names(one):
    name = naming.legacy_name(F.col("m"), F.col("d"), F.col("n"))
    assert one(name, m="hub/qwen-2", d="hub/al-paca", n=32) == "al_paca_n32_qwen_2"
    assert one(naming.prepared_dir(F.col("d"), F.col("n")), d="hub/al-paca", n=0) == "al_paca_full"
