"""C1, C2, J1, J3, J4, J7 on literal rows."""

from pyspark.sql import functions as F

from chatmill.config import PY_WHITESPACE, SCRATCHPAD_TEXT, SYSTEM_PROMPT
from chatmill.functions.templates import build_text, render_instruction, render_output
from chatmill.functions.text import clean_text, first_nonempty, py_rtrim, py_trim


def test_whitespace_constant_is_python_isspace():
    assert {c for c in PY_WHITESPACE} == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_py_trim_matches_str_strip(spark):
    samples = [PY_WHITESPACE + "a b" + PY_WHITESPACE, "\u200bx\u200b", "\ufeffx", "  ", "", "\u3000\u00e9 ",
               "x\x85", "\x1cq\x1f"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(py_trim("s").alias("t"), py_rtrim("s").alias("r")).collect()
    assert [r.t for r in got] == [s.strip() for s in samples]
    assert [r.r for r in got] == [s.rstrip() for s in samples]


def test_clean_text_null_is_empty(spark):
    df = spark.createDataFrame([(None,), ("  x ",)], "s string")
    assert [r[0] for r in df.select(clean_text("s")).collect()] == ["", "x"]


def test_first_nonempty_blank_wins_before_trim(spark):
    df = spark.createDataFrame([("  ", "T", None), (None, "", "C"), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(first_nonempty("a", "b", "c")).collect()]
    assert got == ["  ", "C", ""]
    got = [r[0] for r in df.select(py_trim(first_nonempty("a", "b", "c"))).collect()]
    assert got == ["", "C", ""]


def _py_instruction(q, ctx):
    return ("<|im_start|>system\n" + SYSTEM_PROMPT + "\n<|im_end|>\n<|im_start|>user\n"
            + "Question: " + q.strip() + "\n\n" + "Context:\n" + ctx.strip() + "\n"
            + "<|im_end|>\n<|im_start|>assistant")


def _py_output(a):
    return "<scratchpad>" + SCRATCHPAD_TEXT + "</scratchpad>" + "\n" + "<final>" + a.strip() + "</final>\n<|im_end|>"


def test_templates_literal(spark):
    rows = [(" Who? ", "\tPassage é\n", " Bob "), ("q", "c", "")]
    df = spark.createDataFrame(rows, "q string, c string, a string")
    got = df.select(render_instruction("q", "c").alias("i"), render_output("a").alias("o")).collect()
    for (q, c, a), r in zip(rows, got):
        assert r.i == _py_instruction(q, c)
        assert r.o == _py_output(a)


def test_build_text(spark):
    df = spark.createDataFrame([("ins  \n", "out\u3000"), (None, "o")], "instruction string, output string")
    got = [r[0] for r in df.select(build_text()).collect()]
    assert got == ["ins\n\nout\n", "\n\no\n"]
