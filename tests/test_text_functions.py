from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tracemill.functions import arrays, blocks, parsing, percentiles, text


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "given", "expected"),
    [
        (text.normalize_answer, " \\boxed{ 4 2 }$ ", "42"),
        (text.normalize_answer, None, ""),
        (text.normalize_answer, "\\boxed{\\frac{1}{2}}", "\\frac{1{2}}"),
        (text.strip, "\t a b \r\n", "a b"),
        (text.strip_think, "<THINK>a</think> b", "a b"),
        (text.think_text, "<think> a </think>x<think>b</think>", "a\nb"),
        (text.think_text, "pre <think> open", "open"),
        (text.think_text, " none ", "none"),
        (text.clean_target, ": - The  answer。", "The answer"),
        (text.canonical_target, "\\boxed{X = 3}", "x=3"),
        (text.sentences, "A b. C?  D\n\nE", ["A b.", "C?", "D", "E"]),
        (text.logic_skeleton, "Ab1 ‘quote’ é+2", "‘ ’ é"),
        (text.lower, "İΣ ÉΣ", "iσ éσ"),
        (text.announced_answer, "We add. The final answer is 12.", "12"),
        (text.announced_answer, "We add.\n答案是 5。\nOk", "5"),
        (text.announced_answer, " ", None),
        (text.opens_block, "Step 2: go", True),
        (text.opens_block, "then go", False),
        (text.opens_block, "(3) item", True),
        (text.has_reasoning_signal, "also", True),
        (text.has_reasoning_signal, "hm", False),
        (text.is_non_supporting, "Wait, no", True),
        (text.is_non_supporting, "x = 3", False),
        (text.is_non_supporting, "I should add 3 and 4 apples", False),
        (text.coerce_bool, " Yes ", True),
        (text.coerce_bool, "0", False),
        (text.coerce_bool, "2.5", True),
        (text.coerce_bool, None, False),
        (text.is_clean_marker, "Let's see", True),
        (text.is_clean_marker, "Case 1", False),
        (text.is_clean_marker, "a b c d e f g h i", False),
        (text.json_strings, '["a", "b"]', ["a", "b"]),
        (text.json_strings, "[oops", None),
        (text.problem_key, "é", md5("é".encode()).hexdigest()),
    ],
)
def test_column_functions(spark, f, given, expected):
    assert one(spark, f("x"), given) == expected


def test_previews(spark):
    assert one(spark, text.preview("x", 3), "a  b  c d") == "a b..."
    assert one(spark, text.middle_out("x", 4, 1), "abcdef") == "a\n[...]\nf"


def test_boxes():
    assert parsing.boxed_values("\\boxed{a{b}} and \\boxed {c} and \\boxed{open") == ["a{b}", "c"]
    assert parsing.boxed_values("\\boxed{a\\}b}") == ["a\\}b"]
    assert parsing.last_boxed("\\boxed{1} \\boxed{2{3}} x") == "2{3}"
    assert parsing.last_boxed("\\boxed{open") == "open"
    assert parsing.last_boxed("y" * 300) == "y" * 200
    assert parsing.with_answer("a \\boxed{1} b \\boxed{2}", " 7 ") == "a \\boxed{7} b \\boxed{2}"
    assert parsing.with_answer("none\n\n", "7") == "none\nFinal Answer\n\\boxed{7}"
    assert parsing.closing_brace("{a\\{b}", 0) == 5


def test_targets(spark):
    given = ["x \\boxed{4}. \\boxed{ 4 } \\boxed{5}", "We add. The final answer is 12.", "Only this line", None, " ", "\\boxed{}"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string").select("i", parsing.targets("t").alias("y")).orderBy("i").collect()
    assert [r["y"] for r in rows] == [["4", "5"], ["12"], ["Only this line"], [], [], ["\\boxed{}"]]
    pairs = spark.createDataFrame([("\\text{abcdefghijklm}", "abcdefghijklx"), ("", ""), ("a", "b"), (None, "a")], "a string, b string")
    assert [r[0] for r in pairs.select(parsing.same_target("a", "b")).collect()] == [True, False, False, False]


def test_blocks():
    long = "x" * 40
    assert blocks.blocks_of(f"{long}\n\n{long}\n\nshort") == [long, long + "\nshort"]
    assert blocks.blocks_of(f"Step 1: {long}\nand more\nStep 2: {long}") == [f"Step 1: {long}\nand more", f"Step 2: {long}"]
    assert blocks.blocks_of(" <think> </think> ") == []
    paragraph = " ".join(f"Then {i} {'y' * 100}." for i in range(12))
    assert len(blocks.blocks_of(paragraph)) == 2
    assert blocks.logic_blocks("Step 1: a\nStep 2: b\n\nc") == ["Step 1: a", "Step 2: b", "c"]
    pattern = blocks.marker_pattern(["But wait", "Wait", "So"])
    text = f"Intro {long} So {long} but wait {long}"
    assert [b[:3] for b in blocks.marker_blocks(text, pattern)] == ["Int", "So ", "but"]


def test_filled_blocks_begin_where_allowed():
    parts = ["a" * 40] * 6
    assert blocks.filled(parts, 100).tolist() == [False, False, True, False, True, False]
    assert blocks.filled(parts, 100, free=[False, False, False, True, False, False]).tolist() == [False, False, False, True, False, False]
    assert blocks.filled(parts, 30, least=80).tolist() == [False, False, True, False, True, False]
    assert blocks.joined(["a", "b", "c"], [False, False, True], "-") == ["a-b", "c"] and blocks.joined([], [], "-") == []
    assert blocks.merged_short(["x" * 40, "y", "z" * 40], 28, "+") == ["x" * 40 + "+y", "z" * 40]
    assert blocks.form("Let x = 3, then value_2 \\frac{1}{2} \\ -4 é1b") == "VAR = , VAR VAR { }{ } \\ é"


def test_think_spans():
    assert parsing.with_think("a <think>old</think> b", "new") == "a <think>new</think> b" and parsing.with_think("plain", "new") == "new"
    assert parsing.think_span("a <think>old</think> b") == (9, 12) and parsing.think_span(None) is None


def test_forms_and_json():
    assert blocks.form_similarity("x = 3 gives value", "y = 4 gives thing") == 1.0
    assert blocks.form_similarity("", "a") == 0.0
    assert parsing.salvaged_json('text ```json\n{"a": 1}\n``` more') == '{"a": 1}'
    assert parsing.salvaged_json('so {"a": {"b": 2}} end') == '{"a": {"b": 2}}'
    assert parsing.salvaged_json("none") is None
    assert parsing.strings_of({"a": ["x", 1], "b": "y"}) == "xy"
    assert parsing.flat_text([{"content": "a"}, None, "b"]) == "a\nb"
    assert parsing.think_and_final("<think>a</think> b") == ("a", "b", True)
    assert parsing.rebuilt("a", "b", True) == "<think>\na\n</think>\n\nb"
    assert parsing.blocks_for_prompt(["a" * 10, "b" * 10], 25).endswith("more blocks truncated ...]")


def test_arrow_wrappers(spark):
    rows = spark.createDataFrame([("\\boxed{1}", "2"), (None, None)], "x string, a string")
    got = rows.select(parsing.udf_boxed("x").alias("b"), parsing.udf_with_answer("x", "a").alias("w"), blocks.udf_blocks("x").alias("k")).collect()
    assert got[0]["b"] == ["1"] and got[0]["w"] == "\\boxed{2}" and got[1]["b"] == [] and got[1]["k"] == []


def test_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b", "a"],)], "x array<string>")
    got = df.select(arrays.shingles(F.col("x"), 2, "|").alias("s"), arrays.shingles(F.col("x"), 6, "|").alias("e"), arrays.longest_non_blank(F.array(F.lit(" "), F.lit("ab"), F.lit("cd"))).alias("l")).first()
    assert got["s"] == ["a|b", "b|a", "a|b", "b|a"] and got["e"] == [] and got["l"] == "ab"
    assert df.select(arrays.most_common_count(F.col("x")).alias("n")).first()["n"] == 3


def test_percentiles_differ(spark):
    df = spark.range(1, 11).select(F.col("id").alias("v"))
    wanted = {"floor": percentiles.index_floor(0.7), "round": percentiles.index_round(0.7), "percent": percentiles.index_percent(10), "upper": percentiles.index_upper_median()}
    assert percentiles.at_index(df, "v", wanted).first().asDict() == {"floor": 8, "round": 7, "percent": 2, "upper": 6}
    assert df.select(percentiles.linear("v", 0.5)).first()[0] == 5.5
