"""Records in the forms that training reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.arrays import chat, longest_non_blank, or_empty
from tracemill.functions.parsing import udf_boxed
from tracemill.functions.text import first_non_blank, non_blank, strip

# Fields in order of priority.
TEXT_FIELDS = ["original_cot", "cot", "chain_of_thought", "reasoning", "rationale", "response", "output", "generation", "generations", "solution", "messages"]
ID_FIELDS = ["sample_id", "id", "uid", "qid", "question_id", "index"]
QUESTION_FIELDS = ["question", "problem", "prompt", "input", "query"]


def instruction_output(df: DataFrame) -> DataFrame:
    return df.select("instruction", "output")


def query_response(df: DataFrame, system: str | None = None) -> DataFrame:
    """``query, response`` (and ``system`` if given), stripped; rows with a blank one are dropped."""
    rows = df.filter(non_blank("instruction") & non_blank("output")).select(strip("instruction").alias("query"), strip("output").alias("response"))
    return rows.withColumn("system", F.lit(system)) if system else rows


def chat_rows(df: DataFrame, key: str, first: int = 2) -> DataFrame:
    """A conversation per non-blank generation among the ``first`` ones: ``key, i, messages``; the question is the first message."""
    user = strip(F.get("messages", F.lit(0))["content"])
    rows = df.filter(non_blank(F.get("messages", F.lit(0))["content"])).select(key, user.alias("_user"), F.posexplode(F.slice(or_empty("generations"), 1, first)).alias("i", "_text"))
    return rows.filter(non_blank("_text")).select(key, "i", chat(F.col("_user"), strip("_text")).alias("messages"))


def chat_counts(df: DataFrame, first: int = 2) -> DataFrame:
    """Conversations made and rows skipped (no question or no generations; blank generations are not counted)."""
    usable = non_blank(F.get("messages", F.lit(0))["content"]) & (F.size(or_empty("generations")) > 0)
    made = F.size(F.filter(F.slice(or_empty("generations"), 1, first), non_blank))
    return df.agg(F.coalesce(F.sum(F.when(usable, made)), F.lit(0)).cast("bigint").alias("valid"), F.count_if(~usable).alias("skipped"))


def trace_text(df: DataFrame) -> Column:
    """``struct<text, field>`` of the first field by priority that has a text; of generations the longest; ('', null) if none has."""
    options = []
    for name in (f for f in TEXT_FIELDS if f in df.columns):
        kind = df.schema[name].dataType.simpleString()
        if kind == "string":
            value = F.col(name)
        elif kind == "array<string>":
            value = longest_non_blank(F.col(name))
        elif kind.startswith("array<struct<") and "content" in kind:
            value = F.array_join(F.transform(name, lambda m: m["content"]), "\n")
        else:
            continue
        options.append(F.when(non_blank(value), F.struct(strip(value).alias("text"), F.lit(name).alias("field"))))
    return F.coalesce(*options, F.struct(F.lit("").alias("text"), F.lit(None).cast("string").alias("field")))


def all_generations(texts: Column) -> Column:
    """All entries of a list, line by line."""
    return F.array_join(texts, "\n")


def sample_id(df: DataFrame, fallback: Column) -> Column:
    """The first id field that is set, as text."""
    return F.coalesce(*[F.col(f).cast("string") for f in ID_FIELDS if f in df.columns], fallback.cast("string"))


def question_text(df: DataFrame) -> Column:
    return F.coalesce(first_non_blank(*[f for f in QUESTION_FIELDS if f in df.columns]), F.lit(""))


def benchmark_question(df: DataFrame) -> Column:
    """The question of a benchmark: the column ``problem`` if the table has one, else ``question``."""
    return F.col("problem" if "problem" in df.columns else "question")


def final_answer(answer: Column, text: Column) -> Column:
    """The answer if there is one, else the first box of the text, else ''."""
    return F.coalesce(first_non_blank(answer), F.get(udf_boxed(text), F.lit(0)), F.lit(""))
