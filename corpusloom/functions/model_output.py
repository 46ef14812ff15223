"""Parse model answers that should hold one JSON object.

Well-formed answers (also inside a code fence) are parsed by Spark's JSON
functions.  Only rows those cannot read carry text to one Arrow UDF, which
finds the first balanced object and escapes stray quotes.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions import text as T


def strip_fences(c: Column) -> Column:
    body = F.regexp_extract(T.or_empty(c), r"(?is)```(?:json)?\s*(.*?)```", 1)
    return T.trim_ws(F.when(body != "", body).otherwise(T.or_empty(c)))


def strip_wrapping_quotes(c: Column) -> Column:
    return T.trim_ws(F.regexp_replace(T.clean_text(strip_fences(c)), "^[\"']|[\"']$", ""))


def first_balanced(s: str) -> str | None:
    """The first ``{...}`` whose braces balance outside of strings."""
    depth, begin, quoted = 0, -1, False
    for token in re.finditer(r'\\.|["{}]', s):
        mark = token.group()
        if mark == '"':
            quoted = not quoted and begin >= 0
        elif quoted or len(mark) > 1:
            continue
        elif mark == "{":
            begin, depth = (token.start() if begin < 0 else begin), depth + 1
        elif begin >= 0:
            depth -= 1
            if depth == 0:
                return s[begin : token.end()]
    return None


# a string runs to the first quote that is followed by , : } ] or the end
_STRING = re.compile(r'"((?:\\.|[^"\\]|"(?!\s*(?:[,:}\]]|$)))*)"', re.S)
_BARE_QUOTE = re.compile(r'(?<!\\)"')


def escape_inner_quotes(s: str) -> str:
    """Escape quotes that stand inside a JSON string."""
    return _STRING.sub(lambda m: '"' + _BARE_QUOTE.sub(r'\\"', m.group(1)) + '"', s)


def _recover(answer: str | None) -> str | None:
    if answer is None:
        return None
    found = first_balanced(answer)
    widest = answer[answer.find("{") : answer.rfind("}") + 1]
    for attempt in (found, widest and escape_inner_quotes(widest)):
        if not attempt:
            continue
        try:
            value = json.loads(attempt)
        except ValueError:
            continue
        if isinstance(value, dict):
            return json.dumps(value, ensure_ascii=False)
    return None


@F.pandas_udf(StringType())
def recover_json(answers: pd.Series) -> pd.Series:
    return answers.map(_recover)


def parse_objects(df: DataFrame, answer: str, fields: dict[str, tuple[str, Column]], status: str = "parse_status") -> DataFrame:
    """Add typed fields with a fallback each, and how the answer was read.

    ``fields`` maps a name to (Spark type, fallback column).
    """
    schema = ", ".join(f"`{n}` {t}" for n, (t, _) in fields.items())
    rows = df.withColumn("_body", strip_fences(F.col(answer)))
    rows = rows.withColumn("_ok", F.json_object_keys("_body").isNotNull())
    rows = rows.withColumn("_fixed", recover_json(F.when(~F.col("_ok"), F.col("_body"))))
    rows = rows.withColumn("_obj", F.from_json(F.when(F.col("_ok"), F.col("_body")).otherwise(F.col("_fixed")), schema))
    state = F.when(F.col("_ok"), "parsed").when(F.col("_fixed").isNotNull(), "recovered").otherwise("fallback")
    typed = [F.coalesce(F.col("_obj")[n], fb.cast(t)).alias(n) for n, (t, fb) in fields.items()]
    return rows.select(*df.columns, *typed, state.alias(status))


def parse_arrays(df: DataFrame, answer: str, name: str) -> DataFrame:
    """The first JSON array of strings in an answer; null when there is none."""
    block = F.regexp_extract(strip_fences(F.col(answer)), r"(?s)\[.*\]", 0)
    return df.withColumn(name, F.from_json(F.when(block != "", block), "array<string>"))


# fixed values: where an answer can hold text, in reading order
TEXT_PARTS = ("text", "output_text")
THOUGHT_PARTS = ("reasoning", "thinking")
MESSAGE_KEYS = ("reasoning_content", "reasoning", "thinking", "refusal")
CHOICE_KEYS = ("reasoning", "reasoning_content")


def _string_at(v: Column, path: str) -> Column:
    """The non-empty string at a path; null if there is none or something else."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.nullif(F.try_variant_get(v, path, "string"), F.lit("")))


def _item_text(item: Column) -> Column:
    kind = F.try_variant_get(item, "$.type", "string")
    first = lambda *names: F.coalesce(*[_string_at(item, f"$.{n}") for n in names])
    return (
        F.when(F.schema_of_variant(item) == "STRING", _string_at(item, "$"))
        .when(kind.isin(*TEXT_PARTS), first("text", "content"))
        .when(kind.isin(*THOUGHT_PARTS), first("text", "summary", "content"))
    )


def message_text(payload: Column) -> Column:
    """Text of the first choice of a chat answer (JSON): its own text, the message's content or content parts,
    then reasoning and refusal fields, parted by blank lines; '' if there is none or no JSON."""
    v = F.try_parse_json(payload)
    content = "$.choices[0].message.content"
    parts = F.coalesce(F.try_variant_get(v, content, "array<variant>"), F.array().cast("array<variant>"))
    single = lambda path: F.array(_string_at(v, path))
    pieces = F.concat(
        single("$.choices[0].text"), single(content), F.transform(parts, _item_text),
        *[single(f"$.choices[0].message.{k}") for k in MESSAGE_KEYS], *[single(f"$.choices[0].{k}") for k in CHOICE_KEYS],
    )
    return F.array_join(F.array_compact(pieces), "\n\n")
