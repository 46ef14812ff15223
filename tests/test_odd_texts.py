"""Queries against their SQL on documents whose texts are null, empty, blank, end in blanks or hold quotes and NUL."""

import duckdb
import pytest
from check import normal

from corpusloom.catalog import ORACLES, QUERIES

TEXTS = [
    None, "", " \n\t", "...", "One two three. Four five! ", "<image> see the dashboard", 'say "it", \\"twice\\"\\', "a\x00b \x00", "x",
    "one two three four", "\r\nthe end\r", '"',
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, TEXTS[(i * 5 + i // 36) % len(TEXTS)], ("en", "fr", "de")[i % 3], f"s{i % 4}", i % 50) for i in range(1, 241)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(f"{root}/documents.parquet")
    return root


def held(spark, root, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet/*.parquet'")
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    df = QUERIES[name](spark, root)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), columns)


@pytest.mark.parametrize("name", ["lx03_opener_profile", "lx03_top_openers", "lx04_length_profile", "lx07_voice_profile"])
def test_lexical_profiles_count_every_row(spark, odd, name):
    held(spark, odd, name)


def test_csv_round_trip_keeps_every_text(spark, odd):
    held(spark, odd, "snk02_csv_round_trip")


def test_csv_cells_come_back_as_they_were(spark, tmp_path):
    from corpusloom.sources import files

    rows = [("1", " a "), ("2", None), ("3", "a\x00b"), ("4", '\\"'), ("5", "\x00"), ("6", '"a""'), ("7", "x,\\")]
    files.write_csv(spark.createDataFrame(rows, "id string, prompt string"), str(tmp_path / "cells"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "cells"), "id string, prompt string").collect())) == rows


def test_records_with_texts_of_their_own_stay(spark, odd):
    held(spark, odd, "src02_read_json_lines")
