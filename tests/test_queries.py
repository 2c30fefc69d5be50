"""Every registered query against its SQL, and that the inputs exercise the rules."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from penmark.plans import views as v
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(name, spark, sf_dir, db):
    assert differences(db, queries()[name](spark, sf_dir), oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_without_sql_has_rows(name, spark, sf_dir):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["text_id", "label", "text"] and rows.count() > 0


def test_inputs_exercise_deduplication_and_character_removal(spark, sf_dir):
    rows = v.tweety(spark, sf_dir).where("text IS NOT NULL")
    assert rows.count() > rows.select("text").distinct().count()
    cleaned = queries()["clean_full"](spark, sf_dir)
    before = rows.where("label = 1").where("text LIKE '%§%'").count()
    assert before > 0 and cleaned.where("text LIKE '%§%'").count() == 0
