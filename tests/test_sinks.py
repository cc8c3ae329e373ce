"""Statements of the relational sinks. They are checked as text: no database runs here."""

import pytest

from tidemark.operators.catalog import catalog_query
from tidemark.sources.bucket_store import alive_query, guarded_merge_statement, purge_statement
from tidemark.sources.jdbc import delete_statement, merge_statement, read_table
from tidemark.sources.table_store import merge_into_statement, merge_partial_statement


def test_upsert_statements():
    assert merge_statement("postgresql", "t", "s", ["id", "a"], ["id"]) == (
        'INSERT INTO "t" ("id", "a") SELECT "id", "a" FROM "s" ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a"')
    assert merge_statement("kingbase", "t", "s", ["id"], ["id"]).endswith('ON CONFLICT ("id") DO NOTHING')
    assert merge_statement("postgresql", "t", "s", ["a"], []).endswith('FROM "s" ON CONFLICT DO NOTHING')
    assert merge_statement("mariadb", "t", "s", ["id", "a"], ["id"]) == (
        "INSERT INTO `t` (`id`, `a`) SELECT `id`, `a` FROM `s` WHERE true "
        "ON DUPLICATE KEY UPDATE `id` = VALUES(`id`), `a` = VALUES(`a`)")


def test_delete_statement():
    assert delete_statement("postgresql", "t", "s", ["x", "y"]) == (
        'DELETE FROM "t" WHERE EXISTS (SELECT 1 FROM "s" s WHERE s."x" = "t"."x" AND s."y" = "t"."y")')


def test_merge_into_parses(spark):
    text = merge_into_statement("db.t", "latest", ["id", "a"], ["id"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert "MergeIntoTable" in plan.toString()
    spark._jsparkSession.sessionState().sqlParser().parsePlan(merge_into_statement("db.t", "latest", ["id"], ["id"]))


def test_partial_merge_parses(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    text = merge_partial_statement("db.t", "changes", ["id", "a"], ["id"])
    assert "MergeIntoTable" in parser.parsePlan(text).toString() and "WHEN s.`_removed` THEN NULL" in text
    parser.parsePlan(merge_partial_statement("db.t", "changes", ["id"], ["id"]))


@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("columns", [["id", "a", "b"], ["id"]])
def test_guarded_merge_parses(spark, partial, columns):
    parser = spark._jsparkSession.sessionState().sqlParser()
    plan = parser.parsePlan(guarded_merge_statement("db.t", "changes", columns, ["id"], partial)).toString()
    assert "MergeIntoTable" in plan and "_removed" in plan and "greatest" in plan
    assert "DeleteFromTable" in parser.parsePlan(purge_statement("db.t", 50)).toString()
    parser.parsePlan(alive_query("db.t", columns, ["id"], partial))


def test_catalog_query_keeps_sizes_in_range():
    assert "tinyint(1)%' THEN 1" in catalog_query("mysql", "x") and "2147483647" in catalog_query("postgresql", "x")


def test_partitioned_reads_need_bounds(spark):
    with pytest.raises(ValueError):
        read_table(spark, "jdbc:none:", "t", partition_column="id")
