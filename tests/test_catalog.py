import pytest
from pyspark.sql import types as T

from tidemark.operators import catalog as C
from workload.type_pairs import TO_MYSQL, TO_POSTGRES


def cases(expected):
    return [(source, 0, 0, target) for source, target in expected]


# type, size, digits, translated type
MYSQL_CASES = cases(TO_POSTGRES) + [
    ("TINYINT", 1, 0, "BOOLEAN"), ("DECIMAL", 10, 2, "NUMERIC(10, 2)"), ("CHAR", 5, 0, "CHAR(5)"),
    ("VARCHAR", 64, 0, "VARCHAR(64)"), ("FOOBARTYPE", 0, 0, "TEXT"), ("FOO UNSIGNED", 0, 0, "TEXT"),
    ("DATE UNSIGNED", 0, 0, "DATE"), (" varchar(20) ", 20, 0, "VARCHAR(20)"), ("enum('a','b')", 1, 0, "TEXT"),
    ("BIGINT UNSIGNED", 20, 0, "NUMERIC(20, 0)")]
POSTGRES_CASES = cases(TO_MYSQL) + [
    ("NUMERIC", 12, 4, "DECIMAL(12, 4)"), ("BPCHAR", 10, 0, "CHAR(10)"), ("varchar", 100, 0, "VARCHAR(100)"),
    ("character varying", 200, 0, "VARCHAR(200)"), ("_INT4", 0, 0, "LONGTEXT"), ("FOOBARTYPE", 0, 0, "LONGTEXT"),
    ("money", 0, 0, "DECIMAL(19, 2)"), ("uuid", 0, 0, "CHAR(36)")]


def catalog(spark, rows):
    return spark.createDataFrame(rows, C.CATALOG_SCHEMA)


def translated(spark, listed, source, target):
    rows = [("t", str(i), t, size, digits, True, False, i, None) for i, (t, size, digits, _) in enumerate(listed)]
    out = C.translate_types(catalog(spark, rows), source, target).collect()
    return {int(r["column"]): r.target_type for r in out}


@pytest.mark.parametrize("listed,source,target", [
    (MYSQL_CASES, "mysql", "postgresql"), (MYSQL_CASES, "mariadb", "kingbase"),
    (POSTGRES_CASES, "postgresql", "mysql"), (POSTGRES_CASES, "kingbase", "mariadb")])
def test_type_maps(spark, listed, source, target):
    got = translated(spark, listed, source, target)
    for i, (name, _, _, want) in enumerate(listed):
        assert got[i] == want, (name, got[i], want)


def test_map_sizes():
    assert len(C.type_pairs("mysql")) == len(cases(TO_POSTGRES)) == 54
    assert len(C.type_pairs("postgresql")) == len(cases(TO_MYSQL)) == 55


def test_same_family_keeps_names(spark):
    assert translated(spark, [("VARCHAR", 64, 0, "")], "mysql", "mariadb")[0] == "VARCHAR(64)"
    assert translated(spark, [("TIMESTAMPTZ", 0, 0, ""), ("int4", 0, 0, "")], "postgresql", "kingbase") == {
        0: "TIMESTAMPTZ", 1: "int4"}


def test_unknown_database(spark):
    with pytest.raises(ValueError):
        C.family("oracle")


PRODUCTS = [("products", "id", "BIGINT", 20, 0, False, True, 1, 1),
            ("products", "name", "VARCHAR", 255, 0, False, False, 2, None),
            ("products", "price", "DECIMAL", 10, 2, True, False, 3, None)]


def test_ddl_and_plan(spark):
    source = catalog(spark, PRODUCTS + [("logs", "b", "INT", 0, 0, False, False, 2, 1),
                                        ("logs", "a", "INT", 0, 0, False, False, 1, 2)])
    ddl = {r.table: r.ddl for r in C.create_ddl(source, "mysql", "postgresql").collect()}
    assert ddl["products"] == ('CREATE TABLE IF NOT EXISTS "products" (\n  "id" BIGSERIAL,\n'
                               '  "name" VARCHAR(255) NOT NULL,\n  "price" NUMERIC(10, 2),\n  PRIMARY KEY ("id")\n)')
    assert ddl["logs"].endswith('  "a" INTEGER NOT NULL,\n  "b" INTEGER NOT NULL,\n  PRIMARY KEY ("b", "a")\n)')
    assert "`id` BIGINT AUTO_INCREMENT,\n" in C.create_ddl(source, "mysql", "mariadb").where("table = 'products'").first().ddl
    target = catalog(spark, [("products", "ID", "BIGINT", 0, 0, False, False, 1, 1),
                             ("products", "Name", "TEXT", 0, 0, True, False, 2, None)])
    alters = C.alter_ddl(source, target, "mysql", "postgresql").collect()
    assert [tuple(r) for r in alters] == [("products", "price", 'ALTER TABLE "products" ADD COLUMN   "price" NUMERIC(10, 2)')]
    assert sorted(map(tuple, C.schema_plan(source, target).collect())) == [("logs", "create"), ("products", "alter")]
    assert {r.action for r in C.schema_plan(source, target, schema_sync=False).collect()} == {"none"}
    assert {r.table: r["keys"] for r in C.pk_columns(source).collect()} == {"products": ["id"], "logs": ["b", "a"]}


def test_spark_schema_and_evolution(spark):
    schema = C.spark_schema(catalog(spark, PRODUCTS + [("products", "t", "TIME", 0, 0, True, False, 4, None)]), "products", "mysql")
    assert [f.dataType for f in schema.fields] == [T.LongType(), T.StringType(), T.DecimalType(10, 2), T.StringType()]
    assert C.time_columns(schema) == ["t"]
    assert C.spark_type("tinyint", 1, 0, "mysql") == T.BooleanType()
    assert C.spark_type("timestamp", 0, 0, "mysql") == T.TimestampType()
    assert C.spark_type("timestamp", 0, 0, "postgresql") == T.TimestampNTZType()
    table = spark.createDataFrame([(1, "x")], "ID bigint, name string")
    grown = C.evolve(table, schema)
    assert grown.columns == ["ID", "name", "price", "t"]
    assert tuple(grown.first()) == (1, "x", None, None)


def test_catalog_of(spark):
    df = spark.createDataFrame([], "id bigint, price decimal(10,2), note string")
    rows = C.catalog_of(spark, {"p": df}, {"p": ["id"]}).orderBy("ordinal").collect()
    assert [(r["column"], r.type_name, r["size"], r.digits, r.nullable, r.key_seq) for r in rows] == [
        ("id", "BIGINT", 0, 0, False, 1), ("price", "NUMERIC", 10, 2, True, None), ("note", "TEXT", 0, 0, True, None)]


def test_catalog_queries_name_the_schema():
    for database in ("mysql", "postgresql"):
        assert "table_schema = 'shop'" in C.catalog_query(database, "shop")
