"""Schemas as data: one row per column, for any number of tables.

Catalog columns: table, column, type_name, size, digits, nullable, auto_increment, ordinal, key_seq
(key_seq is null outside the primary key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = ("table string, column string, type_name string, size int, digits int, nullable boolean, "
                  "auto_increment boolean, ordinal int, key_seq int")

# Type names of the MySQL family and their PostgreSQL counterparts.
MYSQL_TO_POSTGRES = {
    "TINYINT": "SMALLINT",
    "SMALLINT": "SMALLINT",
    "MEDIUMINT": "INTEGER",
    "INT": "INTEGER",
    "INTEGER": "INTEGER",
    "BIGINT": "BIGINT",
    "TINYINT UNSIGNED": "SMALLINT",
    "SMALLINT UNSIGNED": "INTEGER",
    "MEDIUMINT UNSIGNED": "INTEGER",
    "INT UNSIGNED": "BIGINT",
    "INTEGER UNSIGNED": "BIGINT",
    "BIGINT UNSIGNED": "NUMERIC(20, 0)",
    "BIT": "BOOLEAN",
    "BOOLEAN": "BOOLEAN",
    "FLOAT": "REAL",
    "FLOAT UNSIGNED": "REAL",
    "DOUBLE": "DOUBLE PRECISION",
    "DOUBLE UNSIGNED": "DOUBLE PRECISION",
    "DOUBLE PRECISION": "DOUBLE PRECISION",
    "DECIMAL": "NUMERIC",
    "DECIMAL UNSIGNED": "NUMERIC",
    "NUMERIC": "NUMERIC",
    "NUMERIC UNSIGNED": "NUMERIC",
    "CHAR": "CHAR",
    "VARCHAR": "VARCHAR",
    "TINYTEXT": "TEXT",
    "TEXT": "TEXT",
    "MEDIUMTEXT": "TEXT",
    "LONGTEXT": "TEXT",
    "DATE": "DATE",
    "TIME": "TIME",
    "YEAR": "SMALLINT",
    "DATETIME": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMPTZ",
    "BINARY": "BYTEA",
    "VARBINARY": "BYTEA",
    "TINYBLOB": "BYTEA",
    "BLOB": "BYTEA",
    "MEDIUMBLOB": "BYTEA",
    "LONGBLOB": "BYTEA",
    "JSON": "JSONB",
    "ENUM": "TEXT",
    "SET": "TEXT",
    "UUID": "UUID",
    "INET4": "INET",
    "INET6": "VARCHAR(45)",
    "GEOMETRY": "TEXT",
    "POINT": "TEXT",
    "LINESTRING": "TEXT",
    "POLYGON": "TEXT",
    "MULTIPOINT": "TEXT",
    "MULTILINESTRING": "TEXT",
    "MULTIPOLYGON": "TEXT",
    "GEOMETRYCOLLECTION": "TEXT",
}

# Type names of the PostgreSQL family and their MySQL counterparts.
POSTGRES_TO_MYSQL = {
    "INT2": "SMALLINT",
    "INT4": "INT",
    "INT8": "BIGINT",
    "SMALLINT": "SMALLINT",
    "INTEGER": "INT",
    "BIGINT": "BIGINT",
    "OID": "BIGINT",
    "SMALLSERIAL": "SMALLINT",
    "SERIAL": "INT",
    "BIGSERIAL": "BIGINT",
    "FLOAT4": "FLOAT",
    "FLOAT8": "DOUBLE",
    "REAL": "FLOAT",
    "DOUBLE PRECISION": "DOUBLE",
    "NUMERIC": "DECIMAL",
    "DECIMAL": "DECIMAL",
    "MONEY": "DECIMAL(19, 2)",
    "BPCHAR": "CHAR",
    "CHARACTER": "CHAR",
    "CHAR": "CHAR",
    "VARCHAR": "VARCHAR",
    "CHARACTER VARYING": "VARCHAR",
    "TEXT": "LONGTEXT",
    "DATE": "DATE",
    "TIME": "TIME",
    "TIME WITHOUT TIME ZONE": "TIME",
    "TIMETZ": "TIME",
    "TIME WITH TIME ZONE": "TIME",
    "TIMESTAMP": "DATETIME",
    "TIMESTAMP WITHOUT TIME ZONE": "DATETIME",
    "TIMESTAMPTZ": "TIMESTAMP",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMP",
    "INTERVAL": "VARCHAR(64)",
    "BOOL": "TINYINT(1)",
    "BOOLEAN": "TINYINT(1)",
    "BYTEA": "LONGBLOB",
    "BIT": "BIT",
    "VARBIT": "VARBINARY",
    "BIT VARYING": "VARBINARY",
    "JSON": "JSON",
    "JSONB": "JSON",
    "UUID": "CHAR(36)",
    "XML": "LONGTEXT",
    "INET": "VARCHAR(45)",
    "CIDR": "VARCHAR(18)",
    "MACADDR": "VARCHAR(17)",
    "TSVECTOR": "TEXT",
    "TSQUERY": "TEXT",
    "POINT": "TEXT",
    "LINE": "TEXT",
    "LSEG": "TEXT",
    "BOX": "TEXT",
    "PATH": "TEXT",
    "POLYGON": "TEXT",
    "CIRCLE": "TEXT",
}

# Which family a database belongs to.
FAMILIES = {"mysql": "mysql", "mariadb": "mysql", "postgresql": "postgresql", "kingbase": "postgresql"}


def family(database: str) -> str:
    try:
        return FAMILIES[database.lower()]
    except KeyError:
        raise ValueError(f"unknown database type {database!r}") from None


def type_pairs(source: str) -> list[tuple[str, str]]:
    """The type map out of a family, as (source type, target type)."""
    return list((MYSQL_TO_POSTGRES if source == "mysql" else POSTGRES_TO_MYSQL).items())


def _sized(type_name: Column) -> Column:
    """Append length or precision where the type name does not spell them out."""
    upper = F.upper(type_name)
    length = F.when(F.col("size") > 0, F.col("size")).otherwise(255)
    precision = F.when(F.col("size") > 0, F.col("size")).otherwise(18)
    textual = upper.contains("VARCHAR") | upper.isin("CHAR", "BPCHAR")
    return (F.when(upper.contains("("), type_name)
            .when(textual, F.format_string("%s(%d)", type_name, length))
            .when(upper.contains("NUMERIC") | upper.contains("DECIMAL"),
                  F.format_string("%s(%d, %d)", type_name, precision, F.coalesce("digits", F.lit(0))))
            .otherwise(type_name))


def translate_types(catalog: DataFrame, source: str, target: str) -> DataFrame:
    """Add `target_type` to catalog rows.

    The type map has about 50 rows, so it is broadcast and the catalog is not shuffled.
    """
    from_family, to_family = family(source), family(target)
    if from_family == to_family:
        return catalog.withColumn("target_type", _sized(F.col("type_name")))
    spark = catalog.sparkSession
    mapping = F.broadcast(spark.createDataFrame(type_pairs(from_family), "_from string, _to string"))
    plain = F.trim(F.regexp_replace(F.trim(F.upper("type_name")), r"\(.*$", ""))
    signed = F.regexp_replace("_base", " UNSIGNED$", "")
    own = mapping.select(F.col("_from").alias("_base"), F.col("_to").alias("_own"))
    unsigned = mapping.select(F.col("_from").alias("_signed"), F.col("_to").alias("_as_signed"))
    found = (catalog.withColumn("_base", plain).withColumn("_signed", signed)
             .join(own, "_base", "left").join(unsigned, "_signed", "left"))
    mapped = F.coalesce("_own", "_as_signed")
    if from_family == "mysql":
        special = F.when((F.col("_base") == "TINYINT") & (F.col("size") == 1), "BOOLEAN")
        fallback = "TEXT"
    else:
        special = F.when(F.col("_base").startswith("_"), "LONGTEXT")
        fallback = "LONGTEXT"
    target_type = F.coalesce(special, F.when(mapped.isNotNull(), _sized(mapped)), F.lit(fallback))
    return found.withColumn("target_type", target_type).select(*catalog.columns, "target_type")


def catalog_of(spark: SparkSession, tables: Mapping[str, DataFrame],
               keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Catalog of Spark tables, from their schemas alone; types are named the PostgreSQL way."""
    rows = []
    for name, df in tables.items():
        own_keys = list((keys or {}).get(name, ()))
        for i, field in enumerate(df.schema.fields, start=1):
            type_name, size, digits = _postgres_name(field)
            key_seq = own_keys.index(field.name) + 1 if field.name in own_keys else None
            rows.append((name, field.name, type_name, size, digits, field.nullable and key_seq is None,
                         bool(field.metadata.get("auto_increment", False)), i, key_seq))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _postgres_name(field: T.StructField) -> tuple[str, int, int]:
    if isinstance(field.dataType, T.DecimalType):
        return "NUMERIC", field.dataType.precision, field.dataType.scale
    if isinstance(field.dataType, T.StringType) and "length" in field.metadata:
        return "VARCHAR", int(field.metadata["length"]), 0
    names = {"byte": "SMALLINT", "short": "SMALLINT", "integer": "INTEGER", "long": "BIGINT", "float": "REAL",
             "double": "DOUBLE PRECISION", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMPTZ",
             "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA", "variant": "JSONB"}
    return names.get(field.dataType.typeName(), "TEXT"), 0, 0


def catalog_from_jdbc(spark: SparkSession, url: str, database: str, schema: str,
                      options: Mapping[str, str] | None = None) -> DataFrame:
    """Catalog of a MySQL- or PostgreSQL-family database, read from its information schema."""
    query = catalog_query(database, schema)
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    rows = reader.load()
    return rows.selectExpr(*[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`"
                             for f in T._parse_datatype_string(CATALOG_SCHEMA).fields])


#: Long text types give lengths beyond an int; as no such size is ever written out, the largest int stands for them.
_SIZE = "least(coalesce(c.character_maximum_length, c.numeric_precision, 0), 2147483647)"


def catalog_query(database: str, schema: str) -> str:
    name = schema.replace("'", "''")
    if family(database) == "mysql":
        auto, type_name = "c.extra LIKE '%auto_increment%'", ("CASE WHEN c.column_type LIKE '%unsigned%' THEN "
                                                              "concat(c.data_type, ' unsigned') ELSE c.data_type END")
        quote = "`"
        # The declared width of tinyint is in the column type only; 1 stands for a boolean.
        size = f"CASE WHEN c.column_type LIKE 'tinyint(1)%' THEN 1 ELSE {_SIZE} END"
    else:
        auto, type_name = "(c.is_identity = 'YES' OR c.column_default LIKE 'nextval(%')", "c.udt_name"
        quote = '"'
        size = _SIZE
    return (f"SELECT c.table_name AS {quote}table{quote}, c.column_name AS {quote}column{quote}, "
            f"{type_name} AS type_name, {size} AS size, "
            f"coalesce(c.numeric_scale, 0) AS digits, c.is_nullable = 'YES' AS nullable, {auto} AS auto_increment, "
            f"c.ordinal_position AS ordinal, k.ordinal_position AS key_seq "
            "FROM information_schema.columns c JOIN information_schema.tables t "
            "ON t.table_schema = c.table_schema AND t.table_name = c.table_name AND t.table_type = 'BASE TABLE' "
            "LEFT JOIN (SELECT u.table_schema, u.table_name, u.column_name, u.ordinal_position "
            "FROM information_schema.key_column_usage u JOIN information_schema.table_constraints x "
            "ON x.constraint_name = u.constraint_name AND x.table_schema = u.table_schema "
            "AND x.table_name = u.table_name AND x.constraint_type = 'PRIMARY KEY') k "
            "ON k.table_schema = c.table_schema AND k.table_name = c.table_name AND k.column_name = c.column_name "
            f"WHERE c.table_schema = '{name}'")


def pk_columns(catalog: DataFrame) -> DataFrame:
    """(table, keys): primary key columns in key order."""
    entry = F.when(F.col("key_seq").isNotNull(), F.struct("key_seq", "column"))
    return (catalog.groupBy("table").agg(F.array_sort(F.collect_list(entry)).alias("_keys"))
            .select("table", F.transform("_keys", lambda k: k["column"]).alias("keys")))


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns the target lacks, for tables the target has; columns ignore case."""
    tables = target.select("table").distinct()
    known = target.select("table", F.lower("column").alias("_column")).distinct()
    return (source.join(tables, "table", "left_semi").withColumn("_column", F.lower("column"))
            .join(known, ["table", "_column"], "left_anti").select(*source.columns))


def schema_plan(source: DataFrame, target: DataFrame, schema_sync: bool = True) -> DataFrame:
    """(table, action): create, alter or keep per source table; none while schema sync is off."""
    tables = source.select("table").distinct()
    if not schema_sync:
        return tables.withColumn("action", F.lit("none"))
    existing = target.select("table").distinct().withColumn("exists", F.lit(True))
    lacking = schema_diff(source, target).select("table").distinct().withColumn("lacks", F.lit(True))
    action = F.when(F.col("exists").isNull(), "create").when(F.col("lacks"), "alter").otherwise("keep")
    return tables.join(existing, "table", "left").join(lacking, "table", "left").select("table", action.alias("action"))


def _quoted(name: Column, database: str) -> Column:
    mark = F.lit("`" if family(database) == "mysql" else '"')
    return F.concat(mark, name, mark)


def _column_ddl(database: str) -> Column:
    serial = "BIGINT AUTO_INCREMENT" if family(database) == "mysql" else "BIGSERIAL"
    auto = F.coalesce("auto_increment", F.lit(False))
    return F.concat(_quoted(F.col("column"), database), F.lit(" "),
                    F.when(auto, serial).otherwise(F.col("target_type")),
                    F.when(~F.col("nullable") & ~auto, " NOT NULL").otherwise(""))


def create_ddl(catalog: DataFrame, source: str, target: str) -> DataFrame:
    """(table, ddl): create-table statements. A task holds the column list of one table at a time."""
    typed = translate_types(catalog, source, target)
    grouped = typed.groupBy("table").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", _column_ddl(target).alias("text")))).alias("_columns"),
        F.array_sort(F.collect_list(F.when(F.col("key_seq").isNotNull(), F.struct(
            "key_seq", _quoted(F.col("column"), target).alias("text"))))).alias("_keys"))
    lines = F.transform("_columns", lambda c: F.concat(F.lit("  "), c["text"]))
    key_line = F.concat(F.lit("  PRIMARY KEY ("), F.array_join(F.transform("_keys", lambda k: k["text"]), ", "), F.lit(")"))
    lines = F.when(F.size("_keys") > 0, F.array_append(lines, key_line)).otherwise(lines)
    return grouped.select("table", F.concat(F.lit("CREATE TABLE IF NOT EXISTS "), _quoted(F.col("table"), target),
                                            F.lit(" (\n"), F.array_join(lines, ",\n"), F.lit("\n)")).alias("ddl"))


def alter_ddl(source_catalog: DataFrame, target_catalog: DataFrame, source: str, target: str) -> DataFrame:
    """(table, column, ddl): one add-column statement per missing column."""
    missing = translate_types(schema_diff(source_catalog, target_catalog), source, target)
    return missing.select("table", "column", F.concat(
        F.lit("ALTER TABLE "), _quoted(F.col("table"), target), F.lit(" ADD COLUMN   "), _column_ddl(target)).alias("ddl"))


def evolve(table: DataFrame, wanted: T.StructType) -> DataFrame:
    """Add the wanted columns the table lacks, as null; never drop, rename or retype one."""
    known = {c.lower() for c in table.columns}
    return table.withColumns({f.name: F.lit(None).cast(f.dataType) for f in wanted.fields if f.name.lower() not in known})


_SIMPLE_TYPES = {
    "TINYINT": T.ShortType(), "SMALLINT": T.ShortType(), "YEAR": T.ShortType(), "INT2": T.ShortType(),
    "SMALLSERIAL": T.ShortType(), "TINYINT UNSIGNED": T.ShortType(),
    "MEDIUMINT": T.IntegerType(), "INT": T.IntegerType(), "INTEGER": T.IntegerType(), "INT4": T.IntegerType(),
    "SERIAL": T.IntegerType(), "SMALLINT UNSIGNED": T.IntegerType(), "MEDIUMINT UNSIGNED": T.IntegerType(),
    "BIGINT": T.LongType(), "INT8": T.LongType(), "OID": T.LongType(), "BIGSERIAL": T.LongType(),
    "INT UNSIGNED": T.LongType(), "INTEGER UNSIGNED": T.LongType(), "BIGINT UNSIGNED": T.DecimalType(20, 0),
    "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
    "FLOAT4": T.FloatType(), "REAL": T.FloatType(), "FLOAT UNSIGNED": T.FloatType(),
    "FLOAT8": T.DoubleType(), "DOUBLE": T.DoubleType(), "DOUBLE PRECISION": T.DoubleType(),
    "DOUBLE UNSIGNED": T.DoubleType(), "FLOAT": T.FloatType(), "MONEY": T.DecimalType(19, 2),
    "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(), "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "TIMESTAMP WITHOUT TIME ZONE": T.TimestampNTZType(),
    "BINARY": T.BinaryType(), "VARBINARY": T.BinaryType(), "TINYBLOB": T.BinaryType(), "BLOB": T.BinaryType(),
    "MEDIUMBLOB": T.BinaryType(), "LONGBLOB": T.BinaryType(), "BYTEA": T.BinaryType(),
    "VARBIT": T.BinaryType(), "BIT VARYING": T.BinaryType(),
}


def spark_type(type_name: str, size: int, digits: int, database: str) -> T.DataType:
    """Spark type of a column of the given database; what has no counterpart is text."""
    base = type_name.upper().split("(")[0].strip()
    mysql = family(database) == "mysql"
    if mysql and base == "TINYINT" and size == 1:
        return T.BooleanType()
    if base == "BIT":
        return T.BooleanType() if mysql else T.BinaryType()
    if base == "TIMESTAMP":
        return T.TimestampType() if mysql else T.TimestampNTZType()
    if base in ("DECIMAL", "NUMERIC", "DECIMAL UNSIGNED", "NUMERIC UNSIGNED"):
        precision = size if size and size > 0 else 18
        return T.DecimalType(precision, digits or 0) if precision <= 38 else T.StringType()
    return _SIMPLE_TYPES.get(base, T.StringType())


def spark_schema(catalog: DataFrame, table: str, database: str) -> T.StructType:
    """StructType of one table. Reads that table's few catalog rows on the driver, as any schema must."""
    rows = catalog.where(F.col("table") == table).orderBy("ordinal").collect()
    return T.StructType([T.StructField(
        r["column"], spark_type(r.type_name, r["size"], r.digits, database), bool(r.nullable),
        {"source_type": r.type_name, "auto_increment": bool(r.auto_increment),
         **({"length": r["size"]} if r["size"] and "CHAR" in r.type_name.upper() else {})}) for r in rows])


def time_columns(schema: T.StructType) -> list[str]:
    """Columns that hold a time of day, by the source type noted in their metadata."""
    return [f.name for f in schema.fields
            if f.metadata.get("source_type", "").upper().split("(")[0].strip().startswith("TIME")
            and not f.metadata["source_type"].upper().startswith("TIMESTAMP")]
