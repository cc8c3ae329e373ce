"""Translated column types as (source type, target type, with the default size), for checking the engine's maps."""

TO_POSTGRES = [
    ("TINYINT", "SMALLINT"),
    ("SMALLINT", "SMALLINT"),
    ("MEDIUMINT", "INTEGER"),
    ("INT", "INTEGER"),
    ("INTEGER", "INTEGER"),
    ("BIGINT", "BIGINT"),
    ("TINYINT UNSIGNED", "SMALLINT"),
    ("SMALLINT UNSIGNED", "INTEGER"),
    ("MEDIUMINT UNSIGNED", "INTEGER"),
    ("INT UNSIGNED", "BIGINT"),
    ("INTEGER UNSIGNED", "BIGINT"),
    ("BIGINT UNSIGNED", "NUMERIC(20, 0)"),
    ("BIT", "BOOLEAN"),
    ("BOOLEAN", "BOOLEAN"),
    ("FLOAT", "REAL"),
    ("FLOAT UNSIGNED", "REAL"),
    ("DOUBLE", "DOUBLE PRECISION"),
    ("DOUBLE UNSIGNED", "DOUBLE PRECISION"),
    ("DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("DECIMAL", "NUMERIC(18, 0)"),
    ("DECIMAL UNSIGNED", "NUMERIC(18, 0)"),
    ("NUMERIC", "NUMERIC(18, 0)"),
    ("NUMERIC UNSIGNED", "NUMERIC(18, 0)"),
    ("CHAR", "CHAR(255)"),
    ("VARCHAR", "VARCHAR(255)"),
    ("TINYTEXT", "TEXT"),
    ("TEXT", "TEXT"),
    ("MEDIUMTEXT", "TEXT"),
    ("LONGTEXT", "TEXT"),
    ("DATE", "DATE"),
    ("TIME", "TIME"),
    ("YEAR", "SMALLINT"),
    ("DATETIME", "TIMESTAMP"),
    ("TIMESTAMP", "TIMESTAMPTZ"),
    ("BINARY", "BYTEA"),
    ("VARBINARY", "BYTEA"),
    ("TINYBLOB", "BYTEA"),
    ("BLOB", "BYTEA"),
    ("MEDIUMBLOB", "BYTEA"),
    ("LONGBLOB", "BYTEA"),
    ("JSON", "JSONB"),
    ("ENUM", "TEXT"),
    ("SET", "TEXT"),
    ("UUID", "UUID"),
    ("INET4", "INET"),
    ("INET6", "VARCHAR(45)"),
    ("GEOMETRY", "TEXT"),
    ("POINT", "TEXT"),
    ("LINESTRING", "TEXT"),
    ("POLYGON", "TEXT"),
    ("MULTIPOINT", "TEXT"),
    ("MULTILINESTRING", "TEXT"),
    ("MULTIPOLYGON", "TEXT"),
    ("GEOMETRYCOLLECTION", "TEXT"),
]

TO_MYSQL = [
    ("INT2", "SMALLINT"),
    ("INT4", "INT"),
    ("INT8", "BIGINT"),
    ("SMALLINT", "SMALLINT"),
    ("INTEGER", "INT"),
    ("BIGINT", "BIGINT"),
    ("OID", "BIGINT"),
    ("SMALLSERIAL", "SMALLINT"),
    ("SERIAL", "INT"),
    ("BIGSERIAL", "BIGINT"),
    ("FLOAT4", "FLOAT"),
    ("FLOAT8", "DOUBLE"),
    ("REAL", "FLOAT"),
    ("DOUBLE PRECISION", "DOUBLE"),
    ("NUMERIC", "DECIMAL(18, 0)"),
    ("DECIMAL", "DECIMAL(18, 0)"),
    ("MONEY", "DECIMAL(19, 2)"),
    ("BPCHAR", "CHAR(255)"),
    ("CHARACTER", "CHAR(255)"),
    ("CHAR", "CHAR(255)"),
    ("VARCHAR", "VARCHAR(255)"),
    ("CHARACTER VARYING", "VARCHAR(255)"),
    ("TEXT", "LONGTEXT"),
    ("DATE", "DATE"),
    ("TIME", "TIME"),
    ("TIME WITHOUT TIME ZONE", "TIME"),
    ("TIMETZ", "TIME"),
    ("TIME WITH TIME ZONE", "TIME"),
    ("TIMESTAMP", "DATETIME"),
    ("TIMESTAMP WITHOUT TIME ZONE", "DATETIME"),
    ("TIMESTAMPTZ", "TIMESTAMP"),
    ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP"),
    ("INTERVAL", "VARCHAR(64)"),
    ("BOOL", "TINYINT(1)"),
    ("BOOLEAN", "TINYINT(1)"),
    ("BYTEA", "LONGBLOB"),
    ("BIT", "BIT"),
    ("VARBIT", "VARBINARY"),
    ("BIT VARYING", "VARBINARY"),
    ("JSON", "JSON"),
    ("JSONB", "JSON"),
    ("UUID", "CHAR(36)"),
    ("XML", "LONGTEXT"),
    ("INET", "VARCHAR(45)"),
    ("CIDR", "VARCHAR(18)"),
    ("MACADDR", "VARCHAR(17)"),
    ("TSVECTOR", "TEXT"),
    ("TSQUERY", "TEXT"),
    ("POINT", "TEXT"),
    ("LINE", "TEXT"),
    ("LSEG", "TEXT"),
    ("BOX", "TEXT"),
    ("PATH", "TEXT"),
    ("POLYGON", "TEXT"),
    ("CIRCLE", "TEXT"),
]
