"""Change-data replication and reconciliation as Spark DataFrame operators."""
