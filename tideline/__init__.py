"""Change-data-capture loading and reconciliation as Spark DataFrame operators."""
