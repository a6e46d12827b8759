"""Network-session evidence on Spark."""
