"""Readers: databases over JDBC, and landed change logs, batch or stream."""
