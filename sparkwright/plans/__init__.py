"""Registered queries: one per survey inventory ID (or a few per ID), each a
function ``(spark, sf_dir) -> DataFrame`` built from the operators, plus the
DuckDB SQL that must give the same rows (``oracle``)."""
