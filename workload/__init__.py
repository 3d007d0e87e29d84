"""The checked queries: every operator on the test tables, and the same in DuckDB SQL."""
