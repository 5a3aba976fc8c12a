"""DuckDB SQL oracles used by the driver's correctness check and the tests."""
