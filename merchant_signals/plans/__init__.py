"""Named query plans (driver registry), their DuckDB oracles, the increment runner."""
