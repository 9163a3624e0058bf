"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from activity_engine.llm.merkle_manifest import manifest_sql
from activity_engine.llm.url_filter import url_sql

ORACLE: dict[str, str] = {"op1_url_filter": url_sql(), "op12_merkle_manifest": manifest_sql()}
