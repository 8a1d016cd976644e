from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def tables(sf_dir):
    """Read one of the smallest tables as a list of dictionaries."""
    import duckdb

    con = duckdb.connect()

    def rows(name: str) -> list[dict]:
        found = con.execute(f"SELECT * FROM '{sf_dir}/{name}.parquet'")
        names = [d[0] for d in found.description]
        return [dict(zip(names, r, strict=True)) for r in found.fetchall()]

    return rows
