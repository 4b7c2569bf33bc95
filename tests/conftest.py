import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))

TABLES = ["problems", "selected", "scored", "documents", "reading_labels", "benchmark_items", "mix_targets", "events"]
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tracemill.session import build_session

    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__default__parallelism="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.001")


def _derived(folder: Path, change) -> str:
    folder.mkdir(exist_ok=True)
    for name in TABLES:
        pq.write_table(change(pq.read_table(DATA / "sf0.001" / f"{name}.parquet")), folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_tables(tmp_path_factory) -> str:
    """All tables without a row."""
    return _derived(tmp_path_factory.mktemp("empty"), lambda t: t.slice(0, 0))


@pytest.fixture(scope="session")
def null_tables(tmp_path_factory) -> str:
    """Three rows of nulls in every column."""
    return _derived(tmp_path_factory.mktemp("nulls"), lambda t: pa.table([pa.nulls(3, f.type) for f in t.schema], schema=t.schema))


@pytest.fixture(scope="session")
def odd_tables(tmp_path_factory) -> str:
    """Every row twice, every row once more with nulls in all text columns, and extra columns with names that the operators use inside."""

    def change(t: pa.Table) -> pa.Table:
        t = t.slice(0, 40)
        blank = pa.table([pa.nulls(len(t), f.type) if pa.types.is_string(f.type) and f.name not in ("status", "source") else t[f.name] for f in t.schema], schema=t.schema)
        t = pa.concat_tables([t, t, blank])
        for extra in ("_text", "_t", "_rn", "rank", "position", "label", "cell", "unit", "n", "word", "bucket", "tokens", "rate", "total", "i", "kind", "_z", "split"):
            if extra not in t.column_names:
                t = t.append_column(extra, pa.array(["x"] * len(t)))
        return t

    return _derived(tmp_path_factory.mktemp("odd"), change)
