from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from odd import DOCUMENTS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def odd_folder(odd, data, tmp_path_factory):
    """The odd documents as a table for SQL, beside the driver's other tables."""
    import pyarrow.parquet as pq
    from compare import TABLES

    folder = tmp_path_factory.mktemp("odd")
    for name in TABLES.split():
        if name == "documents":
            pq.write_table(odd.toArrow(), folder / "documents.parquet")
        else:
            (folder / f"{name}.parquet").symlink_to(f"{data}/{name}.parquet")
    return str(folder)
