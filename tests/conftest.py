import tempfile

import pytest

from docfold.session import local_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="docfold-warehouse-")
    session = local_session("*", 4, **{"spark.sql.warehouse.dir": warehouse, "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Builds a RAW frame from JSON texts."""
    from docfold.sources.landing import load_records

    def build(*texts, **options):
        df = spark.createDataFrame([(t, "f.json") for t in texts], "value string, file_name string")
        return load_records(df, **options)

    return build


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted([tuple(r) for r in df.collect()], key=lambda t: [(v is not None, v) for v in t])
