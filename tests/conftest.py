import pytest

from weekloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "weekloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staging")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as dicts, sorted by the given columns."""

    def collect(df, *keys):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else out

    return collect
