import pytest

from strataloom import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def found(df, *columns):
    """The rows of a frame as a set of tuples."""
    return {tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}
