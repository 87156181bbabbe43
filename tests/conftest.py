import pytest

from tidewire.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8, shuffle_partitions=4, memory="6g",
        **{"spark.checkpoint.dir": str(folder / "checkpoints"),
           "spark.sql.warehouse.dir": str(folder / "warehouse")})
    yield session
    session.stop()
