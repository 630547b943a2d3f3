import pytest

from tests.compare import session
from tickloom.session import tune


@pytest.fixture(scope="session")
def spark():
    return tune(session())
