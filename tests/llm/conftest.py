from tests.conftest import rows, spark  # noqa: F401
