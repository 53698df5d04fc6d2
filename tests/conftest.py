import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gleanwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny fixtures: compiling whole stages costs more than it saves. The bound queries run with it.
    return local_session("tests", 4, spark__sql__shuffle__partitions=4, spark__sql__codegen__wholeStage="false")


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
