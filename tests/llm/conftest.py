from __future__ import annotations

import pathlib

import pytest


@pytest.fixture(scope="session")
def sf_dir() -> str:
    folder = pathlib.Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("the given tables are not here")
    return str(folder)
