from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from registrum.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", partitions=8, app="registrum-tests")
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="registrum-test-")


@pytest.fixture
def sample_etablissements(spark):
    """One clean row, one whose siret is no number, one of another region, one without siren."""
    return spark.createDataFrame(
        [
            ("30120045600017", "301200456", "75011", "1987-03-02", "A"),
            ("3012004560001X", "301200456", "78000", "1987-03-02", "F"),
            ("41255500100026", "412555001", "33000", "2009-11-30", None),
            ("41255500100034", None, "94800", "2010-01-15", "A"),
        ],
        "siret string, siren string, codePostalEtablissement string, dateCreationEtablissement string, "
        "etatAdministratifEtablissement string",
    )
